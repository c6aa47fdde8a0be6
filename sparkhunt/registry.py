"""Analytics by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from sparkhunt.operators.filters import geo_markers
from sparkhunt.operators.joins import intel_ip_enrich, intel_observable_enrich, ip_domain_enrich
from sparkhunt.plans.clustering import cluster_auto
from sparkhunt.plans.enrichment import log4shell, pin_ips
from sparkhunt.plans.exfiltration import exfiltration
from sparkhunt.plans.lateral_movement import graph_lm_detect, lm_cluster_detect
from sparkhunt.plans.plotting import plot_data
from sparkhunt.plans.process_scoring import powershell_deobfuscate, suspicious_process_score

ANALYTICS: dict[str, Callable[..., DataFrame]] = {
    "attribute-plot": plot_data,
    "exfiltration-modeling": exfiltration,
    "domain-enrichment": ip_domain_enrich,
    "log4shell-deobfuscation-and-detection": log4shell,
    "pin-IP-on-map": pin_ips,
    "geo-markers": geo_markers,
    "SANS-enrich": intel_ip_enrich,
    "clustering": cluster_auto,
    "suspicious-process-scoring": suspicious_process_score,
    "powershell-deobfuscation": powershell_deobfuscate,
    "xfe-enrich": intel_observable_enrich,
    "lateral-movement-clusters": lm_cluster_detect,
    "lateral-movement-graph": graph_lm_detect,
}


def register(name: str, fn: Callable[..., DataFrame]) -> None:
    ANALYTICS[name] = fn


def apply_analytic(name: str, *dfs: DataFrame, **params) -> DataFrame:
    """Run the analytic registered under ``name`` on one or more tables."""
    if name not in ANALYTICS:
        raise KeyError(f"no analytic {name!r}; known: {', '.join(sorted(ANALYTICS))}")
    return ANALYTICS[name](*dfs, **params)
