"""Time the headline queries; prints one JSON line.

Entity views are written as Parquet once, outside the measured time, so that a query is
timed on the table an analyst would hand to it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from queryset import QUERIES  # noqa: E402
from queryset.catalog import CONN, PROC  # noqa: E402
from queryset.q_stats import AUTH_NAMES  # noqa: E402
from queryset.q_tables import AUTH  # noqa: E402
from queryset.views import Tables  # noqa: E402
from sparkhunt.functions.log4shell import l4s_detect  # noqa: E402
from sparkhunt.functions.whois import whois_parse  # noqa: E402
from sparkhunt.operators import aggregates as agg  # noqa: E402
from sparkhunt.operators import graph as gr  # noqa: E402
from sparkhunt.operators.dbscan import dbscan_numeric  # noqa: E402
from sparkhunt.operators.geo import ip_geolocate  # noqa: E402
from sparkhunt.operators.joins import intel_ip_enrich  # noqa: E402
from sparkhunt.plans.exfiltration import exfiltration  # noqa: E402
from sparkhunt.plans.process_scoring import powershell_deobfuscate, suspicious_process_score  # noqa: E402
from sparkhunt.session import build_session  # noqa: E402

VIEWS = ("v_process", "v_script", "v_url", "v_auth", "v_connections", "v_geo_blocks", "v_intel_ip", "v_points", "v_whois_text")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    work = tempfile.mkdtemp(prefix="sparkhunt-bench-")
    for view in VIEWS:
        tables(view).repartition(int(cpus)).write.parquet(f"{work}/{view}")
    read = lambda view, **names: spark.read.parquet(f"{work}/{view}").withColumnsRenamed(names)

    auth = lambda: read("v_auth", **AUTH_NAMES)
    headline = {
        "suspicious_process_score": lambda: suspicious_process_score(read("v_process", **PROC)),
        "powershell_deobfuscate": lambda: powershell_deobfuscate(read("v_script")),
        "l4s_detect": lambda: l4s_detect(read("v_url")),
        "whois_parse": lambda: whois_parse(read("v_whois_text")),
        "source_profile": lambda: agg.source_profile(auth()),
        "user_profile": lambda: agg.user_profile(auth()),
        "destination_profile": lambda: agg.destination_profile(auth()),
        "exfiltration": lambda: exfiltration(
            read("v_connections", **CONN), agg.hourly_histogram(read("v_connections"))
        ),
        "intel_ip_enrich": lambda: intel_ip_enrich(read("v_connections", **CONN), read("v_intel_ip")),
        "ip_geolocate": lambda: ip_geolocate(read("v_connections", **CONN), read("v_geo_blocks"), "dst_ref.value"),
        "time_count": lambda: agg.time_count(tables("lineitem"), "l_shipdate", "l_partkey"),
        "value_counts": lambda: agg.value_counts(tables("lineitem"), "l_partkey"),
        "boxplot_stats": lambda: agg.boxplot_stats(tables("lineitem"), ["l_quantity", "l_extendedprice"]),
        "histogram10": lambda: agg.histogram10(tables("lineitem"), "l_extendedprice"),
        "kmeans_assign": lambda: QUERIES["kmeans_assign"](spark, folder),
        "dbscan_numeric": lambda: dbscan_numeric(read("v_points"), ["x", "y"], 1.2, 5, "c_custkey"),
        "knn_join": lambda: QUERIES["knn_join"](spark, folder),
        "lm_cluster_detect": lambda: QUERIES["lm_cluster_detect"](spark, folder),
        "random_walks": lambda: gr.random_walks(gr.adjacency(gr.graph_edges(read("v_auth", **AUTH))), 10),
    }
    seconds: dict[str, float] = {}
    for name, build in headline.items():
        taken = []
        for run in range(RUNS + 1):  # the first run warms up
            start = time.perf_counter()
            df = build()
            df.select(F.sum(F.xxhash64(*[F.col(f"`{x}`") for x in df.columns]) % 1000)).collect()
            if run:
                taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "runs": RUNS,
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
