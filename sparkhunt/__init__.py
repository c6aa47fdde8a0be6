"""Threat-hunting analytics on Spark DataFrames."""

from sparkhunt.registry import apply_analytic

__all__ = ["apply_analytic"]
