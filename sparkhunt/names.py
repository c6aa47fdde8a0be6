"""Column addressing for entity tables whose attribute names carry dots and quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Back-tick an attribute name so that dots are part of the name."""
    return "`" + name.replace("`", "``") + "`"


def c(name: str) -> Column:
    """Column with exactly this name, e.g. ``c("src_ref.value")``."""
    return F.col(quoted(name))


def has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def let(value: Column, body) -> Column:
    """Bind ``value`` once inside an expression: ``body`` gets it as a variable.

    Without it, an expression used n times in a lambda is evaluated n times.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
