"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkhunt.operators.lookup import totals_join
from sparkhunt.session import cut_lineage, discard



def _with_smallest(pairs: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """(u, v) rows with the smallest of u and its neighbours as m, and the written table
    of those; hubs are spread over tasks."""
    smallest = cut_lineage(
        pairs.groupBy("u")
        .agg(F.min("v").alias("least"), F.count(F.lit(1)).alias("__rows"))
        .select("u", F.least("least", "u").alias("m"), "__rows")
    )
    return totals_join(pairs, smallest, ["u"], "__rows", how="inner", whole=rows), smallest


def _fingerprint(pairs: DataFrame) -> tuple:
    row = pairs.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
    ).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component): the smallest node that can be reached, for every node.

    Alternates two steps until nothing changes (a pair only ever moves to smaller nodes,
    so there is an end; in practice logarithmically many rounds): neighbours
    larger than a node are linked to its smallest neighbour, then smaller ones are.
    Each round is written to the checkpoint folder and deleted after the next one.
    """
    pairs = cut_lineage(
        edges.where("src <> dst")
        .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .distinct()
    )
    before = _fingerprint(pairs)
    while before[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        met, first = _with_smallest(both, 2 * before[0])
        large = cut_lineage(
            met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        small, second = _with_smallest(large, before[0])
        ends = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        new = cut_lineage(
            small.select(F.explode(ends).alias("e")).select("e.*").where("u <> v").distinct()
        )
        discard(pairs, first, large, second)
        pairs = new
        after = _fingerprint(pairs)
        if after == before:
            break
        before = after
    roots = pairs.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return nodes.select("node").distinct().join(roots, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
