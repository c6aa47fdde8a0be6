"""Global row positions and running sums without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkhunt.names import c
from sparkhunt.session import fixed_partitions

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def row_positions(df: DataFrame, keys: Sequence[str | Column], name: str = "pos") -> DataFrame:
    """Add the 0-based position of every row in the order of ``keys``.

    The rows are range-partitioned and sorted once and written to the checkpoint
    folder, so partitions are fixed; a position is then the row's number inside its
    partition plus the rows of the partitions before it (one count per partition).
    """
    order = [c(k) if isinstance(k, str) else k for k in keys]
    stable = fixed_partitions(df.repartitionByRange(*order).sortWithinPartitions(*order))
    numbered = stable.withColumn("__id", F.monotonically_increasing_id())
    part = F.shiftrightunsigned(F.col("__id"), _POSITION_BITS)
    sizes = (
        numbered.groupBy(part.alias("__part"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn(  # one row per partition of the sort
            "__before",
            F.sum("n").over(
                Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .select("__part", F.coalesce("__before", F.lit(0)).alias("__before"))
    )
    in_part = F.col("__id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        numbered.withColumn("__part", part)
        .join(F.broadcast(sizes), "__part")
        .withColumn(name, F.col("__before") + in_part)
        .drop("__id", "__part", "__before")
    )


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    value: Column,
    name: str,
    chunk_rows: int = 10_000,
) -> DataFrame:
    """Inclusive running sum of ``value`` by ``position`` inside each key.

    ``position`` is a dense line number; a key is cut into chunks of ``chunk_rows``, so
    a key that holds a large part of the table is worked on by many tasks.
    """
    keys = list(keys)
    cut = df.withColumn("__v", value.cast("long")).withColumn(
        "__chunk", F.floor(c(position) / chunk_rows)
    )
    before = (
        cut.groupBy(*[c(k) for k in keys], F.col("__chunk"))
        .agg(F.sum("__v").alias("__s"))
        .withColumn(
            "__before",
            F.sum("__s").over(
                Window.partitionBy(*[c(k) for k in keys])
                .orderBy("__chunk")
                .rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .select(*[c(k) for k in keys], "__chunk", F.coalesce("__before", F.lit(0)).alias("__before"))
    )
    inside = F.sum("__v").over(
        Window.partitionBy(*[c(k) for k in keys], F.col("__chunk"))
        .orderBy(c(position))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        cut.withColumn("__in", inside)
        .join(before.hint("merge"), [*keys, "__chunk"], "left")  # one row or more a key: never broadcast
        .withColumn(name, F.col("__in") + F.col("__before"))
        .drop("__v", "__chunk", "__in", "__before")
    )


def next_at_or_after(df: DataFrame, key: str, at: str, wanted: str, name: str, chunk_rows: int = 10_000) -> DataFrame:
    """(key, at, name): for each row the smallest ``at`` of its key that is ``wanted`` or more.

    NULL where there is none.  One sort of all places and questions, cut into chunks; the
    last place of a chunk is carried on to the ones after it, so a key may hold any share
    of the rows.
    """
    places = df.select(c(key).alias("__key"), c(at).alias("__p"), F.lit(0).alias("__ask"), c(at).alias("__at"))
    asked = df.select(c(key).alias("__key"), c(wanted).alias("__p"), F.lit(1).alias("__ask"), c(at).alias("__at"))
    placed = row_positions(places.unionByName(asked), ["__key", F.desc("__p"), "__ask"], "__pos")
    cut = placed.withColumn("__chunk", F.floor(F.col("__pos") / chunk_rows)).withColumn(
        "__place", F.when(F.col("__ask") == 0, F.struct("__key", F.col("__p").alias("p")))
    )
    last = F.last("__place", ignorenulls=True)
    ends = cut.groupBy("__chunk").agg(F.max_by("__place", F.when(F.col("__ask") == 0, F.col("__pos"))).alias("__place"))
    before = Window.orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("__chunk", last.over(before).alias("__carried"))
    inside = Window.partitionBy("__chunk").orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    found = cut.withColumn("__in", last.over(inside)).where("__ask = 1").join(carried, "__chunk", "left")
    held = F.coalesce("__in", "__carried")
    return found.select(F.col("__key").alias(key), F.col("__at").alias(at), F.when(held["__key"].eqNullSafe(F.col("__key")), held["p"]).alias(name))
