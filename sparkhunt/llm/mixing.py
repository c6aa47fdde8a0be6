"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents are dealt by hash into blocks of their source.  A source's target fixes how
often each of its blocks is drawn.  The drawn blocks of all sources are then split among
the output shards by a binary tree: each node hands a multivariate-hypergeometric share of
its block counts to its left half, so every shard gets an exact number of blocks of every
source and the shares are distributed as if all drawn blocks had been shuffled together.
Shards take disjoint runs of each source's permuted draws and shuffle their rows locally.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkhunt.llm.common import own_name
from sparkhunt.names import c
from sparkhunt.operators.ordering import running_sum
from sparkhunt.session import cut_lineage

#: What a word is: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, most: float = 3.0, cycle: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code-point order, null last, weigh 1, 2, .., ``cycle`` and again 1; they
    share the sum of all sizes by weight.  A target stops at ``most`` times its source's
    size and the excess is shared again by weight, until none is above: with the sources
    in the order of cap over weight, the first ones are capped and the rest share what is
    left.  The table has one row per source of the mix.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weighted = sizes.withColumn("w", ((F.row_number().over(order) - 1) % cycle + 1).cast("double")).withColumn(
        "cap", most * F.col("source_size")
    )
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / F.sum("w").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    leveled = weighted.withColumn("level", level).withColumn("open", F.col("level") * F.col("w") <= F.col("cap"))
    # the first open row's level holds for it and all after it
    shared = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        by_level.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return leveled.select(
        "source",
        "source_size",
        F.coalesce(F.least(shared * F.col("w"), F.col("cap")), F.col("cap")).alias("target"),
    )


def split_quotas(quotas: np.ndarray, shard: int, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The block counts before ``shard`` and those of ``shard``, by source.

    Walks from the root to one leaf; a node's generator is seeded by its place, so every
    task sees the same tree without sharing state.
    """
    low, high, held = 0, shards, quotas.astype(np.int64)
    before = np.zeros_like(held)
    while high - low > 1:
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        total = int(held.sum())
        n_left = total * (middle - low) // (high - low)
        left = rng.multivariate_hypergeometric(held, n_left, method="marginals") if total else held
        if shard < middle:
            high, held = middle, left
        else:
            low, held, before = middle, held - left, before + left
    return before, held


def shard_quotas(spark, quotas: list[tuple[int, int]], shards: int, seed: int) -> DataFrame:
    """(source_no, shard, first, n): the run of a source's draws that a shard takes.

    ``quotas`` has one (source number, drawn blocks) pair per source of the mix.
    """
    numbers = np.array([q[0] for q in quotas], dtype=np.int64)
    counts = np.array([q[1] for q in quotas], dtype=np.int64)

    def leaves(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for shard in part.column(0).to_pylist():
                before, held = split_quotas(counts, shard, shards, seed)
                some = held > 0
                yield pa.RecordBatch.from_pydict(
                    {"source_no": numbers[some], "shard": np.full(some.sum(), shard), "first": before[some], "n": held[some]}
                )

    return spark.range(shards).mapInArrow(leaves, "source_no long, shard long, first long, n long")


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block_words: int = 20_000,
    shard_words: int = 2_000_000,
    most: float = 3.0,
    seed: int = 7,
) -> DataFrame:
    """Add a struct of ``size``, ``source_size``, ``target`` and ``draws`` to every row.

    The struct is the last column and called ``mix``, with underscores in front if other
    columns are called so; otherwise the columns of ``docs`` may have any names.
    ``draws`` lists the (shard, place) pairs at which the mix takes the row: empty if
    it takes it never, and never more than ``most`` rounded up.  ``size`` times their
    number is what the row gives to the mix; over a source these sums stay at or below its target and
    come as near to it as whole documents of its last block allow.

    A null text counts no words; a null source is a source of its own; rows repeated in
    the input are rows of their own but, with the same key and text, are drawn alike; an
    empty table gives an empty table.  Reruns agree, whatever the partitioning.

    Nothing is sorted by source: rows go to blocks by hash, words are summed per block
    before anything is shuffled, and a source's blocks are summed in chunks.
    """
    spark = docs.sparkSession
    names = [c(x) for x in docs.columns]
    ident = F.xxhash64(F.lit(seed), c(key).cast("string"), F.coalesce(c(text), F.lit("")))
    light = cut_lineage(
        docs.select(c(source).cast("string").alias("source"), ident.alias("ident"), word_count(c(text)).alias("size"))
    )
    heavy = F.col("size") > block_words // 4  # documents that would upset a block
    totals = light.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.coalesce(F.sum(F.when(heavy, F.col("size"))), F.lit(0)).alias("heavy_size"), F.count(F.when(heavy, 1)).alias("n_heavy")
    )
    numbered = source_targets(totals, most).withColumn(
        "source_no", F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))).cast("long")
    )
    extra = totals.select(F.col("source").alias("of"), "heavy_size", "n_heavy")
    sources = cut_lineage(
        numbered.join(extra, F.col("source").eqNullSafe(F.col("of"))).drop("of")
        .withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)))
        .withColumn("passes", F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
        .withColumn("heavy_rest", F.col("rest") * F.col("heavy_size") / F.greatest(F.col("source_size"), F.lit(1)))
    )
    few = F.broadcast(sources)  # one row per source of the mix
    # heavy documents have (nearly) a block each, after the blocks of the others
    block = F.when(heavy, F.col("n_blocks") + F.pmod(F.shiftright("ident", 4), 16 * F.col("n_heavy"))).otherwise(F.pmod(F.col("ident"), F.col("n_blocks")))
    placed = light.join(few, light["source"].eqNullSafe(sources["source"])).select("source_no", heavy.alias("heavy"), block.alias("block"), "ident", "size")
    sized = placed.groupBy("source_no", "heavy", "block").agg(F.sum("size").alias("words"))
    summed = cut_lineage(running_sum(sized, ["source_no", "heavy"], "block", F.col("words"), "upto")).join(
        F.broadcast(sources.select("source_no", "passes", "rest", "heavy_rest")), "source_no"
    )
    # one more draw: of the heavy blocks about their share of the rest, of the others what is left,
    # and of the block across its end the documents that fit
    before = F.col("upto") - F.col("words")
    big = summed.where("heavy").withColumn("whole", (F.col("upto") <= F.col("heavy_rest")) | ((before < F.col("heavy_rest")) & (F.col("upto") <= F.col("rest"))))
    taken_big = big.where("whole").groupBy("source_no").agg(F.sum("words").alias("heavy_taken"))
    small = summed.where("not heavy").join(F.broadcast(taken_big), "source_no", "left").withColumn(
        "rest", F.col("rest") - F.coalesce("heavy_taken", F.lit(0))
    ).drop("heavy_taken").withColumn("whole", F.col("upto") <= F.col("rest"))
    summed = cut_lineage(big.unionByName(small))
    across = summed.where(~F.col("heavy") & ~F.col("whole") & (before < F.col("rest"))).select("source_no", "block", (F.col("rest") - before).alias("room"))
    members = placed.join(F.broadcast(across), ["source_no", "block"]).groupBy("source_no", "block", "room").agg(
        F.sort_array(F.collect_list(F.struct("size", "ident")), asc=False).alias("members")  # a block's documents
    )
    start = F.struct(F.col("room").alias("room"), F.array().cast("array<bigint>").alias("taken"))
    fitted = F.aggregate(
        "members",
        start,
        lambda held, m: F.when(
            m["size"] <= held["room"],
            F.struct((held["room"] - m["size"]).alias("room"), F.concat(held["taken"], F.array(m["ident"])).alias("taken")),
        ).otherwise(held),
    )
    partial = members.select("source_no", "block", fitted["taken"].alias("taken"))
    drawn = summed.join(F.broadcast(partial), ["source_no", "block"], "left")
    times = F.col("passes") + F.when(F.col("whole") | F.col("taken").isNotNull(), 1).otherwise(0)
    draws = cut_lineage(drawn.select("source_no", "block", "taken", "whole", "passes", times.cast("int").alias("times")))
    quotas = [
        (r["source_no"], r["n"]) for r in draws.groupBy("source_no").agg(F.sum("times").alias("n")).where("n > 0").collect()
    ]
    words = sources.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    shards = max(1, -(-int(words) // shard_words))
    runs = shard_quotas(spark, sorted(quotas), shards, seed)
    ordered = F.xxhash64(F.lit(seed), "source_no", "block", "pass")
    # a source's draws in permuted order: hash buckets of the order, then ranks inside a bucket
    single = draws.select("source_no", "block", "times", F.explode(F.expr("sequence(1, times)")).alias("pass")).where("times > 0")
    ranked = _permuted(single, ordered)
    taken_runs = runs.select("source_no", "shard", F.explode(F.expr("sequence(first, first + n - 1)")).alias("rank"))
    placed_draws = ranked.join(taken_runs, ["source_no", "rank"]).groupBy("source_no", "block").agg(
        F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("draws")  # at most `most` + 1 of them
    )
    plan = draws.select("source_no", "block", "taken", "whole", "passes").join(placed_draws, ["source_no", "block"], "left")
    # the rows themselves, as one struct so that their columns cannot clash
    rows = docs.select(F.struct(*names).alias("row"), c(source).cast("string").alias("of"), ident.alias("ident"), word_count(c(text)).alias("size"))
    located = rows.join(few, rows["of"].eqNullSafe(sources["source"])).select(
        "row", "ident", "size", "source_size", "target", "source_no", block.alias("block")
    )
    both = located.join(plan, ["source_no", "block"])
    fits = F.col("whole") | F.coalesce(F.array_contains("taken", F.col("ident")), F.lit(False))
    kept = F.filter(F.coalesce("draws", F.array()), lambda d: (d["pass"] <= F.col("passes")) | fits)
    place = F.transform(kept, lambda d: F.struct(d["shard"].alias("shard"), F.xxhash64(F.lit(seed), F.col("ident"), d["pass"]).alias("place")))
    added = F.struct("size", "source_size", "target", place.alias("draws")).alias(own_name("mix", docs.columns))
    return both.select(*[F.col("row")[x].alias(x) for x in docs.columns], added)


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows that the mix takes, as often as it does, shard by shard in shuffled order."""
    mixed = mix(docs, **options)
    name = mixed.columns[-1]
    draw = own_name("draw", mixed.columns)
    drawn = mixed.withColumn(draw, F.explode(c(name)["draws"]))
    return drawn.repartition(c(draw)["shard"]).sortWithinPartitions(c(draw)["shard"], c(draw)["place"]).select(*[c(x) for x in docs.columns])


def _permuted(draws: DataFrame, order: Column, per_bucket: int = 4096) -> DataFrame:
    """Add ``rank``: the 0-based place of each draw in its source's permuted order."""
    counts = draws.groupBy("source_no").agg(F.count(F.lit(1)).alias("all"))
    hashed = draws.join(F.broadcast(counts), "source_no").withColumn("h", order)
    buckets = F.ceil(F.col("all") / per_bucket)
    dealt = cut_lineage(hashed.withColumn("bucket", F.pmod(F.shiftright("h", 8), buckets)))
    sizes = dealt.groupBy("source_no", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("source_no", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("source_no", "bucket").orderBy("h", "block", "pass")) - 1
    return dealt.withColumn("inside", inside).join(firsts, ["source_no", "bucket"]).select(
        "source_no", "block", "pass", (F.col("before") + F.col("inside")).alias("rank")
    )
