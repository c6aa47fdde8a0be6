"""Benchmark passages in documents: SimHash windows, multi-index Hamming search, exact check.

SQL functions only.  Every window of a document that has the size of a benchmark item and
could reach the similarity gets a 64-bit SimHash of its weighted shingles, as every item
has.  Could reach: a weighted Jaccard similarity of t needs so many shingles in common that
windows with fewer shingles of items of their size are passed over, which loses nothing.
Fingerprints are cut into blocks; a window is a candidate for the items of its size of
which one block differs in few bits, which by the pigeonhole principle finds every
fingerprint within the radius.  Items of few distinct shingles, whose fingerprints are
unsteady, find their windows by their rarest shingles instead.  The weighted Jaccard
similarity of the shingles then decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkhunt.llm.common import own_name, words
from sparkhunt.names import c
from sparkhunt.operators.lookup import fits_broadcast, lookup_join, unsent
from sparkhunt.session import cut_lineage

SHINGLE = 5
#: Widths of the blocks of a fingerprint, and the bits in which a matching block may differ.
WIDTHS, SLACK = (10, 9, 9, 9, 9, 9, 9), 2
#: All fingerprints that differ in at most so many bits agree in one block up to SLACK.
RADIUS = len(WIDTHS) * (SLACK + 1) - 1
#: Items of a smaller effective number of distinct shingles, (sum k)^2 / sum k^2 of their
#: counts k, are searched by shingles: their few summed bits flip too often for the radius.
STEADY = 12
#: The columns that name a document, and a window of it.
DOC = ("id", "text_hash")
WINDOW = (*DOC, "n", "start")


def _positions(rows: DataFrame, *names: str) -> DataFrame:
    """(names, n_here, pos, h): number of shingles of ``text``, and the hash of each."""
    hashes = rows.select(*names, F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("w"))
    n_here = (F.size("w") - (SHINGLE - 1)).alias("n_here")
    shifted = [F.slice("w", i + 1, F.greatest(F.size("w") - i, F.lit(0))) for i in range(SHINGLE)]
    zipped = hashes.select(*names, n_here, F.posexplode(F.arrays_zip(*[x.alias(f"w{i}") for i, x in enumerate(shifted)])).alias("pos", "s"))
    whole = zipped.where(F.col(f"s.w{SHINGLE - 1}").isNotNull())
    return whole.select(*names, "n_here", "pos", F.xxhash64(*[F.col(f"s.w{i}") for i in range(SHINGLE)]).alias("h"))


def simhash(bags: DataFrame, *names: str) -> DataFrame:
    """(names, mark) of rows (names, h, k): the signs of the summed bits, a shingle weighing k."""
    sums = [F.sum(F.when(F.getbit("h", F.lit(b)) == 1, F.col("k")).otherwise(-F.col("k"))).alias(f"b{b}") for b in range(64)]
    mark = F.lit(0).cast("long")
    for b in range(64):
        mark = mark.bitwiseOR(F.when(F.col(f"b{b}") > 0, F.lit((1 << b) - (1 << 64 if b == 63 else 0))).otherwise(F.lit(0)).cast("long"))
    return bags.groupBy(*names).agg(*sums).select(*names, mark.alias("mark"))


def _blocks(fingerprint: Column) -> Column:
    """(number, value) of each block."""
    out, at = [], 0
    for number, width in enumerate(WIDTHS):
        value = F.shiftrightunsigned(fingerprint, at).bitwiseAND(F.lit((1 << width) - 1)).cast("int")
        out.append(F.struct(F.lit(number).alias("block"), value.alias("value")))
        at += width
    return F.array(*out)


def _near_values(block: Column, value: Column) -> Column:
    """All values of a block that differ from ``value`` in at most SLACK bits."""
    size = F.when(block == 0, F.lit(1 << WIDTHS[0])).otherwise(F.lit(1 << WIDTHS[1]))
    return F.filter(F.sequence(F.lit(0), size - 1), lambda v: F.bit_count(v.bitwiseXOR(value)) <= SLACK)


def _same(a: DataFrame, b: DataFrame, *names: str) -> list[Column]:
    return [a[x].eqNullSafe(b[x]) for x in names]


def _meet(big: DataFrame, small: DataFrame, how: str, *names: str) -> DataFrame:
    """Join on columns that may be null; ``small`` is a stored table, broadcast if its size allows."""
    side = small.select(*[F.col(x).alias(f"its_{x}") if x in names else x for x in small.columns])
    on = [F.col(x).eqNullSafe(F.col(f"its_{x}")) for x in names]
    return big.join(F.broadcast(side) if fits_broadcast(small) else unsent(side), on, how).drop(*[f"its_{x}" for x in names])


def _windows(hits: DataFrame, least: float) -> DataFrame:
    """(id, text_hash, n_here, n, start): every window that may be ``least`` similar to an item.

    ``hits`` are the positions (id, text_hash, n_here, n, pos) of shingles of items of n
    shingles.  A window of n shingles needs 2 n t / (1 + t) of them, one cut short by the
    end of its text, of m shingles, (n + m) t / (1 + t).  A start belongs to the first hit
    at or after it, so that each is made once.
    """
    at = Window.partitionBy(*DOC, "n").orderBy("pos")
    ranked = cut_lineage(
        hits.select(
            "*",
            F.row_number().over(at).alias("rank"),
            (F.coalesce(F.lag("pos").over(at), F.lit(-1)) + 1).alias("free"),
            F.count(F.lit(1)).over(Window.partitionBy(*DOC, "n")).alias("n_hits"),
        ).where(F.col("n_hits") >= F.col("n") * least - 1e-9)
    )
    share = least / (1 + least)
    need = F.greatest(F.ceil(F.col("n") * (2 * share) - 1e-9), F.lit(1))
    ends = ranked.select(*[F.col(x).alias(f"e_{x}") for x in (*DOC, "n", "rank", "pos")])
    on = [*[F.col(x).eqNullSafe(F.col(f"e_{x}")) for x in (*DOC, "n")], F.col("rank") + need - 1 == F.col("e_rank")]
    dense = ranked.join(unsent(ends), on).where(F.col("e_pos") - F.col("pos") < F.col("n"))
    whole = dense.select(
        *DOC, "n_here", "n", F.greatest("free", F.col("e_pos") - F.col("n") + 1).alias("first"), F.least("pos", F.col("n_here") - F.col("n")).alias("last")
    )
    starts = lambda df: df.where(F.col("first") <= F.col("last")).withColumn("start", F.explode(F.sequence("first", "last")))
    tail = ranked.withColumn("first", F.greatest("free", F.col("n_here") - F.col("n") + 1)).withColumn("last", F.col("pos"))
    held = F.col("n_hits") - F.col("rank") + 1
    cut = starts(tail).where(held >= (F.col("n") + F.col("n_here") - F.col("start")) * share - 1e-9)
    names = [*DOC, "n_here", "n", "start"]
    return starts(whole).select(*names).unionByName(cut.select(*names))


def _near_windows(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """(id, text_hash, pos, h): the shingles from a document's first window to the end of its last."""
    held = cut_lineage(windows.groupBy(*DOC).agg(F.min("start").alias("low"), F.max(F.col("start") + F.col("n")).alias("high")))
    once = _meet(rows, held, "inner", *DOC).dropDuplicates([*DOC])
    return _positions(once, *DOC, "low", "high").where((F.col("pos") >= F.col("low")) & (F.col("pos") < F.col("high"))).select(*DOC, "pos", "h")


def _rarest(bags: DataFrame, least: float) -> DataFrame:
    """(n, h, passage): so many of a passage's rarest shingles that a similar window holds one."""
    shared = bags.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("n", "h")))
    before = F.sum("k").over(Window.partitionBy("passage").orderBy("df", "h").rowsBetween(Window.unboundedPreceding, -1))
    spare = F.col("n") - F.ceil(F.col("n") * least - 1e-9)
    return shared.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") <= spare).select("n", "h", "passage")


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", least: float = 0.8) -> DataFrame:
    """(id, text_hash, item, start_word, similarity) of every document and item it holds.

    Words are runs of letters and digits, in lower case; shingles are five words, compared
    by 64-bit hashes.  A document holds an item if one of its windows of the item's size
    (shorter at the end of the text) reaches ``least`` weighted Jaccard similarity; the best
    window is named, the first of equals.  Null and empty texts, and items of under five
    words, have no shingles and never match; repeated rows give one result row; an empty
    side gives an empty result; other columns are not read.

    Two texts of similarity 0.8 differ in 10 of 64 bits on average and lie beyond the
    radius of 20 with a probability of about 2 in 10,000; closer ones practically never do,
    and items of few distinct shingles do not depend on it.
    """
    named = benchmark.select(c(item).alias("item"), c(item_text).alias("text"), words(c(item_text)).alias("words")).where(F.size("words") >= SHINGLE)
    named = cut_lineage(named.select("item", "text", F.sha2(F.array_join("words", " "), 256).alias("passage")))
    counted = _positions(named.dropDuplicates(["passage"]), "passage").groupBy("passage", F.col("n_here").alias("n"), "h").agg(F.count(F.lit(1)).alias("k"))
    counted = cut_lineage(counted)
    steady = counted.groupBy("passage").agg((F.sum("k") * F.sum("k") / F.sum(F.col("k") * F.col("k")) >= STEADY).alias("steady"))
    bags = cut_lineage(counted.join(steady, "passage"))

    rows = docs.select(c(key).alias("id"), F.coalesce(c(text), F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    sizes = cut_lineage(bags.groupBy("h").agg(F.collect_set("n").alias("sizes")))
    seeds = lookup_join(_positions(rows, *DOC), sizes, ["h"], how="inner")
    hits = seeds.select(*DOC, "n_here", F.explode("sizes").alias("n"), "pos").distinct()
    windows = cut_lineage(_windows(hits, least))

    shingles = _near_windows(rows, windows)
    wanted = windows.withColumn("pos", F.explode(F.sequence("start", F.least(F.col("start") + F.col("n"), F.col("n_here")) - 1)))
    members = cut_lineage(wanted.join(unsent(shingles), _same(wanted, shingles, *DOC, "pos")).select(*[wanted[x] for x in (*WINDOW, "n_here")], "h"))

    marked = cut_lineage(simhash(members.withColumn("k", F.lit(1)), *WINDOW))
    theirs = simhash(bags.where("steady"), "passage", "n").withColumnRenamed("mark", "its_mark").withColumn("b", F.explode(_blocks(F.col("its_mark"))))
    theirs = cut_lineage(theirs.select("passage", "n", "its_mark", "b.block", F.explode(_near_values(F.col("b.block"), F.col("b.value"))).alias("value")))
    ours = marked.select("n", "mark").distinct().withColumn("b", F.explode(_blocks(F.col("mark")))).select("n", "mark", "b.block", "b.value")
    near = ours.join(F.broadcast(theirs) if fits_broadcast(theirs) else unsent(theirs), ["n", "block", "value"]).where(
        F.bit_count(F.col("mark").bitwiseXOR(F.col("its_mark"))) <= RADIUS
    )
    near = cut_lineage(near.select("n", "mark", "passage").distinct())
    by_mark = lookup_join(marked, near, ["n", "mark"], how="inner").select(*WINDOW, "passage")
    rare = cut_lineage(_rarest(bags.where(~F.col("steady")), least))
    by_shingle = lookup_join(members, rare, ["n", "h"], how="inner").select(*WINDOW, "passage").distinct()
    candidates = cut_lineage(by_mark.unionByName(by_shingle))

    pairs = candidates.join(unsent(members), _same(candidates, members, *WINDOW)).select(*[candidates[x] for x in candidates.columns], "n_here", "h")
    counts = cut_lineage(pairs.groupBy(*WINDOW, "n_here", "passage", "h").agg(F.count(F.lit(1)).alias("k")))
    known = cut_lineage(bags.select("passage", "h", F.col("k").alias("its_k")))
    both = lookup_join(counts, known, ["passage", "h"], how="inner").groupBy(*WINDOW, "n_here", "passage").agg(F.sum(F.least("k", "its_k")).alias("both"))
    larger = F.least(F.col("n"), F.col("n_here") - F.col("start")) + F.col("n") - F.col("both")
    checked = cut_lineage(both.withColumn("similarity", F.col("both") / larger).where(F.col("similarity") >= least))
    best = F.min_by("start", F.struct(-F.col("similarity"), F.col("start")))
    of_items = cut_lineage(named.select("item", "passage").distinct())
    return lookup_join(checked, of_items, ["passage"], how="inner").groupBy(*DOC, "item").agg(best.alias("start_word"), F.max("similarity").alias("similarity"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item, all columns kept."""
    found = cut_lineage(leaks(docs, benchmark, key, text, least=least).select("id", "text_hash").distinct())
    mark, its_id, its_hash = (own_name(x, docs.columns) for x in ("text_hash", "leak_id", "leak_hash"))
    found = found.withColumnsRenamed({"id": its_id, "text_hash": its_hash})
    marked = docs.withColumn(mark, F.xxhash64(F.coalesce(c(text), F.lit(""))))
    few = F.broadcast(found) if fits_broadcast(found) else unsent(found)
    return marked.join(few, c(key).eqNullSafe(c(its_id)) & (c(mark) == c(its_hash)), "left_anti").drop(mark)
