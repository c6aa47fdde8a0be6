"""Key lookups that survive hot keys: size-checked broadcast or salted equi-join.

A lookup joins many rows to a table with one row per key.  When the lookup side was
measured to be small it is broadcast and the big side is not shuffled.  Otherwise the
big side is shuffled by key, and rows of keys that hold a large share of the table are
spread over ``SALTS`` copies of their (single) lookup row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkhunt.names import c

#: Largest lookup table that is broadcast, in bytes of its JSON text.
BROADCAST_BYTES = 32 * 1024 * 1024
#: Copies of the lookup row of a hot key.
SALTS = 64
#: A key is hot when it holds more than one HOT_SHARE-th of all rows.
HOT_SHARE = 500


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df`` as JSON text; one aggregation over the table."""
    row = F.to_json(F.struct(*[c(n) for n in df.columns]))
    total = df.agg(F.sum(F.octet_length(row)).alias("n")).first()["n"]
    return int(total or 0)


def unsent(df: DataFrame) -> DataFrame:
    """``df`` as a side that its join sorts and never broadcasts.

    Spark estimates a stored table by its compressed files, which may be a hundredth of
    its rows: a table that grows with the input would be sent through the driver.
    """
    return df.hint("merge")


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def row_salt(df: DataFrame, salts: int = SALTS) -> Column:
    """Repeatable salt of a row: a hash of its hashable columns."""
    plain = [
        c(f.name)
        for f in df.schema.fields
        if not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    return F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int")


def hot_key_hashes(df: DataFrame, key_sets: Sequence[Sequence[str]], share: int = HOT_SHARE) -> list[list[int]]:
    """For each set of key columns the hashes of keys that hold more than 1/share of the rows.

    One pass over ``df`` with a mergeable heavy-hitter sketch per set; at most
    ``2 * share`` hashes leave each.  A missed key only costs balance, never a result row.
    """
    hashed = df.select(*[F.xxhash64(*[c(k) for k in keys]).alias(f"__h{i}") for i, keys in enumerate(key_sets)])
    sketches = [F.expr(f"approx_top_k(__h{i}, {2 * share}, {20 * share})").alias(f"top{i}") for i in range(len(key_sets))]
    row = hashed.agg(F.count(F.lit(1)).alias("n"), *sketches).first()
    return [[t["item"] for t in row[f"top{i}"] or [] if t["count"] * share > row["n"]] for i in range(len(key_sets))]


def salted_join(
    big: DataFrame,
    keyed: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    found: Sequence[int] | None = None,
    measured: bool = False,
) -> DataFrame:
    """Equi-join ``big`` with ``keyed`` on ``keys``, spreading hot keys.

    ``measured``: the rows of ``keyed`` were found too large to broadcast.

    ``found`` are the hashes of the hot keys, a bounded number by construction; they
    become a list in the plan, and without any the join is a plain one.
    """
    keys = list(keys)
    if found is None:
        (found,) = hot_key_hashes(big, [keys])
    if not found:
        return big.join(unsent(keyed) if measured else keyed, keys, how)
    is_hot = F.xxhash64(*[c(k) for k in keys]).isin(found)
    left = big.withColumn("__salt", F.when(is_hot, row_salt(big)).otherwise(F.lit(0)))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = keyed.withColumn("__salt", F.explode(copies))
    return left.join(unsent(right) if measured else right, [*keys, "__salt"], how).drop("__salt")


def lookup_join(
    big: DataFrame,
    keyed: DataFrame,
    keys: Sequence[str] | str,
    how: str = "left",
    small: bool | None = None,
) -> DataFrame:
    """Join a *stored* lookup table: broadcast when measured small, salted otherwise.

    ``small`` passes on the outcome of :func:`fits_broadcast` when the caller has it.
    """
    return lookup_joins(big, [(keyed, keys, small)], how)


def lookup_joins(
    big: DataFrame, lookups: Sequence[tuple[DataFrame, Sequence[str] | str, bool | None]], how: str = "left"
) -> DataFrame:
    """Join several stored lookup tables (table, keys, small), keys being columns of ``big``.

    The hot keys of all tables that are not broadcast come from one pass over ``big``
    itself, before anything is joined to it.
    """
    sides = [
        (keyed, [keys] if isinstance(keys, str) else list(keys), fits_broadcast(keyed) if small is None else small)
        for keyed, keys, small in lookups
    ]
    wide = [keys for _, keys, fits in sides if not fits]
    found = iter(hot_key_hashes(big, wide) if wide else [])
    for keyed, keys, fits in sides:
        big = big.join(F.broadcast(keyed), keys, how) if fits else salted_join(big, keyed, keys, how, next(found), True)
    return big


def totals_join(
    big: DataFrame,
    totals: DataFrame,
    keys: Sequence[str],
    n_rows: str,
    how: str = "left",
    whole: int | None = None,
) -> DataFrame:
    """Join per-key totals of ``big`` back to its rows.

    ``totals`` already counts the rows per key in ``n_rows``, so its hot keys are read
    from it: a key above 1/HOT_SHARE of all rows, hence at most HOT_SHARE of them.
    ``whole`` is the number of all rows, when the caller knows it.
    """
    if whole is None:
        rows = totals.agg(F.sum(c(n_rows)).alias("n")).select("n").scalar()
    else:
        rows = F.lit(whole)
    hot = totals.where(c(n_rows) * HOT_SHARE > rows).select(
        F.xxhash64(*[c(k) for k in keys]).alias("__h")
    )
    return salted_join(big, totals.drop(n_rows), keys, how, [r["__h"] for r in hot.collect()])
