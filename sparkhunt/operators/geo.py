"""Longest-match location of IPv4 and IPv6 addresses in a table of nested blocks.

Blocks become disjoint pieces first: a sweep in address order keeps a stack of the blocks
that are open, and the top of the stack owns the addresses up to the next change.  The
sweep runs in as many chunks as the sort has partitions; a chunk starts with the stack
that the ones before it leave open.  Addresses then meet the pieces in one sort, where
each takes the last piece that starts at or before it.  A wide block is one row all along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkhunt.functions.ipaddr import ip_key
from sparkhunt.names import c, let
from sparkhunt.session import cut_lineage, fixed_partitions

_PIECE = "low string, high string, latitude double, longitude double"


def network_ends(network: Column) -> Column:
    """(low, high) address keys of a network such as ``10.0.0.0/8``; NULL if it is none.

    Bits after the prefix are ignored.  Without a length the network is one address.
    """
    parts = F.struct(ip_key(F.substring_index(network, "/", 1)).alias("key"), F.try_element_at(F.split(network, "/"), F.lit(2)).alias("bits"))

    def ends(p: Column) -> Column:
        digits = F.substring(p["key"], 2, 32)
        width = F.length(digits) * 4
        bits = F.when(p["bits"].isNull(), width).when(p["bits"].rlike("^[0-9]{1,3}$"), p["bits"].try_cast("int"))
        whole = F.floor(bits / 4).cast("int")
        nibble = F.conv(digits.substr(whole + 1, F.lit(1)), 16, 10).cast("int")
        free = F.element_at(F.array(*map(F.lit, (15, 7, 3, 1))), (bits % 4 + 1).cast("int"))
        after = (width / 4).cast("int") - whole - 1
        digit = lambda n: F.lower(F.hex(n))
        head = F.concat(F.substring(p["key"], 1, 1), digits.substr(F.lit(1), whole))
        low = F.concat(head, digit(nibble.bitwiseAND(F.lit(15) - free)), F.repeat(F.lit("0"), after))
        high = F.concat(head, digit(nibble.bitwiseOR(free)), F.repeat(F.lit("f"), after))
        alone = F.struct(p["key"].alias("low"), p["key"].alias("high"))
        return F.when(bits == width, alone).when(bits < width, F.struct(low.alias("low"), high.alias("high")))

    return let(parts, ends)


def block_ends(blocks_df: DataFrame) -> DataFrame:
    """(low, high, latitude, longitude) of a block table, by address keys.

    The table has ``network``, or ``start_ip`` and ``end_ip`` as addresses or as IPv4
    numbers.  Rows that are no block are left out; of equal blocks one stays.
    """
    if "network" in blocks_df.columns:
        ends = network_ends(c("network"))
    else:
        number = lambda n: F.when(c(n).between(0, 2**32 - 1), F.concat(F.lit("4"), F.lpad(F.lower(F.hex(c(n))), 8, "0")))
        key = lambda n: ip_key(c(n)) if isinstance(blocks_df.schema[n].dataType, T.StringType) else number(n)
        ends = F.struct(key("start_ip").alias("low"), key("end_ip").alias("high"))
    place = F.struct(c("latitude").cast("double").alias("latitude"), c("longitude").cast("double").alias("longitude"))
    spans = blocks_df.select(ends.alias("e"), place.alias("place")).select("e.low", "e.high", "place")
    good = (F.col("low") <= F.col("high")) & (F.substring("low", 1, 1) == F.substring("high", 1, 1))
    return spans.where(good).groupBy("low", "high").agg(F.min("place").alias("place")).select("low", "high", "place.*")


def _after(key: str) -> str:
    """The key of the next address."""
    return f"{key[0]}{int(key[1:], 16) + 1:0{len(key) - 1}x}"


def _before(key: str) -> str:
    return f"{key[0]}{int(key[1:], 16) - 1:0{len(key) - 1}x}"


class _Sweep:
    """Disjoint pieces of blocks that come by (low rising, high falling).

    The stack holds open blocks (high, latitude, longitude); its top answers.  Of blocks
    that cross without nesting, the one that starts last answers where it reaches.
    """

    def __init__(self, stack: list[tuple], at: str | None):
        self.stack, self.at, self.pieces = list(stack), at, []

    def upto(self, low: str | None) -> None:
        """Hand out what the open blocks own before ``low`` (all of it if None)."""
        while self.stack:
            high, *place = self.stack[-1]
            if high < self.at:
                self.stack.pop()
                continue
            if low is not None and low <= self.at:
                return
            # a block of the other version starts behind all of this one's addresses
            last = high if low is None or high < low else _before(low)
            self.pieces.append((self.at, last, *place))
            if low is not None and last != high:
                self.at = low
                return
            self.stack.pop()
            if int(high[1:], 16) + 1 >> 4 * (len(high) - 1):
                self.stack.clear()  # the last address there is
                return
            self.at = _after(high)

    def open(self, low: str, high: str, latitude: float, longitude: float) -> None:
        self.upto(low)
        self.at = low
        self.stack.append((high, latitude, longitude))


def flatten_blocks(blocks_df: DataFrame) -> DataFrame:
    """Disjoint (low, high, latitude, longitude) pieces: the innermost block at each address.

    The driver sees one row per chunk and the blocks open at its end, which are as many
    as blocks are nested there.
    """
    spans = block_ends(blocks_df)
    ordered = fixed_partitions(spans.repartitionByRange("low").sortWithinPartitions(F.asc("low"), F.desc("high")))
    part = F.spark_partition_id()
    firsts = sorted((r.part, r.low) for r in ordered.groupBy(part.alias("part")).agg(F.min("low").alias("low")).collect())
    follows = {p: low for (p, _), (_, low) in zip(firsts, firsts[1:])}
    stacks: dict[int, list[tuple]] = {}
    if follows:
        limits = ordered.sparkSession.createDataFrame(list(follows.items()), "part int, next string")
        left_open = ordered.withColumn("part", part).join(F.broadcast(limits), "part").where("high >= next")
        survivors = left_open.select("part", "low", "high", "latitude", "longitude").collect()
        held: list[tuple] = []
        for (p, _), (after, low) in zip(firsts, firsts[1:]):
            held += [(r.low, r.high, r.latitude, r.longitude) for r in survivors if r.part == p]
            held = [r for r in held if r[1] >= low]
            held.sort(key=lambda r: (r[0], _reversed(r[1])))
            stacks[after] = [r[1:] for r in held]
    starts = dict(firsts)

    def sweep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        state = _Sweep(stacks.get(number, []), starts.get(number))

        def made() -> pa.RecordBatch:
            columns = list(zip(*state.pieces)) or [[]] * 4
            state.pieces = []
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.string(), pa.float64(), pa.float64()))], ["low", "high", "latitude", "longitude"])

        for batch in parts:
            for row in zip(*(x.to_pylist() for x in batch.columns)):
                state.open(*row)
            yield made()
        if number in starts:
            state.upto(follows.get(number))
            yield made()

    return cut_lineage(ordered.mapInArrow(sweep, _PIECE))


def _reversed(key: str) -> str:
    """Sorts the other way round among keys of one version."""
    return key.translate(str.maketrans("0123456789abcdef", "fedcba9876543210"))


def locate(ips: DataFrame, pieces: DataFrame) -> DataFrame:
    """(ip, latitude, longitude) of the addresses (ip) that lie in a piece.

    One range sort of pieces and addresses; a partition starts with the last piece of
    the ones before it, so that neither a wide piece nor a crowded one is repeated.
    """
    points = ips.withColumn("key", ip_key(F.col("ip"))).where("key is not null")
    place = "high string, latitude double, longitude double"
    merged = pieces.selectExpr("low as key", "0 as kind", "cast(null as string) as ip", "high", "latitude", "longitude").unionByName(
        points.selectExpr("key", "1 as kind", "ip", *[f"cast(null as {x.split()[1]}) as {x.split()[0]}" for x in place.split(", ")])
    )
    order = ["key", "kind", "ip"]
    ordered = fixed_partitions(merged.repartitionByRange(*order).sortWithinPartitions(*order))
    lasts = ordered.where("kind = 0").groupBy(F.spark_partition_id().alias("part")).agg(F.max_by(F.struct("high", "latitude", "longitude"), "key").alias("p")).collect()
    ends = sorted((r.part, (r.p.high, r.p.latitude, r.p.longitude)) for r in lasts)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        held = ([p for part, p in ends if part < number] or [("", None, None)])[-1]
        for batch in parts:
            some = [pa.concat_arrays([pa.array([v], x.type), x]) for v, x in zip(held, batch.columns[3:])]
            is_piece = batch.column(1).to_numpy() == 0
            last = np.maximum.accumulate(np.where(is_piece, np.arange(1, batch.num_rows + 1), 0))
            high, latitude, longitude = (x.take(pa.array(last)) for x in some)
            if batch.num_rows:
                held = tuple(x[-1].as_py() for x in (high, latitude, longitude))
            found = pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), high, latitude, longitude], ["key", "ip", "high", "latitude", "longitude"])
            inside = pc.and_(pa.array(~is_piece), pc.less_equal(found.column(0), found.column(2)))
            yield found.filter(inside).select(["ip", "latitude", "longitude"])

    return ordered.mapInArrow(run, "ip string, latitude double, longitude double")


def ip_geolocate(df: DataFrame, blocks_df: DataFrame, attr: str) -> DataFrame:
    """(ip, latitude, longitude) of the distinct addresses found in a block table.

    IPv4 and IPv6; of nested blocks the innermost answers, of equal ones the one with the
    smallest coordinates.  Addresses outside of all blocks, NULLs and texts that are no
    address give no row; see :func:`block_ends` for the table.
    """
    return cut_lineage(locate(df.select(c(attr).alias("ip")).distinct(), flatten_blocks(blocks_df)))
