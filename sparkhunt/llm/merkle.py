"""Merkle manifest of a table: levels of hashes, checked by a recursive query that climbs.

The levels are built bottom up and stored as rows that name their parent.  A recursive
query then takes every leaf to the root: at each step it appends the siblings that stand
there and folds the leaf's hash with them.  The leaves below one node climb in one row,
since their way up is the same; each keeps a hash of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkhunt.llm.common import with_settings
from sparkhunt.names import c
from sparkhunt.operators.lookup import lookup_join
from sparkhunt.operators.ordering import row_positions
from sparkhunt.session import cut_lineage, discard

#: Children of a node.
WIDTH = 8
#: A node's number is its level, in the bits above these, and its first place there.
_PLACE_BITS = 48
#: Levels from here on stand above the groups' roots.
_UPPER = 100
_DIGEST_BYTES = 32


def field_hash(fields: list[Column]) -> Column:
    """Hash of a row: of each field ``-`` if null, else its UTF-8 bytes, ``:`` and itself."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def joined_hash(digests: Column) -> Column:
    """Hash of digests that stand one after the other, as lower-case hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(digests)), 256))


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _without(run: Column, place: Column) -> Column:
    """A run of digests without the one at ``place``."""
    return F.concat(run.substr(F.lit(1), place * _DIGEST_BYTES), run.substr((place + 1) * _DIGEST_BYTES + 1, F.octet_length(run)))


@dataclass
class Tree:
    """A built tree: its leaves, the runs of its nodes, its groups, and its root (hex).

    ``leaves``: ``pos``, ``first`` (the group's first position), ``parent``, ``place`` in
    the parent's run, ``key``, ``leaf`` and ``start``.  ``runs``: ``node``, ``parent``
    (null at the root), ``place`` there and ``run``, the digests of the node's children.
    """

    leaves: DataFrame
    runs: DataFrame
    groups: DataFrame
    root: str | None


def _node(level: int, place: Column) -> Column:
    return F.lit(level << _PLACE_BITS) + place


def _climb_levels(current: DataFrame, most: int, level: int) -> tuple[list[DataFrame], DataFrame]:
    """Runs of all levels above ``current`` (first, number, at, n, digest) and the groups' roots.

    ``n`` is the number of nodes that the group has on this level, ``most`` the largest.
    """
    runs, roots = [], [current.where("n = 1").select("first", "digest")]
    while most > 1:
        level, most = level + 1, -(-most // WIDTH)
        members = F.array_sort(F.collect_list(F.struct("at", "digest")))
        made = cut_lineage(
            current.where("n > 1")
            .groupBy("first", "number", F.expr(f"at div {WIDTH}").alias("at"), F.expr(f"(n + {WIDTH - 1}) div {WIDTH}").alias("n"))
            .agg(members.alias("m"))
            .select("first", "number", "at", "n", F.aggregate("m", F.lit(b""), lambda acc, x: F.concat(acc, x.digest)).alias("run"))
            .withColumn("digest", joined_hash(F.col("run")))
            .withColumn("level", F.lit(level))
        )
        runs.append(made)
        current = made.select("first", "number", "at", "n", "digest")
        roots.append(current.where("n = 1").select("first", "digest"))
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return runs, found


def build_tree(docs: DataFrame, key: str, group: str, leaf: Column, start: Column) -> Tree:
    """Hash the rows of ``docs`` into leaves and build all levels above them.

    ``leaf`` is a row's digest, ``start`` the digest that the check later starts from.
    Leaves of a group stand by key (null first; rows that repeat a key by their digest),
    groups by name (null first, bytewise).  Every level is one aggregation by (group,
    place div 8) and an eighth of the one below; the rows' order comes from a range sort,
    so that a group may hold any share of the table.  No row gives no root.
    """
    rows = cut_lineage(
        docs.select(
            c(key).alias("key"),
            F.coalesce(F.concat(F.lit("+"), c(group).cast("string")), F.lit("")).alias("group"),
            leaf.alias("leaf"),
            start.alias("start"),
            F.monotonically_increasing_id().alias("row"),  # parts equal rows in the range sort
        )
    )
    placed = cut_lineage(row_positions(rows, ["group", "key", "leaf", "row"]))
    sizes = placed.groupBy("group").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = cut_lineage(row_positions(sizes, ["group"], "number"))
    most, count = groups.agg(F.max("n"), F.count(F.lit(1))).first()
    most = most or 0
    leaves = lookup_join(placed, groups.select("group", "first", "n", "number"), "group", how="inner")
    leaves = cut_lineage(leaves.withColumn("at", F.col("pos") - F.col("first")))
    runs, roots = _climb_levels(leaves.select("first", "number", "at", "n", F.col("leaf").alias("digest")), most, 0)
    groups = cut_lineage(groups.select("first", "number").join(roots.withColumnRenamed("digest", "subroot"), "first"))
    zero = F.lit(0).cast("long")
    heads = groups.select(zero.alias("first"), zero.alias("number"), F.col("number").alias("at"), F.lit(count).cast("long").alias("n"), F.col("subroot").alias("digest"))
    upper, top = _climb_levels(heads, count, _UPPER)
    root = top.select(_text(F.col("digest")).alias("d")).first() if count else None

    def above(level: int, number: Column, at: Column, n: Column, base: Column) -> tuple[Column, Column]:
        """Parent and place of the node at ``at`` of ``n`` nodes of a level of one group."""
        inside = _node(level + 1, base + F.floor(at / WIDTH))
        alone = F.when(F.lit(count > 1), _node(_UPPER + 1, F.floor(number / WIDTH)))
        place = F.when(n > 1, at).otherwise(number) % WIDTH
        return F.when(n > 1, inside).otherwise(alone).cast("long"), place.cast("int")

    stored = []
    for level, made in enumerate(runs, 1):
        parent, place = above(level, F.col("number"), F.col("at"), F.col("n"), F.col("first"))
        stored.append(made.select(_node(level, F.col("first") + F.col("at")).alias("node"), parent.alias("parent"), place.alias("place"), "run"))
    for level, made in enumerate(upper, _UPPER + 1):
        parent = F.when(F.col("n") > 1, _node(level + 1, F.floor(F.col("at") / WIDTH))).cast("long")
        stored.append(made.select(_node(level, F.col("at")).alias("node"), parent.alias("parent"), (F.col("at") % WIDTH).cast("int").alias("place"), "run"))
    spark = docs.sparkSession
    nodes = spark.createDataFrame([], "node long, parent long, place int, run binary")
    for more in stored:
        nodes = nodes.unionByName(more)
    parent, place = above(0, F.col("number"), F.col("at"), F.col("n"), F.col("first"))
    linked = leaves.select("pos", "first", parent.alias("parent"), place.alias("place"), "key", "leaf", "start")
    tree = Tree(cut_lineage(linked), cut_lineage(nodes), groups, root.d if root else None)
    discard(rows, placed, leaves, *runs, *upper)
    return tree


#: One row for the leaves below a node; ``way`` holds the node's run, then all siblings.
_CLIMB = f"""
with recursive climb (up, place, members, way) as (
  select r.parent, r.place, transform(b.members, m -> struct(m.key, m.first, m.place, {{fold_own}} as held)), r.run
  from {{bottoms}} b join {{runs}} r on r.node = b.parent
  union all
  select r.parent, r.place, transform(c.members, m -> struct(m.key, m.first, m.place, {{fold}} as held)),
    concat(c.way, substring(r.run, 1, c.place * {_DIGEST_BYTES}), substring(r.run, (c.place + 1) * {_DIGEST_BYTES} + 1))
  from climb c join {{runs}} r on r.node = c.up
)
select members, way from climb where up is null
"""


def _fold(place: str, held: str) -> str:
    before = f"substring(r.run, 1, {place} * {_DIGEST_BYTES})"
    after = f"substring(r.run, ({place} + 1) * {_DIGEST_BYTES} + 1)"
    return f"unhex(sha2(lower(hex(concat({before}, {held}, {after}))), 256))"


def climb(tree: Tree) -> DataFrame:
    """(key, first, leaf, proof, folded) of every leaf, by one recursive query.

    ``proof`` is the hash of all siblings on the way, ``folded`` the root that follows
    from the leaf's ``start``.  The recursion has one step per level; its limit of rows
    is lifted while it runs, as each step has an eighth of the leaves.
    """
    spark = tree.leaves.sparkSession
    below = tree.leaves.where("parent is not null")
    bottoms = below.groupBy("parent").agg(F.collect_list(F.struct("key", "first", "place", "start")).alias("members"))
    query = _CLIMB.replace("{fold_own}", _fold("m.place", "m.start")).replace("{fold}", _fold("c.place", "m.held"))
    with with_settings(spark, {"spark.sql.cteRecursionRowLimit": "-1"}):
        arrived = cut_lineage(spark.sql(query, bottoms=bottoms, runs=tree.runs))
    own = arrived.select(F.explode("members").alias("m"), "way").select("m.*", "way")
    leaf = F.col("way").substr(F.col("place") * _DIGEST_BYTES + 1, F.lit(_DIGEST_BYTES))
    climbed = own.select("key", "first", leaf.alias("leaf"), joined_hash(_without(F.col("way"), F.col("place"))).alias("proof"), F.col("held").alias("folded"))
    # the only leaf of a table is its own root
    alone = tree.leaves.where("parent is null").select("key", "first", "leaf", F.unhex(F.sha2(F.lit(""), 256)).alias("proof"), F.col("start").alias("folded"))
    return climbed.unionByName(alone)


def verify(docs: DataFrame, fields: list[str], tampered: dict[str, Column], where: Column, key: str = "doc_id", group: str = "lang") -> DataFrame:
    """Build the tree of ``docs`` over ``fields`` and check every row against it.

    Where ``where`` holds, the check starts from the row with the columns of ``tampered``
    put in; elsewhere (also where it is null) from the row itself.  Returns the key,
    ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of the tree as built), ``folded_root``
    and ``verified`` for every row, repeated ones too.  Nulls in any field count as ``-``;
    an empty text as ``0:``; an empty table gives no row.  Columns that are not in
    ``fields`` are not read, whatever they are called.
    """
    leaf = field_hash([c(f) for f in fields])
    changed = field_hash([tampered.get(f, c(f)) for f in fields])
    tree = build_tree(docs, key, group, leaf, F.when(where, changed).otherwise(leaf))
    named = lookup_join(climb(tree), tree.groups.select("first", "subroot"), "first", how="inner")
    root = F.lit(tree.root)
    return named.select(
        F.col("key").alias(key),
        _text(F.col("leaf")).alias("leaf"),
        _text(F.col("subroot")).alias("subroot"),
        root.alias("root"),
        _text(F.col("proof")).alias("proof_sha256"),
        _text(F.col("folded")).alias("folded_root"),
        (_text(F.col("folded")) == root).alias("verified"),
    )


def manifest(tree: Tree, location: str) -> None:
    """Keep the tree: its parent-linked nodes and its leaves as two tables in a folder."""
    tree.runs.write.parquet(f"{location}/nodes")
    tree.leaves.select("pos", "key", "parent", "place", "leaf").write.parquet(f"{location}/leaves")
