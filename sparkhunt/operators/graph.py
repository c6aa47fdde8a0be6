"""Access graph: edges, indexed neighbours, random walks, node embeddings."""

from __future__ import annotations

import math

from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkhunt.names import c
from sparkhunt.operators.aggregates import one_value
from sparkhunt.operators.lookup import totals_join
from sparkhunt.operators.ordering import row_positions
from sparkhunt.session import cut_lineage

#: Walk steps between two checkpoints.
_STEPS_PER_CUT = 8


def graph_edges(
    df: DataFrame, src: str = "src_ref.value", dst: str = "dst_ref.value", user: str = "user_id"
) -> DataFrame:
    """Undirected host-user edges, both directions, once each."""
    hosts = df.select(c(src).alias("src"), c(user).alias("dst")).unionAll(
        df.select(c(dst).alias("src"), c(user).alias("dst"))
    )
    hosts = hosts.where(F.col("src").isNotNull() & F.col("dst").isNotNull()).distinct()
    return hosts.unionAll(hosts.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def adjacency(edges_df: DataFrame) -> DataFrame:
    """(node, pos, neighbor, degree, neighbor_degree): neighbours numbered in sorted order.

    One row per edge instead of one array per node: the neighbours of a hub stay spread
    over the cluster, in the sort as well as in every walk step.
    """
    placed = row_positions(edges_df.select(F.col("src").alias("node"), F.col("dst").alias("neighbor")),
                           ["node", "neighbor"], "__at")
    placed = cut_lineage(placed)
    degrees = cut_lineage(
        placed.groupBy("node").agg(
            F.min("__at").alias("__start"),
            F.count(F.lit(1)).alias("degree"),
        )
    )
    own = totals_join(placed, degrees.withColumn("__rows", F.col("degree")), ["node"], "__rows")
    far = degrees.select(
        F.col("node").alias("neighbor"),
        F.col("degree").alias("neighbor_degree"),
        F.col("degree").alias("__rows"),
    )
    return totals_join(own, far, ["neighbor"], "__rows").select(
        "node", (F.col("__at") - F.col("__start")).alias("pos"), "neighbor", "degree", "neighbor_degree"
    )


def walk_starts(nodes_df: DataFrame, num_walks: int) -> DataFrame:
    """``num_walks`` walks per node: (walk_id, step, node, degree, path)."""
    numbered = nodes_df.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(num_walks))))
    return numbered.select(
        F.concat("node", F.lit("#"), F.col("n").cast("string")).alias("walk_id"),
        F.lit(1).alias("step"),
        "node",
        "degree",
        F.array("node").alias("path"),
    )


def walk_choice(seed: int, walk_id: Column, step: Column, degree: Column) -> Column:
    """Repeatable choice of a neighbour position."""
    text = F.concat_ws("|", F.lit(str(seed)), walk_id, step.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % degree


def walk_neighbor_join(walks_df: DataFrame, adj_df: DataFrame, seed: int = 0) -> DataFrame:
    """One step of every walk: join its node with the neighbour at the chosen position.

    The join key is (node, position), so walks that stand on a hub are spread over the
    hub's edges.
    """
    chosen = walks_df.withColumn(
        "pos", walk_choice(seed, F.col("walk_id"), F.col("step"), F.col("degree"))
    )
    edges = adj_df.select("node", "pos", "neighbor", "neighbor_degree")
    return chosen.join(edges, ["node", "pos"]).select(
        "walk_id",
        (F.col("step") + 1).alias("step"),
        F.col("neighbor").alias("node"),
        F.col("neighbor_degree").alias("degree"),
        F.array_append("path", F.col("neighbor")).alias("path"),
    )


def random_walks(
    adj_df: DataFrame, walk_length: int, num_walks: int = 1, seed: int = 0
) -> DataFrame:
    """(walk_id, path): walks of ``walk_length`` nodes from every node."""
    adj = cut_lineage(adj_df)
    nodes = adj.where("pos = 0").select("node", "degree")
    walks = walk_starts(nodes, num_walks)
    for step in range(1, walk_length):
        walks = walk_neighbor_join(walks, adj, seed)
        if step % _STEPS_PER_CUT == 0:
            walks = cut_lineage(walks)
    return walks.select("walk_id", "path")


def _context_pairs(walks_df: DataFrame, window: int) -> DataFrame:
    """(u, v, n): how often v stands within ``window`` steps of u in a walk."""
    placed = walks_df.select("path", F.posexplode("path").alias("i", "u"))
    first = F.greatest(F.col("i") - window, F.lit(0))
    around = placed.select(
        "u", (F.col("i") - first).alias("own"), F.posexplode(F.slice("path", first + 1, F.col("i") - first + 1 + window)).alias("j", "v")
    )
    return around.where("j <> own").groupBy("u", "v").agg(F.count(F.lit(1)).alias("n"))


def node_signs(node: Column, size: int, seed: int) -> list[Column]:
    """``size`` repeatable signs of a node, 16 from each four digits of its MD5 sums."""
    signs = []
    for block in range(-(-size // 128)):
        digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(str(block)), node))
        for group in range(8):
            bits = F.conv(F.substring(digest, 4 * group + 1, 4), 16, 10).cast("int")
            signs += [(bits, bit) for bit in range(16)]
    return [F.getbit(bits, F.lit(bit)) * 2 - 1 for bits, bit in signs[:size]]


def node_embeddings(walks_df: DataFrame, size: int = 128, window: int = 5, seed: int = 0) -> DataFrame:
    """(node, vector): positive pointwise mutual information of nodes and their contexts,
    projected to ``size`` dimensions by repeatable random signs.

    Nodes of like neighbourhoods get like vectors, as from a skip-gram model, which
    factors the same matrix; but all steps are keyed sums, nothing is kept on the driver.
    """
    pairs = cut_lineage(_context_pairs(walks_df, window))
    nodes = cut_lineage(pairs.groupBy("u").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("__rows")))
    whole = one_value(nodes, F.sum("total"))
    first = totals_join(pairs, nodes.withColumnRenamed("total", "n_u"), ["u"], "__rows", "inner")
    # co-occurrence is symmetric: a node is a context as often as it has contexts
    both = totals_join(first, nodes.withColumnsRenamed({"u": "v", "total": "n_v"}), ["v"], "__rows", "inner")
    weighed = both.withColumn("__all", whole).select(
        "u", "v", F.greatest(F.log(F.col("n") * F.col("__all") / (F.col("n_u").cast("double") * F.col("n_v"))), F.lit(0.0)).alias("p")
    )
    signs = F.array(*node_signs(F.col("v"), size, seed)).alias("signs")
    signed = weighed.select("u", "p", signs)
    sums = signed.groupBy("u").agg(*[F.sum(F.col("p") * F.col("signs")[k]).alias(f"x{k}") for k in range(size)])
    return sums.select(F.col("u").alias("node"), F.array(*[F.col(f"x{k}") / math.sqrt(size) for k in range(size)]).alias("vector"))


def skipgram_embeddings(
    walks_df: DataFrame,
    size: int = 128,
    window: int = 5,
    epochs: int = 3,
    seed: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """(node, vector): Spark's skip-gram model, for graphs whose model fits the driver.

    Spark keeps two rows of ``size`` floats per node on the driver; use
    :func:`node_embeddings` where the number of nodes has no bound.
    """
    if partitions is None:
        partitions = 1 + walks_df.count() // 50_000
    model = Word2Vec(
        vectorSize=size,
        windowSize=window,
        maxIter=epochs,
        minCount=0,
        seed=seed,
        numPartitions=partitions,
        inputCol="path",
        outputCol="v",
    ).fit(walks_df)
    return model.getVectors().select(
        F.col("word").alias("node"), vector_to_array("vector").alias("vector")
    )
