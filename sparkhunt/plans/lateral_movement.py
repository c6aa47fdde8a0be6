"""Lateral-movement detection: by entity clusters and by graph embeddings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkhunt.names import c
from sparkhunt.operators import aggregates as agg
from sparkhunt.operators.classify import auth_features, label_unknown
from sparkhunt.operators.filters import split_by_status, union_train_test
from sparkhunt.operators.graph import adjacency, graph_edges, node_embeddings, random_walks
from sparkhunt.operators.joins import (
    assemble_auth_requests,
    benign_triplets,
    cluster_sides,
    triplet_novelty_join,
    writeback_by_id,
)
from sparkhunt.operators.kmeans import kmeans_assign, kmeans_cluster
from sparkhunt.operators.lookup import lookup_joins
from sparkhunt.session import cut_lineage

RESULT = ("username", "c_usr", "source", "c_src", "destination", "c_dst", "status")


def requests_with_calendar(
    observations: DataFrame, users: DataFrame, connections: DataFrame
) -> DataFrame:
    """Assembled requests with plain names and calendar columns."""
    joined = assemble_auth_requests(observations, users, connections)
    named = (
        joined.withColumn("source", c("src_ref.value"))
        .withColumn("destination", c("dst_ref.value"))
        .withColumn("username", c("user_id"))
    )
    return agg.with_calendar(named)


def scaled_profile(profile: DataFrame, distincts: Sequence[str]) -> tuple[DataFrame, list[str]]:
    features = [*distincts, *agg.PROFILE_FEATURES]
    return agg.minmax_scale(profile, features), features


def _clusters(profile: DataFrame, entity: str, distincts: Sequence[str], k: int, name: str, seed: int, centroids):
    scaled, features = scaled_profile(profile, distincts)
    scaled = cut_lineage(scaled)
    if centroids is not None:
        return kmeans_assign(scaled, features, centroids, name).select(c(entity), name)
    return kmeans_cluster(scaled, features, k, seed, name).select(c(entity), name)


def source_clusters(df: DataFrame, ks: int, seed: int = 0, centroids: DataFrame | None = None) -> DataFrame:
    """(source, c_src): clusters of scaled source profiles."""
    return _clusters(agg.source_profile(df), "source", ["F1"], ks, "c_src", seed, centroids)


def user_clusters(df: DataFrame, ku: int, seed: int = 0, centroids: DataFrame | None = None) -> DataFrame:
    return _clusters(agg.user_profile(df), "username", ["F1", "F2"], ku, "c_usr", seed, centroids)


def destination_clusters(df: DataFrame, kd: int, seed: int = 0, centroids: DataFrame | None = None) -> DataFrame:
    return _clusters(
        agg.destination_profile(df), "destination", ["F1", "F2"], kd, "c_dst", seed, centroids
    )


def score_requests(
    train: DataFrame, test: DataFrame, src: DataFrame, usr: DataFrame, dst: DataFrame
) -> DataFrame:
    """Training rows with their clusters and test rows with the status of their triplet."""
    columns = ["id", *RESULT]
    sides = cluster_sides(src, usr, dst)
    trained = lookup_joins(train, sides, "inner")
    placed = lookup_joins(test, sides)
    scored = triplet_novelty_join(placed, cut_lineage(benign_triplets(trained)))
    return union_train_test(trained.select(*columns), scored.select(*columns))


def lm_cluster_detect(
    observations: DataFrame,
    users: DataFrame,
    connections: DataFrame,
    ku: int,
    ks: int,
    kd: int,
    seed: int = 0,
    centroids: tuple[DataFrame, DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Observations with user, source and destination clusters and a status.

    Profiles are built from benign requests; an unknown request is malicious when its
    triplet of clusters was never seen.  ``centroids`` = (source, user, destination)
    replaces the K-Means fit.
    """
    data = cut_lineage(requests_with_calendar(observations, users, connections))
    train, test = split_by_status(data, "benign"), split_by_status(data, "unknown")
    at = centroids or (None, None, None)
    src = cut_lineage(source_clusters(train, ks, seed, at[0]))
    usr = cut_lineage(user_clusters(train, ku, seed, at[1]))
    dst = cut_lineage(destination_clusters(train, kd, seed, at[2]))
    return writeback_by_id(observations, score_requests(train, test, src, usr, dst), RESULT)


def graph_lm_detect(
    observations: DataFrame,
    users: DataFrame,
    connections: DataFrame,
    walk_length: int,
    classifier: str = "logisticRegression",
    seed: int = 0,
    size: int = 128,
) -> DataFrame:
    """Observations with source, destination, user and the predicted status."""
    data = cut_lineage(assemble_auth_requests(observations, users, connections))
    walks = random_walks(adjacency(graph_edges(data)), walk_length, 1, seed)
    vectors = cut_lineage(node_embeddings(walks, size=size, seed=seed))
    labelled = label_unknown(auth_features(data, vectors), classifier)
    result = labelled.select(
        "id",
        c("src_ref.value").alias("source"),
        c("dst_ref.value").alias("destination"),
        "user_id",
        "status",
    )
    return writeback_by_id(observations, result, ["source", "destination", "user_id", "status"])
