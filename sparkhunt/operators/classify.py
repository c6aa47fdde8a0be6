"""Classifiers of authentication requests on embedding features."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    LinearSVC,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkhunt.functions.timeparts import epoch_seconds
from sparkhunt.names import c
from sparkhunt.operators import boosting, knn, newton
from sparkhunt.operators.filters import split_by_status, union_labeled
from sparkhunt.operators.lookup import fits_broadcast, lookup_joins, unsent
from sparkhunt.session import cut_lineage

RESULT_COLUMNS = ("id", "first_observed", "user_id", "src_ref.value", "dst_ref.value", "status")


def status_code(status: Column) -> Column:
    """0 for benign, 1 for anything else."""
    return F.when(status == "benign", 0).otherwise(1)


def status_of_code(code: Column) -> Column:
    return F.when(code == 0, "benign").otherwise("malicious")


def auth_features(df: DataFrame, emb_df: DataFrame) -> DataFrame:
    """Add ``features``: embeddings of source, destination and user, and the epoch.

    Both sides are stored tables; the features, which are a hundred times as wide as a
    request, are not meant to be: each use joins them again.  Where the embeddings are too
    many to broadcast, each end takes those of its own nodes, and the ends whose nodes are
    few come last, so that no vector that is joined already is shuffled for them.
    """
    small = fits_broadcast(emb_df)  # measured once for the three joins
    ends = (("src_ref.value", "__s"), ("dst_ref.value", "__d"), ("user_id", "__u"))
    sides = []
    for attr, name in ends:
        side = emb_df.select(F.col("node").alias(attr), F.col("vector").alias(name))
        if not small:
            side = cut_lineage(side.join(unsent(df.select(c(attr)).distinct()), attr, "left_semi"))
        sides.append((side, attr, small or fits_broadcast(side)))
    out = lookup_joins(df, sorted(sides, key=lambda side: side[2]), "inner")
    epoch = F.array(epoch_seconds(c("first_observed")).cast("double"))
    return out.withColumn("features", F.concat("__s", "__d", "__u", epoch)).drop("__s", "__d", "__u")


def _fit_predict(stages: list, train_df: DataFrame, test_df: DataFrame) -> DataFrame:
    vectors = lambda df: df.withColumn("__raw", array_to_vector(c("features")))
    model = Pipeline(stages=stages).fit(vectors(train_df))
    predicted = model.transform(vectors(test_df))
    return predicted.select(
        *[c(n) for n in test_df.columns], F.col("__prediction").cast("int").alias("prediction")
    )


def _scaler() -> StandardScaler:
    return StandardScaler(inputCol="__raw", outputCol="__x", withMean=True, withStd=True)


def classify_logistic(train_df: DataFrame, test_df: DataFrame) -> DataFrame:
    """Logistic regression with half the squared weights as penalty, features scaled."""
    model = newton.fit(train_df, "features", "label")
    return test_df.withColumn("prediction", (model.log_odds(c("features")) > 0).cast("int"))


def classify_randomforest(
    train_df: DataFrame, test_df: DataFrame, trees: int = 100, seed: int = 0, depth: int = 30
) -> DataFrame:
    """Random forest; ``depth`` is by default the deepest that Spark grows.

    The node of each row in each tree is kept from pass to pass: rows do not run through all
    trees from the root again, and the trees are not sent out for every pass.
    """
    clf = RandomForestClassifier(
        featuresCol="__raw", labelCol="label", predictionCol="__prediction", numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True
    )
    return _fit_predict([clf], train_df, test_df)


def classify_boosted(train_df: DataFrame, test_df: DataFrame, rounds: int = 100, depth: int = 6) -> DataFrame:
    """Boosted trees with second-order gains, by default 100 rounds of depth 6."""
    model = boosting.fit(train_df, "features", "label", rounds, depth)
    return test_df.withColumn("prediction", (model.log_odds(c("features")) > 0).cast("int"))


def rbf_features(df: DataFrame, attr: str, size: int, gamma: float, width: int, seed: int) -> DataFrame:
    """Replace a vector column by random Fourier features of an RBF kernel."""
    rng = np.random.default_rng(seed)
    weights = rng.normal(scale=np.sqrt(2.0 * gamma), size=(width, size))
    phase = rng.uniform(0.0, 2.0 * np.pi, size)

    @F.pandas_udf("array<double>")
    def project(vectors: pd.Series) -> pd.Series:
        x = np.stack([np.asarray(v, dtype=float) for v in vectors])
        return pd.Series(list(np.sqrt(2.0 / size) * np.cos(x @ weights + phase)))

    return df.withColumn(attr, project(c(attr)))


def classify_svm(
    train_df: DataFrame, test_df: DataFrame, fourier: int = 256, seed: int = 0
) -> DataFrame:
    """Linear SVM on scaled features, by default after an RBF kernel projection."""
    clf = LinearSVC(featuresCol="__raw", labelCol="label", predictionCol="__prediction", maxIter=50)
    vectors = lambda df: df.withColumn("__raw", array_to_vector(c("features")))
    scaler = _scaler().fit(vectors(train_df))
    scaled = lambda df: (
        scaler.transform(vectors(df))
        .withColumn("__all", c("features"))
        .withColumn("features", vector_to_array("__x"))
        .drop("__raw", "__x")
    )
    train, test = scaled(train_df), scaled(test_df)
    if fourier:
        width = train_df.select(F.size("features").alias("n")).first()["n"]
        train, test = (
            rbf_features(d, "features", fourier, 1.0 / width, width, seed) for d in (train, test)
        )
    # the fit keeps its own blocks of the rows it reads
    out = _fit_predict([clf], train.select("features", "label"), test)
    return out.withColumn("features", F.col("__all")).drop("__all")


def classify_knn(train_df: DataFrame, test_df: DataFrame, k: int = 5) -> DataFrame:
    """Majority of the k nearest training rows on scaled features."""
    vectors = lambda df: df.withColumn("__raw", array_to_vector(c("features")))
    scaler = _scaler().fit(vectors(train_df))
    scaled = lambda df: scaler.transform(vectors(df)).withColumn("__sv", vector_to_array("__x"))
    votes = knn.classify_knn(scaled(train_df), scaled(test_df), k, vec="__sv")
    return test_df.join(votes, "id")


CLASSIFIERS = {
    "svm": classify_svm,
    "knn": classify_knn,
    "xgboost": classify_boosted,
    "logisticRegression": classify_logistic,
    "randomforest": classify_randomforest,
}


def label_unknown(df: DataFrame, classifier: str = "logisticRegression") -> DataFrame:
    """Predict the status of ``unknown`` rows from benign and malicious ones; all rows."""
    known = union_labeled(split_by_status(df, "benign"), split_by_status(df, "malicious"))
    train = known.withColumn("label", status_code(c("status")))
    test = split_by_status(df, "unknown")
    predicted = CLASSIFIERS[classifier](train, test).withColumn(
        "status", status_of_code(F.col("prediction"))
    )
    columns = [c(n) for n in RESULT_COLUMNS]
    return union_labeled(known.select(*columns), predicted.select(*columns))
