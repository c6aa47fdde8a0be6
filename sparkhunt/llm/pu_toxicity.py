"""Toxicity scores by non-negative positive-unlabelled learning.

Classifiers are learned from confirmed toxic documents and from unlabelled text, which
holds toxic documents in a share that is the class prior.  The risk of calling negatives
positive is estimated as the unlabelled risk less the prior's share of the positives, and
may not fall below zero.  Each classifier is a logistic model in numpy, trained inside one
task on a sample of bounded size; scoring reads every text once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkhunt.llm.common import own_name
from sparkhunt.names import c
from sparkhunt.session import cut_lineage

_WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
MODEL = "classifier int, bias double, features array<int>, weights array<double>"


def word_features(word: str) -> tuple[int, ...]:
    """Hashes of a word and of its beginnings, which inflected words share."""
    data = word.encode()
    return (zlib.crc32(b"=" + data) >> 1, *(zlib.crc32(b"^" + word[:n].encode()) >> 1 for n in PREFIXES if len(word) >= n))


def text_features(text: str) -> np.ndarray:
    found: set[int] = set()
    for word in set(_WORD.findall(text.lower())):
        found.update(word_features(word))
    return np.fromiter(sorted(found), np.int32, len(found))


def _sparse(features: list[np.ndarray], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the known features of each document."""
    rows = np.repeat(np.arange(len(features)), [len(x) for x in features])
    flat = np.concatenate(features) if features else np.zeros(0, np.int32)
    at = np.searchsorted(known, flat)
    hit = (at < len(known)) & (known[np.minimum(at, max(len(known) - 1, 0))] == flat) if len(known) else np.zeros(len(flat), bool)
    return rows[hit], at[hit]


def without_copies(features: list[np.ndarray], bands: int = 6, rows: int = 4) -> list[np.ndarray]:
    """The documents that look like no earlier one, by bands of smallest hashes.

    A document copied many times would make all its words look typical.
    """
    odd = np.random.default_rng(5).integers(0, 2**31, bands * rows, dtype=np.uint64) * 2 + 1
    seen: set[tuple] = set()
    out = []
    for x in features:
        if len(x):
            least = [int(((x.astype(np.uint64) * k) & 0xFFFFFFFF).min()) for k in odd]
            marks = {(i, *least[i * rows : (i + 1) * rows]) for i in range(bands)}
            if not marks & seen:
                out.append(x)
            seen |= marks
    return out


def choose_features(positive: list[np.ndarray], unlabelled: list[np.ndarray], most: int, least_z: float) -> np.ndarray:
    """Features that confirmed documents hold more often than unlabelled text does."""
    positive, unlabelled = without_copies(positive), without_copies(unlabelled)
    if not positive:
        return np.zeros(0, np.int32)
    both = np.unique(np.concatenate([*positive, *unlabelled]))
    in_p = np.bincount(np.searchsorted(both, np.concatenate(positive)), minlength=len(both))
    in_u = np.bincount(np.searchsorted(both, np.concatenate(unlabelled)), minlength=len(both)) if unlabelled else np.zeros(len(both))
    n_p, n_u = len(positive), max(len(unlabelled), 1)
    share = (in_p + in_u + 1) / (n_p + n_u + 2)
    z = (in_p / n_p - in_u / n_u) / np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u))
    order = np.argsort(-z, kind="stable")[:most]
    return np.sort(both[order[z[order] >= least_z]])


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, most: int = 20_000, least_z: float = 6.0, rounds: int = 300, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, bias) of one classifier.

    Gradient descent with Adam on ``prior * R_p+ + max(0, R_u- - prior * R_p-)`` under
    the logistic loss; where the second term would be negative, only its ascent is taken.
    """
    known = choose_features(positive, unlabelled, most, least_z)
    (rp, cp), (ru, cu) = _sparse(positive, known), _sparse(unlabelled, known)
    n_p, n_u, k = len(positive), max(len(unlabelled), 1), len(known)
    theta, m, v = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    theta[-1] = np.log(prior / (1 - prior))
    sigmoid = lambda x: 0.5 * (1 + np.tanh(x / 2))

    def pull(rows, columns, by_row):
        return np.append(np.bincount(columns, by_row[rows], minlength=k), by_row.sum())

    for step in range(1, rounds + 1):
        gp = np.bincount(rp, theta[cp], minlength=n_p) + theta[-1]
        gu = np.bincount(ru, theta[cu], minlength=n_u) + theta[-1]
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        toward_negative = pull(ru, cu, sigmoid(gu) / n_u) - pull(rp, cp, prior * sigmoid(gp) / n_p)
        if negative >= 0:
            gradient = pull(rp, cp, -prior * sigmoid(-gp) / n_p) + toward_negative
        else:
            gradient = -toward_negative
        gradient[:-1] += decay * theta[:-1]
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return known, theta[:-1], float(theta[-1])


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", classifiers: int = 3, max_positive: int = 4000, max_unlabelled: int = 12_000, seed: int = 11) -> DataFrame:
    """Learn ``classifiers`` models; returns ``MODEL`` rows.

    Only labels of rows that are not held out are read.  The fit sees at most about
    ``max_positive`` confirmed documents and ``max_unlabelled`` others, each chosen by a
    hash of its key; every classifier gets all of the former and its share of the latter.
    The class prior is the toxic share of the learnable labels.  Null labels and keys are
    ignored, a document is confirmed if one of its labels says so, and without a
    confirmed document there is no model.
    """
    marks = labels.select(c(key).alias("id"), c(label).cast("int").alias("y")).where(F.col("id").isNotNull() & F.col("y").isNotNull())
    marks = cut_lineage(marks.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y")))
    seen = marks.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("p")).first()
    n_docs = docs.count()
    if not seen["p"] or not n_docs:
        return docs.sparkSession.createDataFrame([], MODEL)
    prior = min(max(seen["p"] / seen["n"], 0.001), 0.999)
    draw = F.pmod(F.xxhash64(F.lit(seed), c(key)), F.lit(1 << 40)) / float(1 << 40)
    rows = docs.select(c(key).alias("id"), F.coalesce(c(text), F.lit("")).alias("text"), draw.alias("draw")).where(~held_out(F.col("id")))
    confirmed = marks.where(F.col("y") == 1).select("id")
    p = rows.where(F.col("draw") < min(1.0, max_positive / seen["p"])).join(confirmed, "id", "left_semi")
    u = rows.where(F.col("draw") >= 1 - min(1.0, 1.5 * max_unlabelled / n_docs)).join(confirmed, "id", "left_anti")
    no = F.pmod(F.xxhash64("id"), F.lit(classifiers)).cast("int")
    sample = p.withColumn("classifier", F.explode(F.lit(list(range(classifiers))))).select("classifier", F.lit(1).alias("y"), "text").unionByName(
        u.select(no.alias("classifier"), F.lit(0).alias("y"), "text")
    )
    schema = T.StructType([T.StructField("classifier", T.IntegerType()), T.StructField("y", T.IntegerType()), T.StructField("features", T.ArrayType(T.IntegerType()))])

    def featured(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [text_features(x) for x in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.list_(pa.int32()))], schema.names)

    def learn(rows: pa.Table) -> pa.Table:
        y = rows.column("y").to_numpy()
        features = [x.values.to_numpy() for x in rows.column("features")]
        known, weights, bias = train([f for f, t in zip(features, y, strict=True) if t], [f for f, t in zip(features, y, strict=True) if not t], prior)
        return pa.table(
            {"classifier": pa.array([rows.column("classifier")[0].as_py()], pa.int32()), "bias": [bias], "features": pa.array([known.astype(np.int32)], pa.list_(pa.int32())), "weights": pa.array([weights], pa.list_(pa.float64()))}
        )

    return cut_lineage(sample.mapInArrow(featured, schema).groupBy("classifier").applyInArrow(learn, MODEL))


def score(docs: DataFrame, models: DataFrame, key: str = "doc_id", text: str = "text", name: str = "score") -> DataFrame:
    """Add the mean probability of the classifiers to every row of ``docs``.

    The models are the few rows of :func:`fit` with at most 20,000 features each.  A null
    or empty text gets the score of a text without features; without models every score
    is 0; other columns pass unread, but one called ``name`` is replaced.
    """
    loaded = [(r["bias"], dict(zip(r["features"], r["weights"], strict=True))) for r in models.collect()]
    known = set().union(*(set(w) for _, w in loaded)) if loaded else set()

    class Hits(dict):
        def __missing__(self, word: str) -> tuple[int, ...]:
            if len(self) > 150_000:
                self.clear()
            self[word] = found = tuple(f for f in word_features(word) if f in known)
            return found

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hits = Hits()
        for part in parts:
            out = []
            for whole in part.to_pylist():
                found = set().union(*filter(None, map(hits.__getitem__, set(_WORD.findall(whole.lower()))))) if whole else ()
                logits = [bias + sum(w.get(f, 0.0) for f in sorted(found)) for bias, w in loaded]
                out.append(float(np.mean(0.5 * (1 + np.tanh(np.array(logits) / 2)))) if logits else 0.0)
            yield pa.array(out, pa.float64())

    return docs.withColumn(name, F.arrow_udf(run, "double")(F.coalesce(c(text), F.lit(""))))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with a score under ``threshold``, all columns kept."""
    mark = own_name("score", docs.columns)
    scored = score(docs, fit(docs, labels, key, text, **options), key, text, mark)
    return scored.where(c(mark) < threshold).drop(mark)
