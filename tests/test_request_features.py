"""The features of requests are joined where they are used, and never written."""

import datetime
import importlib

import pytest
from pyspark.sql import functions as F

from queryset import QUERIES, q_graph
from queryset.views import Tables
from sparkhunt.operators import boosting, classify
from sparkhunt.plans import lateral_movement

STATUS = ["benign", "malicious", "unknown", "benign"]


def requests(spark):
    rows = [(f"r{i}", f"u{i % 5}", f"h{i % 7}", f"h{(3 * i) % 11}", STATUS[i % 4], f"2024-01-01T00:00:{i % 60:02d}.000Z") for i in range(80)]
    return spark.createDataFrame(rows, "id string, user_id string, s string, d string, status string, first_observed string").withColumnsRenamed({"s": "src_ref.value", "d": "dst_ref.value"})


def written(monkeypatch, *modules):
    columns = []
    for module in modules:
        cut = module.cut_lineage

        def watched(df, cut=cut):
            columns.append(df.columns)
            return cut(df)

        monkeypatch.setattr(module, "cut_lineage", watched)
    return columns


def test_features_do_not_depend_on_how_embeddings_are_joined(spark, monkeypatch):
    nodes = spark.createDataFrame([(f"{k}{i}", [float(i), float(ord(k))]) for k in "uh" for i in range(9)], "node string, vector array<double>")
    found = []
    for fits in (lambda df: True, lambda df: False, lambda df: "user_id" not in df.columns and "node" not in df.columns):
        monkeypatch.setattr(classify, "fits_broadcast", fits)
        rows = classify.auth_features(requests(spark), nodes).select("id", "features").collect()
        found.append(sorted((r.id, tuple(r.features)) for r in rows))
    assert found[0] == found[1] == found[2] and 0 < len(found[0]) < 80


def test_detection_writes_no_features(spark, monkeypatch):
    columns = written(monkeypatch, lateral_movement, classify)
    rows = requests(spark)
    out = lateral_movement.graph_lm_detect(rows.select("id", "first_observed"), rows.select("id", "user_id"), rows.drop("user_id", "first_observed"), 3, size=8)
    assert {r.status for r in out.collect()} <= {"benign", "malicious"} and out.count() == 80
    assert columns and not [x for x in columns if "features" in x]


@pytest.mark.parametrize("name", ["classify_logistic", "classify_svm"])
def test_queries_write_no_features(spark, monkeypatch, tmp_path, name):
    at = datetime.datetime(2024, 1, 1)
    rows = [(i, at + datetime.timedelta(seconds=i), i % 9, "error" if i % 3 == 0 else "view", 1.0, "") for i in range(200)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    columns = written(monkeypatch, q_graph, classify)
    train, test = q_graph._split(Tables(spark, str(tmp_path)))
    out = getattr(importlib.import_module("sparkhunt.operators.classify"), name)(train, test)
    assert out.select("prediction").where(F.col("prediction").isin(0, 1)).count() == test.count() > 0
    assert columns and not [x for x in columns if "features" in x]


def test_boosted_query_writes_bins_of_one_byte_and_no_features(spark, monkeypatch, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    rows = [(i, at + datetime.timedelta(seconds=i), i % 9, "error" if i % 3 == 0 else "view", 1.0, "") for i in range(200)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    columns, widths, cut = [], [], boosting.cut_lineage

    def watched(df):
        table = cut(df)
        columns.append(df.columns)
        if "bins" in df.columns:
            widths.append(table.select(F.max(F.octet_length("bins"))).first()[0])
        return table

    for module in (q_graph, classify, boosting):
        monkeypatch.setattr(module, "cut_lineage", watched)
    assert QUERIES["classify_boosted_small"](spark, str(tmp_path)).count() > 0
    assert widths == [385] and not [x for x in columns if "features" in x]


def test_forest_keeps_the_nodes_of_rows(spark, monkeypatch):
    rows = spark.createDataFrame([(i, [float(i % 7), float(i % 5)], int(i % 7 > 3)) for i in range(60)], "id int, features array<double>, label int")
    made, plain = [], classify.RandomForestClassifier
    monkeypatch.setattr(classify, "RandomForestClassifier", lambda **given: made.append(given) or plain(**given))
    predicted = lambda: sorted((r.id, r.prediction) for r in classify.classify_randomforest(rows, rows.drop("label"), trees=5, depth=4).collect())
    kept = predicted()
    assert made[0]["cacheNodeIds"]
    monkeypatch.setattr(classify, "RandomForestClassifier", lambda **given: plain(**{**given, "cacheNodeIds": False}))
    assert predicted() == kept
