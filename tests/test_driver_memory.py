"""Tables that grow with the input never pass through the driver, however small their files are."""

import contextlib

import numpy as np
import pytest

from sparkhunt.functions import whois
from sparkhunt.operators import knn, lookup

_THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@contextlib.contextmanager
def eager_broadcast(spark):
    """Any table whose files look smaller than a gigabyte is broadcast where the code allows it."""
    before = spark.conf.get(_THRESHOLD)
    spark.conf.set(_THRESHOLD, "1g")
    try:
        yield
    finally:
        spark.conf.set(_THRESHOLD, before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_whois_steps_do_not_broadcast(spark):
    rows = spark.createDataFrame([("a", i, x) for i, x in enumerate(["Registrar:", "x", "Domain servers in listed order:", "  ns1.x.org", "", "Whois: y"])], "ip string, line_no int, line string")
    with eager_broadcast(spark):
        lines = whois.whois_multiline(rows)
        values = whois.first_wins_tag(lines)
        report = whois.whois_report(values)
        assert "Broadcast" not in plan_of(lines)
        assert "Broadcast" not in plan_of(report)
        assert "Broadcast" not in plan_of(whois.sorted_tags(whois.whois_tag_rename(values)))
        assert {(r.tag, r.value) for r in report.collect()} == {("registrar", "x"), ("ns", "ns1.x.org")}


def test_windows_of_documents_are_not_broadcast(spark, monkeypatch):
    decontaminate = pytest.importorskip("sparkhunt.llm.decontaminate")
    passage = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(i, f"{'pre ' * i}{passage} after") for i in range(4)] + [(9, "nothing of it is here at all")], "doc_id long, text string")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    plans, cut = [], decontaminate.cut_lineage

    def watched(df):
        if {"id", "start", "rank"} & set(df.columns):
            plans.append(plan_of(df))
        return cut(df)

    monkeypatch.setattr(decontaminate, "cut_lineage", watched)
    monkeypatch.setattr(decontaminate, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(lookup, "fits_broadcast", lambda df: False)
    with eager_broadcast(spark):
        left = decontaminate.decontaminate(docs, items)
        plans.append(plan_of(left))
        assert [r.doc_id for r in left.collect()] == [9]
    assert len(plans) > 5 and not [p for p in plans if "BroadcastHashJoin" in p]


def test_knn_holds_few_rows_of_a_block_pair(spark, monkeypatch):
    rng = np.random.default_rng(5)
    train, test = rng.normal(size=(700, 4)), rng.normal(size=(90, 4))
    train[300:600] = train[:300]  # equal rows, so that ties go by key
    to_df = lambda m: spark.createDataFrame([(i, [float(v) for v in r], i % 3) for i, r in enumerate(m)], "id int, v array<double>, label int")
    for name, value in (("_BLOCK_ROWS", 16), ("_MAX_PIVOTS", 6), ("_NUMBERS_AT_ONCE", 200)):
        monkeypatch.setattr(knn, name, value)
    streamed, cut = [], knn.cut_lineage

    def watched(df):
        if "distance" in df.columns:
            streamed.append(plan_of(df))
        return cut(df)

    monkeypatch.setattr(knn, "cut_lineage", watched)
    with eager_broadcast(spark):
        rows = knn.knn_join(to_df(train), to_df(test), "v", 5, payload=["label"]).collect()
    # vectors travel in rows of their own, never as blocks in one row
    assert len(streamed) == 1 and "MapInArrow" in streamed[0] and "collect_list" not in streamed[0]
    got = {(r.id, r.rank): (r.neighbor, r.label) for r in rows}
    for q in range(len(test)):
        d = np.round(np.sqrt(((train - test[q]) ** 2).sum(1)), 9)
        want = sorted(range(len(train)), key=lambda s: (d[s], s))[:5]
        assert [got[q, i + 1] for i in range(5)] == [(s, s % 3) for s in want]
