import hashlib

import pytest
from pyspark.sql import functions as F

from sparkhunt.llm import warc
from sparkhunt.llm.exact_dedup import DigestIndex
from sparkhunt.session import scratch_path
from tests.llm.helpers import docs_table

LONG = "very long " * 60_000


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_equal_texts_keep_the_largest_id(spark):
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, LONG), (6, LONG), (7, "A"), (2, "a"), (None, "a"), (None, "z")]
    index = DigestIndex(spark, scratch_path(spark, "t"), buckets=4)
    out = index.ingest(docs_table(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.text_sha256) for r in out) == sorted(
        (k or 0, {"a": 2, "": 4, LONG: 6, "A": 7, "z": 0}[t or ""], {"a": 4, "": 2, LONG: 2, "A": 1, "z": 1}[t or ""], sha(t)) for k, t in rows
    )
    assert sorted((r.doc_id or 0, r.text_sha256) for r in out if r.kept) == sorted([(2, sha("a")), (4, sha("")), (6, sha(LONG)), (7, sha("A")), (0, sha("z"))])


def test_a_later_batch_is_held_against_the_index(spark):
    place = scratch_path(spark, "t")
    DigestIndex(spark, place, buckets=4).ingest(docs_table(spark, [(1, "a"), (2, "b")]))
    index = DigestIndex(spark, place, buckets=4)  # attached again
    out = {r.doc_id: (r.keep_id, r.kept) for r in index.ingest(docs_table(spark, [(8, "a"), (9, "c")])).collect()}
    assert out == {8: (1, False), 9: (9, True)}
    assert index.rows().count() == 3
    plan = index.rows().groupBy("digest").count()._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning" not in plan  # the buckets serve the grouping
    assert index.ingest(docs_table(spark, [])).count() == 0


PAGES = "page_id long, url string, html string, key string"


@pytest.fixture(scope="module")
def archive(spark):
    body = "x" * 120
    rows = [(3, "http://a/ä b\r\n", body), (1, None, body), (2, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (7, "u", LONG), (8, "v", "é" * 60), (1, "again", body), (None, "w", body)]
    folder = scratch_path(spark, "warc")
    pages = spark.createDataFrame([(*r, "k") for r in rows], PAGES)
    manifest = warc.write_bundles(pages, folder, frame_bytes=300)
    return rows, folder, manifest


def test_archives_give_back_what_was_written(spark, archive):
    rows, folder, _ = archive
    out = warc.read_bundles(spark, folder).collect()
    first = {sha("x" * 120): 1, sha("é" * 60): 8, sha(LONG): 7}
    want = []
    for key, url, html in rows:
        refers = first.get(sha(html)) if first.get(sha(html)) not in (None, key) else None
        want.append((str(key), url or "", len((html or "").encode()), sha(html), "revisit" if refers else "response", str(refers)))
    got = [(str(r.key), r.target_uri or "", r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in out]
    assert sorted(got) == sorted(want)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in out)
    assert {bytes(r.payload).decode() for r in out if r.key == "7"} == {LONG}


def test_records_are_fetched_by_frame_and_offset(spark, archive):
    _, folder, manifest = archive
    assert manifest.agg(F.max("frame")).first()[0] > 0
    out = warc.fetch_records(spark, folder, spark.createDataFrame([("7",), ("2",), ("99",)], "key string")).collect()
    assert sorted((r.key, r.payload_bytes) for r in out) == [("2", 5), ("7", len(LONG))]


def test_the_seek_table_covers_the_file(spark, archive):
    _, folder, manifest = archive
    name = manifest.first().bundle
    reader = warc.BundleReader(folder, name)
    start, packed, _, _ = reader.frames[-1]
    size = reader._file.size()
    assert size == start + packed + 8 + 12 * len(reader.frames) + 9


def test_no_pages_no_bundles(spark):
    folder = scratch_path(spark, "warc")
    assert warc.write_bundles(spark.createDataFrame([], PAGES), folder).count() == 0
    assert warc.read_bundles(spark, folder).count() == 0
