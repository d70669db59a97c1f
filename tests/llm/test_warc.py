import hashlib

import pytest
from pyspark.sql import functions as F

from corpuslens.llm import warc

BIG, OTHER = "Ä" * 600, "b" * 1000


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://a/é", BIG), (2, "u\r\nInjected: x", BIG), (3, "u", OTHER), (4, None, "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""), (7, "u", ""), (8, "u", BIG), (8, "u", BIG), (None, "u", BIG), (9, "u", "x\r\n\r\ny\r\n\r\n"), (None, None, None)]
    return spark.createDataFrame([(*r, "q") for r in rows], "page_id long, url string, html string, payload string")


def test_records_come_back(spark, pages):
    archive = warc.write(pages)
    rows = warc.read(spark, archive).collect()
    assert len(rows) == pages.count()
    texts = {r["page_id"]: (r["html"] or "").encode() for r in pages.where("page_id IS NOT NULL").collect()}
    for r in rows:
        if r["page_id"] is not None:
            body = texts[r["page_id"]]
            assert (r["payload_bytes"], r["payload_digest"]) == (len(body), hashlib.sha1(body).hexdigest())
            assert r["payload"] is None if r["record_type"] == "revisit" else bytes(r["payload"]) == body
    kinds = [(r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in rows]
    want = [(0, "response", None), (0, "revisit", 8), (1, "revisit", 8), (2, "revisit", 8), *[(n, "response", None) for n in (3, 4, 5, 6, 7, 7, 8, 8, 9)]]
    assert sorted(map(repr, kinds)) == sorted(map(repr, want))
    assert {r["url"] for r in rows if r["page_id"] == 1} == {"http://a/é"}


def test_payloads_are_stored_once_and_records_are_exact(spark, pages):
    archive = warc.write(pages)
    assert archive.large.count() == 2 and archive.small.count() == 3
    for r in warc.records(archive).collect():
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        size = int([line for line in head.split(b"\r\n") if line.startswith(b"Content-Length: ")][0].split()[1])
        assert head.startswith(b"WARC/1.1\r\n") and rest[size:] == b"\r\n\r\n" and b"\r\nInjected" not in head


def test_damage_is_noticed(spark, pages):
    archive = warc.write(pages)
    archive.large = archive.large.withColumn("payload", F.when(F.octet_length("payload") == 1000, F.lit(b"z")).otherwise(F.col("payload")))
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read(spark, archive).collect()


def test_empty(spark, pages):
    assert warc.read(spark, warc.write(pages.limit(0))).count() == 0


def test_payloads_lie_in_the_shared_folder(spark, pages):
    from corpuslens.sources.tables import shared_root

    archive = warc.write(pages)
    root = shared_root(spark).removeprefix("file:")
    assert all(root in path for path in archive.large.inputFiles())
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("warc_payloads")]
    heads = archive.heads.where("carries").select("page_id", "head", "sha256")
    plan = heads.hint("merge").join(archive.large, "sha256")._jdf.queryExecution().toString()
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan


def test_a_very_long_payload(spark):
    text = "é long payload\r\n\r\n" * 200_000
    pages = spark.createDataFrame([(1, "u", text), (2, "u", text)], "page_id long, url string, html string")
    rows = {r["page_id"]: r for r in warc.read(spark, warc.write(pages)).collect()}
    assert bytes(rows[2]["payload"]).decode() == text and rows[1]["refers_to"] == 2
    assert rows[1]["payload_bytes"] == len(text.encode())
