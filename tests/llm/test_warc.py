import gzip
import hashlib

import pytest

from churnlens.llm import warc
from churnlens.llm.common import scratch


@pytest.fixture(scope="module")
def pages(spark):
    big, huge = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 60, "x" * 3_000_000
    rows = [(1, "http://a/1", big), (2, "http://a\r\nX: 1", big), (7, None, big), (3, "u", "small"), (4, "u", "small"),
            (5, "u", None), (6, "u", ""), (8, "u", huge), (9, "u", huge), (10, "u", "a" * 1000), (11, "u", "a" * 1000),
            (12, "u", "a" * 999), (13, "u", "a" * 999)]
    return spark.createDataFrame([(*r, "clash", 3) for r in rows],
                                 "page_id long, url string, html string, digest string, bytes int").repartition(3)


@pytest.fixture(scope="module")
def archive(spark, pages):
    path = scratch(spark, "test-warc")
    warc.write_warc(warc.plan_records(pages), path)
    return path


def test_round_trip(spark, pages, archive):
    rows = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    got = {r.page_id: r for r in warc.page_digests(warc.read_warc(spark, archive)).collect()}
    assert got.keys() == rows.keys()
    for i, body in rows.items():
        first = max(k for k, b in rows.items() if b == body) if len(body) >= 1000 else i
        assert got[i].payload_bytes == len(body)
        assert got[i].payload_digest == hashlib.sha1(body).hexdigest()
        assert got[i].record_type == ("response" if first == i else "revisit")
        assert got[i].refers_to == (None if first == i else first)


def test_filters_are_taken_and_payloads_skipped(spark, archive):
    some = warc.read_warc(spark, archive).where("record_type = 'revisit'")
    assert {r.refers_to for r in some.collect()} == {"<urn:page:7>", "<urn:page:9>", "<urn:page:11>"}
    both = warc.read_warc(spark, archive).where("record_type in ('response') and record_id = '<urn:page:3>'")
    assert [bytes(r.payload) for r in both.collect()] == [b"small"]
    assert warc.read_warc(spark, archive, payload=False).where("payload is not null").count() == 0
    reader = warc.WarcReader({"path": archive})
    from pyspark.sql.datasource import EqualTo, GreaterThan
    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), GreaterThan(("content_length",), 5)]))
    assert len(left) == 1 and reader.wanted == {"record_type": {"response"}}


def test_gzip_members_and_folded_headers(spark, tmp_path):
    one = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: http://a\r\n b\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    two = b"WARC/1.0\nwarc-type: warcinfo\ncontent-length: 0\n\n\n\n"
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    assert [(r.record_type, bytes(r.payload), r.content_length) for r in rows] == [("response", b"abc", 3), ("warcinfo", b"", 0)]
    assert rows[0].target_uri == "http://a b"


def test_cut_record_is_an_error(spark, tmp_path):
    (tmp_path / "x.warc").write_bytes(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")
    with pytest.raises(Exception, match="ends before"):
        warc.read_warc(spark, str(tmp_path)).collect()


def test_empty(spark, pages):
    path = scratch(spark, "test-warc")
    warc.write_warc(warc.plan_records(pages.where("false")), path)
    assert warc.read_warc(spark, path).count() == 0


def test_null_ids_and_repeated_rows(spark):
    """A null id never wins and revisits the largest id; rows that repeat the
    winning id are responses; among null ids alone none revisits."""
    body, other = "<p>same</p>" * 200, "<p>other</p>" * 200
    rows = [(4, "u", body), (9, "u", body), (9, "u", body), (None, "u", body), (None, "u", other), (None, "u", other)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = scratch(spark, "test-warc")
    warc.write_warc(warc.plan_records(pages), path)
    got = sorted((str(r.page_id), r.record_type, str(r.refers_to), r.payload_bytes)
                 for r in warc.page_digests(warc.read_warc(spark, path)).collect())
    n, m = len(body), len(other)
    assert got == sorted([("4", "revisit", "9", n), ("9", "response", "None", n), ("9", "response", "None", n), ("None", "revisit", "9", n),
                          ("None", "response", "None", m), ("None", "response", "None", m)])
