import base64
import contextlib
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from shelfseries.llm import warc
from shelfseries.llm.staging import new_path

PAGES = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2\r\nX: y", "line\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"), (3, None, None), (4, "http://a/4", ""),
    (5, "http://a/5", "<p>one</p>"), (7, "http://a/7", "<p>one</p>"), (6, "http://ü", "ü" * 100_000), (None, "http://n", "<p>one</p>"), (8, "http://a/8", "\r\n"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "extra", 1) for p in PAGES], "page_id long, url string, html string, id string, body int")


@pytest.fixture(scope="module", params=["gzip", "none"])
def archive(request, spark, pages):
    path = new_path(spark, "test-archives")
    warc.write(warc.plan_records(pages), path, compression=request.param)
    return path


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark, archive):
    got = {warc_id(r): r for r in warc.check_payloads(warc.read(spark, archive)).collect()}
    keeper = {"<p>one</p>": 7, "": 4}
    for i, url, html in PAGES:
        r = got[i]
        html = html or ""
        assert r["payload_digest"] == "sha1:" + sha(html) and r["http_length"] == len(html.encode())
        if i is None or keeper.get(html, i) == i:
            assert r["record_type"] == "response" and bytes(r["payload"]) == html.encode() and r["refers_to"] is None
        else:
            assert r["record_type"] == "revisit" and r["payload"] is None and r["refers_to"] == f"<urn:page:{keeper[html]}>"
    assert got[2]["target_uri"] == "http://a/2%0D%0AX: y" and got[3]["target_uri"] is None


def warc_id(r):
    found = r["record_id"].removeprefix("<urn:page:").rstrip(">")
    return None if found == "none" else int(found)


def test_filters_are_decided_on_headers(spark, archive):
    records = warc.read(spark, archive)
    some = records.where((F.col("record_type") == "response") & F.col("target_uri").isin("http://a/7", "http://a/5"))
    assert [warc_id(r) for r in some.collect()] == [7]
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        some.explain("formatted")
    assert "PushedFilters: [EqualTo(record_type,response), In(target_uri" in plan.getvalue()
    heads = warc.read(spark, archive, ("record_id", "record_type", "content_length"))
    assert heads.columns == ["record_id", "record_type", "content_length"] and heads.count() == len(PAGES)


def test_payload_is_not_read_when_skipped(tmp_path):
    """The header decides: a filtered record's block may be anything."""
    block = b"\xff" * 10
    record = b"WARC/1.1\r\nWARC-Type: request\r\nWARC-Record-ID: <a>\r\nContent-Length: 10\r\n\r\n" + block + b"\r\n\r\n"
    other = b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <b>\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(record) + gzip.compress(other))
    from pyspark.sql.datasource import EqualTo
    from pyspark.sql.types import BinaryType, StringType, StructField, StructType

    reader = warc.Reader(str(tmp_path), StructType([StructField("record_id", StringType()), StructField("payload", BinaryType())]), 1 << 20)
    assert list(reader.pushFilters([EqualTo(("record_type",), "response")])) == []
    (part,) = reader.partitions()
    assert [b.to_pylist() for b in reader.read(part)] == [[{"record_id": "<b>", "payload": b"hi"}]]


def test_truncated_record_fails(spark, tmp_path):
    (tmp_path / "x.warc").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 10\r\n\r\nshort")
    with pytest.raises(Exception, match="ends early"):
        warc.read(spark, str(tmp_path)).collect()


def test_empty(spark, pages):
    path = new_path(spark, "test-archives")
    warc.write(warc.plan_records(pages.limit(0)), path)
    assert warc.read(spark, path).count() == 0


def test_least_payload_size(pages):
    rows = {r["id"]: r["keeper"] for r in warc.plan_records(pages, smallest=5).collect()}
    assert rows[3] == 3 and rows[1] == 7
