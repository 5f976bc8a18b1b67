"""Archives that are written twice, replaced, or made by others."""

import gzip
import hashlib
import io
import os

import pytest

from larder.llm import warc

SCHEMA = "page_id long, url string, html string"
URL = "http://x.org/ä path?q=%41 \"<b>"


def pages(spark, rows):
    return warc.records(spark.createDataFrame(rows, SCHEMA))


def found(spark, folder):
    return sorted((r.page_id, r.url, (r.payload or b"").decode()) for r in warc.read(spark, folder).collect())


def test_second_write_adds(spark, tmp_path):
    folder = f"{tmp_path}/a"
    first, second = [(1, URL, "one"), (2, "http://y/", "two")], [(3, None, "three")]
    warc.write(pages(spark, first), folder)
    warc.write(pages(spark, second), folder)
    assert found(spark, folder) == sorted([(i, u, h) for i, u, h in first + second])
    warc.write(pages(spark, second), folder, "overwrite")
    assert found(spark, folder) == second
    warc.write(pages(spark, first), folder)
    assert found(spark, folder) == first + second
    warc.write(pages(spark, first).limit(0), folder, "overwrite")
    assert found(spark, folder) == []


def test_urls_and_long_headers(spark, tmp_path):
    rows = [(1, "http://x/" + "é" * 9000, "a" * 5000), (2, "http://x/a\r\nb", "b"), (3, " http://x/ ", "c"), (4, URL, "")]
    warc.write(pages(spark, rows), f"{tmp_path}/a")
    want = [(i, u.replace("\r\n", "%0D%0A"), h) for i, u, h in rows]
    assert found(spark, f"{tmp_path}/a") == want
    heads = warc.read(spark, f"{tmp_path}/a", "url string, payload_bytes long").where("payload_bytes = 5000").collect()
    assert [r.url for r in heads] == [rows[0][1]]


def test_payloads_of_others_are_not_read(spark, tmp_path, monkeypatch):
    """With the payload wanted, records that fail on their headers cost a head alone."""
    noise = os.urandom(300_000).hex()
    warc.write(pages(spark, [(1, "u", noise), (2, "v", noise[::-1]), (3, "w", "small")]).coalesce(1), f"{tmp_path}/a")
    reader = warc.WarcReader(f"{tmp_path}/a", warc.StructType.fromDDL(warc.SCHEMA))
    reader.tests = [("page_id", "in", {3})]
    taken = []
    original = warc.zlib.decompressobj

    class Counted:
        def __init__(self, wbits):
            self.inner = original(wbits)

        def decompress(self, data, *limit):
            taken.append(len(data))
            return self.inner.decompress(data, *limit)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    monkeypatch.setattr(warc.zlib, "decompressobj", Counted)
    rows = [r for part in reader.partitions() for batch in reader.read(part) for r in batch.to_pylist()]
    assert [r["page_id"] for r in rows] == [3] and rows[0]["payload"] == b"small" and sum(taken) < 20_000


def others(members):
    """Records as another tool would write them: warcinfo, a request, two responses, a resource."""
    body = b"<html>" + b"x" * 600_000 + b"</html>"
    digest = hashlib.sha1(b"plain").hexdigest()
    http = b"HTTP/1.1 200 OK\r\ncontent-type: text/html\r\n\r\n"
    blocks = [
        (b"WARC-Type: warcinfo\r\nContent-Type: application/warc-fields", b"software: other\r\n"),
        (b"WARC-Type: request\r\nWARC-Target-URI: http://a/\r\nContent-Type: application/http; msgtype=request", b"GET / HTTP/1.1\r\n\r\n"),
        (b"warc-type: response\r\nwarc-target-uri: http://a/\r\nContent-Type: application/http; msgtype=response", http + body),
        (b"WARC-Type: response\r\nWARC-Target-URI: http://b/\r\nContent-Type: application/http; msgtype=response\r\nWARC-Payload-Digest: sha1:" + digest.encode(), http + b"plain"),
        (b"WARC-Type: resource\r\nWARC-Target-URI: file://c\r\nContent-Type: text/plain", b"thing\r\n\r\nmore"),
    ]
    out = io.BytesIO()
    for n, (head, block) in enumerate(blocks):
        record = b"WARC/1.0\r\nWARC-Record-ID: <urn:uuid:%d>\r\n" % n + head + b"\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
        out.write(gzip.compress(record) if members else record)
    return out.getvalue(), body, digest


@pytest.mark.parametrize("kind", ["members", "whole", "plain"])
def test_archives_of_others(spark, tmp_path, kind):
    data, body, digest = others(kind == "members")
    name = "a.warc" if kind == "plain" else "a.warc.gz"
    os.makedirs(f"{tmp_path}/in")
    for copy in ("", "b-"):
        with open(f"{tmp_path}/in/{copy}{name}", "wb") as f:
            f.write(gzip.compress(data) if kind == "whole" else data)
    for path, times in ((f"{tmp_path}/in", 2), (f"{tmp_path}/in/{name}", 1)):
        rows = warc.read(spark, path)
        assert rows.count() == 5 * times and rows.rdd.getNumPartitions() == times
        got = rows.where("record_type in ('response', 'resource')").collect()[: 3]
        assert [(r.url, r.payload_bytes, bytes(r.payload)) for r in got] == [
            ("http://a/", len(body), body), ("http://b/", 5, b"plain"), ("file://c", 13, b"thing\r\n\r\nmore"),
        ]
        assert [r.payload_digest for r in got] == [None, digest, None] and all(r.page_id is None for r in got)
        heads = warc.read(spark, path, "url string, record_type string").where("record_type = 'request'").collect()
        assert [r.url for r in heads] == ["http://a/"] * times
