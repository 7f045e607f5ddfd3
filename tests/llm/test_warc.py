from __future__ import annotations

import gzip
import hashlib
import html
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from tessera.llm import warc
from tests.llm import data

PAGE = """<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{}</style><script>var x="<p>no</p><a href='/no'>"</script></head><body><!-- gone <a href="/gone"> -->
<p>One&nbsp;<b>two</b><br>three &lt;4&gt;</p><a href="/x?a=1&amp;b=2">link</a><a data-href="no" title="href=never" HREF = '/single'>s</a><A class=c href=/bare>b</A><a name="n">none</a><abbr href="/abbr">no</abbr></body></html>"""


class Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.found += [v for k, v in attrs if k == "href" and v]


def links(page):
    parser = Links()
    parser.feed(page)
    return parser.found


def fields(block):
    assert block.endswith("\r\n")
    return [tuple(x.split(": ", 1)) for x in block[:-2].split("\r\n")]


def test_linked_records(spark):
    pages = spark.createDataFrame([(0, "http://a/", PAGE), (1, None, None), (2, "http://b/", ""), (0, "http://a/", PAGE)], "page_id long, url string, html string")
    pages = data.clashing(pages).withColumns({c: F.lit("x") for c in ("record_id", "payload", "block", "links", "header", "date")})
    rows = warc.derive(warc.responses(pages)).collect()
    assert len(rows) == 8
    own = {r.warc_type: r for r in rows if r.page_id == 0}
    assert own["conversion"].block == "A & B\nOne two\nthree <4>\nlinksbnoneno"
    digest = "sha256:" + hashlib.sha256(PAGE.encode()).hexdigest()
    meta = fields(own["metadata"].block)
    assert [v for k, v in meta if k == "outlink"] == links(PAGE) == ["/x?a=1&b=2", "/single", "/bare"]
    assert ("title", "A & B") in meta and ("sourcePayloadDigest", digest) in meta and ("sourceHeader", f"Content-Length: {len(PAGE.encode())}") in meta
    assert own["metadata"].refers_to == own["conversion"].refers_to != own["metadata"].record_id == own["conversion"].concurrent_to
    for r in rows:
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert r.content_length == len(r.block.encode()) and f"WARC-Refers-To: <{r.refers_to}>" in r.header and f"WARC-Payload-Digest: {r.source_digest}" in r.header
        assert ("WARC-Target-URI" in r.header) == (r.target_uri is not None)
    assert len({r.record_id for r in rows}) == 6
    assert warc.derived(pages.limit(0)).count() == 0 and warc.derived(pages).count() == 8


def test_links_equal_a_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    given = {r.page_id: r.html or "" for r in pages.collect()}
    meta = warc.derived(pages).where("warc_type = 'metadata'").collect()
    assert sum(r.n_links for r in meta) > 0
    for r in meta:
        assert [v for k, v in fields(r.block) if k == "outlink"] == [" ".join(x.split()) for x in links(given[r.page_id])]


def test_a_very_long_page(spark):
    page = "<p>" + "word &amp; " * 200_000 + "</p>" + '<a class="c" href="/y">z</a>' * 2000 + "<a " + "x" * 50_000
    row = warc.derived(spark.createDataFrame([(0, "http://a/", page)], "page_id long, url string, html string")).where("warc_type = 'conversion'").first()
    assert row.n_links == 2000 and row.block.startswith("word & word") and len(row.block) > 200_000 * 7


def record(kind, block, **fields):
    head = {"WARC-Type": kind, "WARC-Record-ID": "<urn:uuid:00000000-0000-4000-8000-000000000001>", "Content-Length": str(len(block))} | {k.replace("_", "-"): v for k, v in fields.items()}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


@pytest.mark.parametrize("zipped", [False, True])
def test_responses_of_files(spark, tmp_path, zipped):
    http = b"HTTP/1.1 404 Not Found\r\nServer: own\r\nContent-Type: text/html; charset=latin-1\r\n\r\n"
    packed = b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n\r\n"
    body = gzip.compress("<title>Zürich</title>".encode())
    chunks = b"%x\r\n%b\r\n0\r\n\r\n" % (len(body), body)
    parts = [
        record("warcinfo", b"software: x\r\n"),
        record("response", http + "<a href=/é>é</a>".encode("latin-1"), WARC_Target_URI="http://a/", WARC_Date="2020-02-02T00:00:00Z", WARC_Payload_Digest="sha1:ABC", Content_Type="application/http; msgtype=response"),
        record("request", b"GET / HTTP/1.1\r\n\r\n"),
        record("response", packed + chunks),
    ]
    (tmp_path / "a.warc").write_bytes(b"".join(map(gzip.compress, parts) if zipped else parts))
    found = warc.read_responses(spark, str(tmp_path))
    a, b = sorted(found.collect(), key=lambda r: r.target_uri or "z")
    assert (a.target_uri, a.date, a.payload_digest, a.payload) == ("http://a/", "2020-02-02T00:00:00Z", "sha1:ABC", "<a href=/é>é</a>")
    assert a.record_id == "urn:uuid:00000000-0000-4000-8000-000000000001" and "Server: own" in a.http_headers
    assert b.payload == "<title>Zürich</title>" and b.payload_digest == "sha256:" + hashlib.sha256(chunks).hexdigest()
    made = {(r.target_uri, r.warc_type): r for r in warc.derive(found).collect()}
    assert ("sourceHeader", "Server: own") in fields(made["http://a/", "metadata"].block) and "WARC-Payload-Digest: sha1:ABC" in made["http://a/", "conversion"].header
    (tmp_path / "a.warc").write_bytes(parts[1][:-30])
    with pytest.raises(Exception, match="isn't all there"):
        warc.read_responses(spark, str(tmp_path)).collect()


def test_derived_records_read_back(spark):
    pages = spark.createDataFrame([(0, "http://a/", PAGE)], "page_id long, url string, html string")
    rows = warc.derive(warc.responses(pages))
    raw = b"".join(bytes(r.record) for r in warc.record_bytes(rows).collect())
    back = {f["warc-type"]: (f, b) for f, b in warc._records(raw)}
    for r in rows.collect():
        f, block = back[r.warc_type]
        assert block.decode() == r.block and f["warc-refers-to"] == f"<{r.refers_to}>" and f["content-type"] == r.content_type


def test_entities_are_references():
    for name, char in warc.ENTITIES:
        assert html.unescape(name).replace("\xa0", " ") == char
