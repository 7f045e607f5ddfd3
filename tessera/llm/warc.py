"""Op 6, WARC derivatives: metadata and plain-text conversion records of responses.

Responses come from WARC files (`read_responses`, with the headers that they hold) or from a
table of pages, which has none (`responses` makes them). Each gives two records that refer
to it by WARC-Refers-To, name each other by WARC-Concurrent-To and carry its target, date
and payload digest: a metadata record (application/warc-fields: the source's HTTP headers,
title and links) and a conversion record (text/plain). Deriving is DataFrame expressions
only, one pass, no shuffle.

Text is taken by rule: comments, scripts and styles go; block tags end a line; other
tags vanish; the entities in ENTITIES are decoded once; spaces are collapsed and blank
lines dropped. Other entities stay as they are. Links are the href attributes, quoted or
not, of the a tags that are left; they and the title are decoded alike.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import lean, small_batches

#: Named and numeric character references that are decoded, &amp; last.
ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#34;", '"'),
    ("&apos;", "'"),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&#160;", " "),
    ("&amp;", "&"),
]
#: Tags that end a line.
BLOCK_TAGS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul"
#: What is cut or replaced, in order; the same in Java and RE2.
STEPS = [
    ("(?s)<!--.*?-->", ""),
    ("(?is)<script[^>]*>.*?</script[^>]*>", ""),
    ("(?is)<style[^>]*>.*?</style[^>]*>", ""),
    (f"(?i)</?({BLOCK_TAGS})(/?|[ \t\r\n][^>]*)>", "\n"),
    ("<[^>]*>", ""),
]
SPACES = [("[ \t\r\f\x0b]+", " "), (" ?\n[ \n]*", "\n"), ("^[ \n]+", ""), ("[ \n]+$", "")]
_GAP, _QUOTED = "[ \t\r\n]", "(?:\"[^\"]*\"|'[^']*')"
#: The attributes of an a tag, and the value of href among them: not of another name that
#: ends in it, and not within another value.
TAG = f"(?i)<a({_GAP}(?:[^>\"']*{_QUOTED})*[^>\"']*)>"
HREF = f"(?i)^(?:[^\"']*{_QUOTED})*?[^\"']*?{_GAP}href{_GAP}*={_GAP}*({_QUOTED}|[^ \t\r\n\"'>]+)"
TITLE = "(?is)<title[^>]*>(.*?)</title"
STATUS = "HTTP/1.1 200 OK"


def decoded(text: Column) -> Column:
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def visible(html: Column) -> Column:
    """Without comments, scripts and styles."""
    for pattern, to in STEPS[:3]:
        html = F.regexp_replace(html, pattern, to)
    return html


def links_of(html: Column) -> Column:
    """The links of a visible page in order, empty ones dropped."""
    values = F.transform(F.regexp_extract_all(html, F.lit(TAG), F.lit(1)), lambda x: F.regexp_replace(F.regexp_extract(x, HREF, 1), "^[\"']|[\"']$", ""))
    return F.filter(F.transform(values, decoded), lambda x: x != "")


def plain_text(html: Column) -> Column:
    for pattern, to in STEPS[3:]:
        html = F.regexp_replace(html, pattern, to)
    html = decoded(html)
    for pattern, to in SPACES:
        html = F.regexp_replace(html, pattern, to)
    return html


def uuid_of(text: Column) -> Column:
    """urn:uuid (version 8) named by a text."""
    h = F.sha2(text.cast("binary"), 256)
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("8"), F.substring(h, 14, 3)), F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def digest_of(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of (page_id, url, html), which holds no headers of its own:
    page_id, record_id, target_uri, date, http_headers, payload, payload_digest."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", F.col("url").alias("target_uri"), F.lit(date).alias("date"), payload.alias("payload"))
    rows = rows.withColumn("payload_digest", digest_of(F.col("payload")))
    length = F.octet_length(F.col("payload")).cast("string")
    headers = F.concat(F.lit(f"{STATUS}\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), length, F.lit("\r\n\r\n"))
    name = F.concat_ws("|", F.lit("response"), F.col("page_id").cast("string"), F.col("target_uri"), F.col("payload_digest"))
    return rows.withColumns({"http_headers": headers, "record_id": uuid_of(name)})


def derive(source: DataFrame) -> DataFrame:
    """Two rows a response, warc_type metadata and conversion.

    source: page_id, record_id, target_uri, date, http_headers, payload, payload_digest;
    other columns, whatever their names, are not read. Adds refers_to, content_type, block and its digest and
    length in bytes, n_links and header (the whole WARC header with its blank line).
    A null target drops the header's line, a null payload is empty; repeated rows give
    repeated records with equal ids. An empty table gives no rows."""
    rows = source.select(
        "page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", "http_headers",
        F.col("payload_digest").alias("source_digest"), visible(F.coalesce(F.col("payload"), F.lit(""))).alias("html"),
    )
    rows = rows.select("*", links_of(F.col("html")).alias("links"), decoded(F.regexp_extract("html", TITLE, 1)).alias("title"), plain_text(F.col("html")).alias("text"))
    line = lambda x: F.trim(F.regexp_replace(x, "[ \t\r\n]+", " "))
    heads = F.transform(F.filter(F.split(F.col("http_headers"), "\r\n"), lambda x: x != ""), lambda x: F.concat(F.lit("sourceHeader: "), line(x)))
    named = F.array_compact(F.array(F.concat(F.lit("title: "), F.nullif(line(F.col("title")), F.lit(""))), F.concat(F.lit("sourcePayloadDigest: "), F.col("source_digest"))))
    outlinks = F.transform("links", lambda x: F.concat(F.lit("outlink: "), line(x)))
    meta = F.concat(F.array_join(F.concat(named, F.coalesce(heads, F.array().cast("array<string>")), outlinks), "\r\n"), F.lit("\r\n"))
    own, other = (F.concat_ws("|", "refers_to", F.lit(kind)) for kind in ("metadata", "conversion"))
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), uuid_of(own).alias("record_id"), uuid_of(other).alias("concurrent_to"), F.lit("application/warc-fields").alias("content_type"), meta.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), uuid_of(other).alias("record_id"), uuid_of(own).alias("concurrent_to"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")),
    )
    rows = rows.withColumn("n_links", F.size("links").cast("long")).withColumn("r", F.explode(kinds)).select("*", "r.*").drop("r", "links", "title", "text", "html")
    rows = rows.withColumns({"block_digest": digest_of(F.col("block")), "content_length": F.octet_length("block").cast("long")})
    said = [
        ("WARC-Type: ", "warc_type", ""), ("WARC-Record-ID: <", "record_id", ">"), ("WARC-Refers-To: <", "refers_to", ">"), ("WARC-Concurrent-To: <", "concurrent_to", ">"),
        ("WARC-Target-URI: ", "target_uri", ""), ("WARC-Date: ", "date", ""), ("WARC-Block-Digest: ", "block_digest", ""),
        ("WARC-Payload-Digest: ", "source_digest", ""), ("Content-Type: ", "content_type", ""), ("Content-Length: ", "content_length", ""),
    ]
    lines = [F.when(F.col(c).isNotNull(), F.concat(F.lit(a), F.col(c).cast("string"), F.lit(z))) for a, c, z in said]
    return rows.withColumn("header", F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines), F.lit("\r\n\r\n")))


def record_bytes(records: DataFrame) -> DataFrame:
    """page_id and record: each record as it stands in a WARC file."""
    return records.select("page_id", F.concat("header", "block", F.lit("\r\n\r\n")).cast("binary").alias("record"))


# ------------------------------------------------------------------------ files

_RESPONSE = "page_id long, record_id string, target_uri string, date string, http_headers string, payload string, payload_digest string"
#: Bytes of a file that is read: a task holds it whole. Files of crawls have about 1 GB.
MOST_FILE = 2_000_000_000


def _fields(head: bytes) -> dict[str, str]:
    """The fields of a header by lower-case name; the first of equal names counts."""
    out: dict[str, str] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def _members(data: bytes) -> Iterator[bytes]:
    """The parts of a file: of a compressed one its gzip members, one after the other."""
    if not data.startswith(b"\x1f\x8b"):
        yield data
        return
    while data:
        unzip = zlib.decompressobj(31)
        yield unzip.decompress(data) + unzip.flush()
        data = unzip.unused_data


def _records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a file's part."""
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            raise ValueError("a WARC header without an end")
        fields = _fields(data[at:end])
        length = fields.get("content-length", "")
        if not length.isdigit() or end + 4 + int(length) > len(data):
            raise ValueError(f"a WARC record of Content-Length {length!r} that isn't all there")
        yield fields, data[end + 4 : end + 4 + int(length)]
        at = end + 4 + int(length)


def _body(raw: bytes, http: dict[str, str]) -> bytes:
    """A payload without its transfer and content encodings, as far as they are known."""
    if http.get("transfer-encoding", "").lower() == "chunked":
        out, rest = [], raw
        while rest:
            size, _, rest = rest.partition(b"\r\n")
            try:
                n = int(size.split(b";")[0], 16)
            except ValueError:  # archived without its chunks
                return raw
            if not n:
                break
            out.append(rest[:n])
            rest = rest[n + 2 :]
        raw = b"".join(out)
    if http.get("content-encoding", "").lower() in ("gzip", "x-gzip", "deflate"):
        try:
            return zlib.decompress(raw, 47)
        except zlib.error:
            return raw
    return raw


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """The HTTP response records of WARC files, plain or gzip, from any file system that
    Spark reads, as `derive` takes them: with the headers, identifiers, dates and digests
    that they hold. page_id is null.

    Payloads are read as UTF-8 or by the charset that the headers name; a payload without a
    digest in its header gets one. Other kinds of records are left out. A broken record, or
    a file of more than MOST_FILE bytes, is an error."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "content")
    if (large := files.where(F.col("length") > MOST_FILE).select("path").first()) is not None:
        raise ValueError(f"{large.path} has more than {MOST_FILE} bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _RESPONSE.split(", ")]
        kinds = [pa.int64(), *[pa.string()] * 6]
        for batch in batches:
            for data in batch.column(0):
                for part in _members(data.as_py()):
                    rows = [_response(f, b) for f, b in _records(part) if f.get("warc-type") == "response" and "http" in f.get("content-type", "application/http")]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    small_batches(files)  # files are large: few come at once
    return files.select("content").mapInArrow(lean("warc", run), _RESPONSE)


def _response(fields: dict[str, str], block: bytes) -> tuple:
    head, _, raw = block.partition(b"\r\n\r\n")
    http = _fields(head)
    charset = re.search(r"charset=\"?([\w-]+)", http.get("content-type", ""), re.I)
    body = _body(raw, http)
    try:
        payload = body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        payload = body.decode("utf-8", "replace")
    digest = fields.get("warc-payload-digest") or "sha256:" + hashlib.sha256(raw).hexdigest()
    bare = lambda name: fields[name].strip("<>") if name in fields else None
    return None, bare("warc-record-id"), bare("warc-target-uri"), fields.get("warc-date"), head.decode("utf-8", "replace") + "\r\n\r\n", payload, digest


# ------------------------------------------------------------------------ query


def derived(pages: DataFrame) -> DataFrame:
    """What the registered query returns: the records derived from pages, whole. Null pages
    are empty, a null url drops its lines, repeated pages give repeated records, an empty
    table gives none; other columns are not read."""
    return derive(responses(pages)).select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "n_links", "header", "block")


def oracle_sql() -> str:
    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'" if x.isprintable() else " || ".join("'" + c.replace("'", "''") + "'" if c.isprintable() else f"chr({ord(c)})" for c in x)

    def names(x: str) -> str:
        for name, char in ENTITIES:
            x = f"replace({x}, {text(name)}, {text(char)})"
        return x

    html, plain = "payload", "html"
    for pattern, to in STEPS[:3]:
        html = f"regexp_replace({html}, {text(pattern)}, {text(to)}, 'g')"
    for pattern, to in STEPS[3:]:
        plain = f"regexp_replace({plain}, {text(pattern)}, {text(to)}, 'g')"
    plain = names(plain)
    for pattern, to in SPACES:
        plain = f"regexp_replace({plain}, {text(pattern)}, {text(to)}, 'g')"
    crlf = "chr(13) || chr(10)"

    def uuid(x: str) -> str:
        h = f"sha256({x})"
        return f"'urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-8' || substr({h}, 14, 3) || '-8' || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"

    line = "trim(regexp_replace({}, '[ ' || chr(9) || chr(13) || chr(10) || ']+', ' ', 'g'))"
    found = f"""list_filter(list_transform(regexp_extract_all(html, {text(TAG)}, 1), lambda x: {names(f"regexp_replace(regexp_extract(x, {text(HREF)}, 1), '^[\"'']|[\"'']$', '', 'g')")}), lambda x: x <> '')"""
    meta = f"""concat_ws({crlf}, 'title: ' || nullif({line.format("title")}, ''), 'sourcePayloadDigest: ' || source_digest, 'sourceHeader: {STATUS}', 'sourceHeader: Content-Type: text/html; charset=utf-8',
    'sourceHeader: Content-Length: ' || strlen(payload), nullif(array_to_string(list_transform(links, lambda x: 'outlink: ' || {line.format("x")}), {crlf}), '')) || {crlf}"""
    return f"""WITH a AS (SELECT page_id, url AS target_uri, coalesce(html, '') AS payload FROM pages),
b AS (SELECT *, 'sha256:' || sha256(payload) AS source_digest, {html} AS html FROM a),
c AS (SELECT *, {found} AS links, {names(f"regexp_extract(html, {text(TITLE)}, 1)")} AS title, {uuid("concat_ws('|', 'response', page_id, target_uri, source_digest)")} AS refers_to FROM b),
d AS (SELECT *, 'metadata' AS warc_type, 'conversion' AS other, 'application/warc-fields' AS content_type, {meta} AS block FROM c
  UNION ALL SELECT *, 'conversion', 'metadata', 'text/plain; charset=utf-8', {plain} FROM c),
e AS (SELECT *, {uuid("refers_to || '|' || warc_type")} AS record_id, {uuid("refers_to || '|' || other")} AS concurrent_to FROM d)
SELECT page_id, warc_type, record_id, refers_to, target_uri, CAST(len(links) AS BIGINT) AS n_links, block, 'WARC/1.1' || {crlf} || 'WARC-Type: ' || warc_type || {crlf}
  || 'WARC-Record-ID: <' || record_id || '>' || {crlf} || 'WARC-Refers-To: <' || refers_to || '>' || {crlf} || 'WARC-Concurrent-To: <' || concurrent_to || '>' || {crlf}
  || coalesce('WARC-Target-URI: ' || target_uri || {crlf}, '') || 'WARC-Date: 1970-01-01T00:00:00Z' || {crlf}
  || 'WARC-Block-Digest: sha256:' || sha256(block) || {crlf} || 'WARC-Payload-Digest: ' || source_digest || {crlf}
  || 'Content-Type: ' || content_type || {crlf} || 'Content-Length: ' || strlen(block) || {crlf} || {crlf} AS header
FROM e"""
