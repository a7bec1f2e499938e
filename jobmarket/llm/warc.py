"""WARC derivative builder: metadata and plain-text conversion records from response records.

Each response gives two records, both DataFrame expressions only:

* ``metadata`` (application/warc-fields): title, charset, outlinks, size of the text, and the source's status line;
* ``conversion`` (text/plain): the visible text of the page.

Both carry WARC-Refers-To (the response's record id), WARC-Target-URI, WARC-Date, the response's HTTP header lines as
``WARC-Source-Header`` lines, the response's payload digest as ``WARC-Source-Payload-Digest``, and digests of their
own block. Record ids are built from a digest of response id and record type, so reruns agree.

Responses come from a table of pages (``responses``) or from WARC files (``read_warc`` and ``responses_of``; .warc and
.warc.gz alike); bodies are decoded by the charset of their HTTP head, else of the page.

Defined results: a null body or URL counts as empty (the records exist, with empty text); rows that repeat give
repeated records with equal ids; columns beyond the named ones are ignored; an empty table gives no record.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmarket.llm.common import table

#: HTML entities that text extraction resolves, and the date of records whose source has none.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
UNKNOWN_DATE = "1970-01-01T00:00:00Z"
CRLF = "\r\n"
RECORDS_AT_ONCE = 1 << 24

#: Subtrees without visible text, comments, tags that end a line, other tags, and runs of white space.
HIDDEN = r"(?is)<(?:script\b.*?</script|style\b.*?</style|head\b.*?</head|template\b.*?</template)\s*>|<!--.*?-->|<!doctype[^>]*>"
BREAKING = r"(?i)</?(?:p|div|br|h[1-6]|li|ul|ol|tr|table|article|section|nav|header|footer|blockquote|pre)\b[^>]*>"
TAG = r"<[^>]*>"
#: The same matches as HIDDEN, with one character to look for; the DuckDB twin reads HIDDEN.
HIDDEN_ONCE = r"(?is)<(?:(?:script\b.*?</script|style\b.*?</style|head\b.*?</head|template\b.*?</template)\s*>|!--.*?-->|!doctype[^>]*>)"


def _utf8_length(c: Column) -> Column:
    return F.octet_length(c).cast("long")


def record_id(*parts: Column) -> Column:
    """urn:uuid of version 8 from the SHA-256 of the parts."""
    h = F.sha2(F.concat_ws("|", *parts), 256)
    bits = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("8"), F.substring(h, 14, 3)), F.concat(F.lit("a"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *bits), F.lit(">"))


def digest(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(c, 256))


def visible_text(html: Column) -> Column:
    """Text of a page: hidden subtrees and comments go, block tags end lines, entities are resolved once."""
    t = F.regexp_replace(html, HIDDEN_ONCE, " ")
    # Behind the last ">" no tag ends; looking for one from every "<" there would take time with the square of its length.
    tail = F.substring_index(t, ">", -1)
    t = F.concat(F.regexp_replace(F.regexp_replace(F.substring(t, F.lit(1), F.length(t) - F.length(tail)), BREAKING, "\n"), TAG, ""), tail)
    for entity, char in ENTITIES:
        t = F.replace(t, F.lit(entity), F.lit(char))
    # Single spaces, the most frequent, need no change; lines are trimmed and blank ones go.
    t = F.regexp_replace(t, r" [ \t\r\f]+|[\t\r\f][ \t\r\f]*", " ")
    return F.array_join(F.filter(F.transform(F.split(t, "\n"), lambda x: F.trim(x)), lambda x: x != ""), "\n")


def responses(pages: DataFrame) -> DataFrame:
    """Response records of a table of pages (page_id, url, html): a status line and headers stand before the body."""
    body = F.coalesce(F.col("html"), F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), _utf8_length(body).cast("string"))
    return pages.select(
        "page_id",
        record_id(F.lit("response"), F.col("page_id").cast("string"), F.coalesce("url", F.lit("")), F.sha2(body, 256)).alias("record_id"),
        F.coalesce("url", F.lit("")).alias("target_uri"),
        F.lit(UNKNOWN_DATE).alias("warc_date"),
        head.alias("http_head"),
        body.alias("body"),
    )


def derive(resp: DataFrame, *keep: str) -> DataFrame:
    """Metadata and conversion records of response records (record_id, target_uri, warc_date, http_head, body, and, where
    the source names it, payload_digest).

    One row per derived record; ``record`` is the whole WARC record up to its block's end. ``keep`` names columns of
    the input to carry along. One pass over the responses without a shuffle.
    """
    lines = F.filter(F.split("http_head", "\r\n"), lambda x: x.contains(":"))
    named = F.coalesce("payload_digest", digest(F.col("body"))) if "payload_digest" in resp.columns else digest(F.col("body"))
    base = resp.select(
        *keep, "target_uri", F.coalesce("warc_date", F.lit(UNKNOWN_DATE)).alias("warc_date"),
        F.col("record_id").alias("refers_to"), named.alias("source_payload_digest"),
        F.split_part("http_head", F.lit("\r\n"), F.lit(1)).alias("status_line"), lines.alias("source_headers"),
        visible_text(F.col("body")).alias("plain"),
        F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract("body", r"(?is)<title[^>]*>(.*?)</title", 1), TAG, ""), r"\s+", " ")).alias("title"),
        F.lower(F.regexp_extract("body", r"(?i)<meta[^>]*charset=[\"']?([A-Za-z0-9_-]+)", 1)).alias("charset"),
        F.regexp_extract_all("body", F.lit(r"(?i)<a\b[^>]*?\bhref=[\"']([^\"']*)[\"']"), F.lit(1)).alias("links"),
    )
    fields = F.concat(
        F.lit("title: "), "title", F.lit(f"{CRLF}charset: "), "charset", F.lit(f"{CRLF}sourceStatus: "), "status_line",
        F.lit(f"{CRLF}textLength: "), F.length("plain").cast("string"), F.lit(f"{CRLF}outlinkCount: "), F.size("links").cast("string"), F.lit(CRLF),
        F.array_join(F.transform("links", lambda x: F.concat(F.lit("outlink: "), F.regexp_replace(x, r"\s+", " "), F.lit(CRLF))), ""),
    )
    kinds = F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("plain").alias("block")),
    )
    out = base.withColumn("d", F.explode(kinds)).select(*keep, "d.*", "refers_to", "target_uri", "warc_date", "source_payload_digest", "source_headers", F.size("links").alias("n_links"))
    out = out.withColumns({"record_id": record_id(F.col("record_type"), F.col("refers_to")), "block_digest": digest(F.col("block")), "content_length": _utf8_length(F.col("block"))})
    headers = F.concat_ws(
        CRLF, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "record_type"), F.concat(F.lit("WARC-Record-ID: "), "record_id"),
        F.concat(F.lit("WARC-Refers-To: "), "refers_to"), F.concat(F.lit("WARC-Target-URI: "), "target_uri"), F.concat(F.lit("WARC-Date: "), "warc_date"),
        F.concat(F.lit("WARC-Block-Digest: "), "block_digest"), F.concat(F.lit("WARC-Source-Payload-Digest: "), "source_payload_digest"),
        F.transform("source_headers", lambda x: F.concat(F.lit("WARC-Source-Header: "), x)),
        F.concat(F.lit("Content-Type: "), "content_type"), F.concat(F.lit("Content-Length: "), F.col("content_length").cast("string")),
    )
    return out.withColumn("record", F.concat(headers, F.lit(CRLF * 2), "block"))


def write_warc(records: DataFrame, path: str) -> None:
    """Writes records as WARC files through Spark's text sink: a record and then two line ends, again and again."""
    records.select("record").write.option("lineSep", CRLF * 2).text(path)


def _pieces(data: bytes) -> Iterator[bytes]:
    """A file's content; of gzip files one member after the other, up to where the file is broken."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        try:
            while data and not member.eof:
                yield member.decompress(data, RECORDS_AT_ONCE)
                data = member.unconsumed_tail
        except zlib.error:
            return
        data = member.unused_data


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records of a WARC file, plain or gzip; a header that repeats has its values on lines.
    A record that the file's end cuts off has what is left as its block; one whose length is missing or no number goes on
    until the next record begins. Of a gzip file, about one record is unpacked at a time."""
    rest, pieces = b"", _pieces(data)
    while True:
        piece = next(pieces, None)
        rest += piece or b""
        at = 0
        while (end := rest.find(b"\r\n\r\n", at)) >= 0:
            head: dict[str, str] = {}
            for line in rest[at:end].decode("utf-8", "replace").lstrip("\r\n").split("\r\n")[1:]:
                k, _, v = line.partition(":")
                head[k] = f"{head[k]}\n{v.strip()}" if k in head else v.strip()
            length = next((v for k, v in head.items() if k.lower() == "content-length"), "")
            # A record without a usable length reaches up to the line ends before the next one.
            stop = end + 4 + int(length) if re.fullmatch("[0-9]{1,18}", length) else rest.find(b"\r\n\r\nWARC/", end + 4)
            if piece is not None and (stop < 0 or stop + 4 > len(rest)):
                break
            stop = len(rest.rstrip(b"\r\n")) if stop < 0 else stop
            yield head, rest[end + 4 : stop]
            at = stop + 4
        if piece is None:
            return
        rest = rest[at:]


#: Bytes of a page in which its own charset is looked for.
HEAD_BYTES = 4096


def decoded(head: dict[str, str], raw: bytes) -> str:
    """A block as text: the body of an HTTP response by the charset of its head, else of the page, else UTF-8."""
    at = raw.find(b"\r\n\r\n")
    if not raw.startswith(b"HTTP/") or at < 0:
        return raw.decode("utf-8", "replace")
    http, body = raw[:at].decode("utf-8", "replace"), raw[at + 4 :]
    named = re.search(r"(?im)^content-type:.*?charset=[\"']?([\w.:-]+)", http) or re.search(r"(?i)<meta[^>]*charset=[\"']?([\w.:-]+)", body[:HEAD_BYTES].decode("latin-1"))
    try:
        text = body.decode(named[1] if named else "utf-8", "replace")
    except (LookupError, ValueError):  # no charset of text
        text = body.decode("utf-8", "replace")
    return f"{http}{CRLF * 2}{text}"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files as (headers map, block, raw): the block as text and as bytes. Splits by Content-Length; a
    file goes to one task, so files are meant to be of the usual size of about 1 GB at most."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.map_(pa.string(), pa.string()), pa.string(), pa.binary())
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for head, raw in records_of(content.as_py()):
                    held.append((list(head.items()), decoded(head, raw), raw))
                    size += len(raw)
                    if size > RECORDS_AT_ONCE:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=["headers", "block", "raw"])
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=["headers", "block", "raw"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(split, "headers map<string,string>, block string, raw binary")


def responses_of(records: DataFrame) -> DataFrame:
    """Response records of read_warc's records: the HTTP head and body of each, its own id, date and payload digest (a
    digest of the body's bytes where the record names none)."""
    h = lambda k: F.col("headers")[k]
    at = F.instr("block", CRLF * 2)
    whole = at == 0  # no empty line: a head without a body
    body_bytes = F.expr("substring(raw, position(cast('\r\n\r\n' as binary), raw) + 4)")
    return records.filter(F.lower(h("WARC-Type")) == "response").select(
        h("WARC-Record-ID").alias("record_id"), F.coalesce(h("WARC-Target-URI"), F.lit("")).alias("target_uri"), h("WARC-Date").alias("warc_date"),
        F.when(whole, F.col("block")).otherwise(F.substring("block", F.lit(1), at - 1)).alias("http_head"),
        F.when(whole, "").otherwise(F.substring("block", at + 4, F.length("block"))).alias("body"),
        F.coalesce(h("WARC-Payload-Digest"), F.concat(F.lit("sha256:"), F.sha2(F.when(whole, F.lit(b"")).otherwise(body_bytes), 256))).alias("payload_digest"),
    )


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived records of every page: ids, links to the source, digests and lengths."""
    d = derive(responses(table(spark, sf_dir, "pages")), "page_id")
    return d.select(
        "page_id", "record_type", "record_id", "refers_to", "target_uri", "content_type", "content_length", "block_digest",
        "source_payload_digest", F.array_join("source_headers", "\n").alias("source_headers"), "n_links", F.sha2("record", 256).alias("record_sha256"),
    )


def _duck_id(*parts: str) -> str:
    h = f"sha256(concat_ws('|', {', '.join(parts)}))"
    return f"'<urn:uuid:' || substr({h},1,8) || '-' || substr({h},9,4) || '-8' || substr({h},14,3) || '-a' || substr({h},18,3) || '-' || substr({h},21,12) || '>'"


def _duck_text(html: str) -> str:
    q = lambda s: s.replace("'", "''")
    t = f"regexp_replace({html}, '{q(HIDDEN)}', ' ', 'g')"
    t = f"regexp_replace({t}, '{q(BREAKING)}', chr(10), 'g')"
    t = f"regexp_replace({t}, '{TAG}', '', 'g')"
    for entity, char in ENTITIES:
        t = f"replace({t}, '{q(entity)}', '{q(char)}')"
    t = f"regexp_replace({t}, '[ \\t\\r\\f]+', ' ', 'g')"
    t = f"regexp_replace({t}, ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"regexp_replace({t}, '^[ \\n]+|[ \\n]+$', '', 'g')"


CR = "chr(13) || chr(10)"
OP1_SQL = f"""
with resp as (
  select page_id, coalesce(url, '') as target_uri, coalesce(html, '') as body,
    'Content-Type: text/html; charset=utf-8' as h1, 'Content-Length: ' || strlen(coalesce(html, ''))::varchar as h2,
    {_duck_id("'response'", "page_id::varchar", "coalesce(url, '')", "sha256(coalesce(html, ''))")} as refers_to
  from pages),
base as (
  select *, 'sha256:' || sha256(body) as source_payload_digest, {_duck_text("body")} as plain,
    trim(regexp_replace(regexp_replace(regexp_extract(body, '(?is)<title[^>]*>(.*?)</title', 1), '{TAG}', '', 'g'), '\\s+', ' ', 'g')) as title,
    lower(regexp_extract(body, '(?i)<meta[^>]*charset=["'']?([A-Za-z0-9_-]+)', 1)) as charset,
    regexp_extract_all(body, '(?i)<a\\b[^>]*?\\bhref=["'']([^"'']*)["'']', 1) as links
  from resp),
d as (
  select *, 'metadata' as record_type, 'application/warc-fields' as content_type,
    'title: ' || title || {CR} || 'charset: ' || charset || {CR} || 'sourceStatus: HTTP/1.1 200 OK' || {CR} || 'textLength: ' || length(plain)::varchar
    || {CR} || 'outlinkCount: ' || len(links)::varchar || {CR}
    || coalesce(array_to_string(list_transform(links, lambda x: 'outlink: ' || regexp_replace(x, '\\s+', ' ', 'g') || {CR}), ''), '') as block from base
  union all select *, 'conversion', 'text/plain; charset=utf-8', plain from base),
e as (select *, {_duck_id("record_type", "refers_to")} as record_id, 'sha256:' || sha256(block) as block_digest, strlen(block)::bigint as content_length from d)
select page_id, record_type, record_id, refers_to, target_uri, content_type, content_length, block_digest, source_payload_digest,
  h1 || chr(10) || h2 as source_headers, len(links)::int as n_links,
  sha256('WARC/1.1' || {CR} || 'WARC-Type: ' || record_type || {CR} || 'WARC-Record-ID: ' || record_id || {CR} || 'WARC-Refers-To: ' || refers_to
    || {CR} || 'WARC-Target-URI: ' || target_uri || {CR} || 'WARC-Date: {UNKNOWN_DATE}' || {CR} || 'WARC-Block-Digest: ' || block_digest
    || {CR} || 'WARC-Source-Payload-Digest: ' || source_payload_digest || {CR} || 'WARC-Source-Header: ' || h1 || {CR} || 'WARC-Source-Header: ' || h2
    || {CR} || 'Content-Type: ' || content_type || {CR} || 'Content-Length: ' || content_length::varchar || {CR} || {CR} || block) as record_sha256
from e
"""
