"""WARC derivatives: metadata and plain-text conversion records of response records."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.llm.common import need

CRLF = "\r\n"
# Elements whose borders break a line, and named entities. Fixed values
BLOCKS = "address|article|aside|blockquote|br|dd|div|dl|dt|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|tr|ul"
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&amp;", "&")]
RESPONSE = ["record_id", "target_uri", "warc_date", "http_headers", "payload"]


def urn(seed: Column) -> Column:
    """A record id from ``seed``: the same record gets the same id in every run."""
    d = F.md5(seed)
    return F.concat_ws("-", *[F.substring(d, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def _id(u: Column) -> Column:
    return F.concat(F.lit("<urn:uuid:"), u, F.lit(">"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def html_text(html: Column) -> Column:
    """Visible text: scripts, styles, comments and the head go, block elements break lines, the usual entities are decoded."""
    out = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    for element in ("script", "style", "head"):
        out = F.regexp_replace(out, rf"(?is)<{element}\b[^>]*>.*?</{element}\s*>", "")
    out = F.regexp_replace(out, rf"(?i)</?(?:{BLOCKS})\b[^>]*>", "\n")
    out = F.regexp_replace(out, "<[^>]*>", "")
    for name, char in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(char))
    out = F.regexp_replace(out, "[ \\t\\r\\f]+", " ")
    out = F.regexp_replace(out, " ?\\n[ \\n]*", "\n")
    return F.regexp_replace(out, "^[ \\n]+|[ \\n]+$", "")


def responses_of_pages(pages: DataFrame, date: str) -> DataFrame:
    """Response records of stored pages (page_id, url, html), with the headers a plain server sends. Nulls become empty."""
    rows = need(pages, "page_id", "url", "html")
    uri, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    seed = F.concat_ws("|", F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), uri, F.sha2(html, 256))
    headers = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(html).cast("string"),
    )
    return rows.select(
        "page_id", urn(seed).alias("record_id"), uri.alias("target_uri"), F.lit(date).alias("warc_date"),
        headers.alias("http_headers"), html.alias("payload"),
    )


def derivatives(responses: DataFrame, *keep: str) -> DataFrame:
    """Two records for each response: ``metadata`` (warc-fields with the source's id, headers, digests, title and link count)
    and ``conversion`` (plain text). Both refer to the response; the conversion also names the metadata record as concurrent.

    Input columns: record_id, target_uri, warc_date, http_headers, payload; ``keep`` are carried along. Null headers or
    payload count as empty, a null uri or date stays empty; repeated responses give repeated records; no row is lost and an
    empty table gives none. Everything is row-wise, so nothing is shuffled.
    """
    r = need(responses, *dict.fromkeys([*keep, *RESPONSE]))
    r = r.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in RESPONSE})
    head, payload = F.col("http_headers"), F.col("payload")
    block = F.concat(head, F.lit(CRLF * 2), payload)
    title = F.regexp_replace(F.regexp_extract(payload, r"(?is)<title[^>]*>(.*?)</title", 1), "[\\r\\n]+", " ")
    r = r.withColumns(
        {
            "_status": F.regexp_extract(head, "^HTTP/[0-9.]+ ([0-9]+)", 1),
            "_type": F.regexp_extract(head, r"(?i)\ncontent-type: *([^\r\n]*)", 1),
            "_block_digest": digest(block),
            "_payload_digest": digest(payload),
            "_length": F.octet_length(block).cast("string"),
            "_links": F.regexp_count(payload, F.lit(r"(?i)<a\s[^>]*href")).cast("string"),
            "_title": title,
            "_meta_id": urn(F.concat(F.lit("metadata|"), F.col("record_id"))),
            "_text_id": urn(F.concat(F.lit("conversion|"), F.col("record_id"))),
        }
    )
    fields = [
        ("source-record-id", _id(F.col("record_id"))), ("source-status", F.col("_status")), ("source-content-type", F.col("_type")),
        ("source-content-length", F.col("_length")), ("source-block-digest", F.col("_block_digest")),
        ("source-payload-digest", F.col("_payload_digest")), ("title", F.col("_title")), ("outlinks", F.col("_links")),
    ]
    meta = F.concat(*[F.concat(F.lit(f"{n}: "), v, F.lit(CRLF)) for n, v in fields])
    kinds = F.array(
        F.struct(F.lit("metadata").alias("type"), F.col("_meta_id").alias("id"), F.lit(None).cast("string").alias("with"),
                 F.lit("application/warc-fields").alias("mime"), meta.alias("content")),
        F.struct(F.lit("conversion").alias("type"), F.col("_text_id").alias("id"), F.col("_meta_id").alias("with"),
                 F.lit("text/plain; charset=utf-8").alias("mime"), html_text(payload).alias("content")),
    )
    rows = r.withColumn("_r", F.explode(kinds))
    content = F.col("_r.content")
    return rows.select(
        *[F.col(f"`{c}`") for c in keep],
        F.col("_r.type").alias("warc_type"), _id(F.col("_r.id")).alias("warc_record_id"),
        _id(F.col("record_id")).alias("warc_refers_to"), _id(F.col("_r.with")).alias("warc_concurrent_to"),
        F.col("target_uri").alias("warc_target_uri"), F.col("warc_date"), F.col("_r.mime").alias("content_type"),
        F.col("_payload_digest").alias("source_payload_digest"), digest(content).alias("warc_block_digest"),
        F.octet_length(content).cast("long").alias("content_length"), F.col("http_headers").alias("source_headers"), content.alias("content"),
    )


def record_text(records: DataFrame) -> DataFrame:
    """Column ``value``: each record as a WARC 1.1 file has it, without the two closing line ends."""
    names = [
        ("WARC-Type", "warc_type"), ("WARC-Record-ID", "warc_record_id"), ("WARC-Date", "warc_date"),
        ("WARC-Target-URI", "warc_target_uri"), ("WARC-Refers-To", "warc_refers_to"), ("WARC-Concurrent-To", "warc_concurrent_to"),
        ("WARC-Block-Digest", "warc_block_digest"), ("Content-Type", "content_type"),
    ]
    lines = [F.coalesce(F.concat(F.lit(f"{n}: "), F.col(c), F.lit(CRLF)), F.lit("")) for n, c in names]
    length = F.concat(F.lit("Content-Length: "), F.col("content_length").cast("string"), F.lit(CRLF * 2))
    return records.select(F.concat(F.lit(f"WARC/1.1{CRLF}"), *lines, length, F.col("content")).alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    """WARC files, one for each partition, written by Spark's own writer."""
    record_text(records).write.option("lineSep", CRLF * 2).text(path)
