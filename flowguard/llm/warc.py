"""Derivatives of WARC responses: linked metadata and plain-text conversion records.

Both derivatives name their response in ``WARC-Refers-To`` and keep its target URI and date. The metadata record holds the
response's HTTP status, its HTTP headers and both of its digests; the conversion record holds the readable text.
"""

from __future__ import annotations

import html as entities
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from flowguard.llm.registry import query, table

DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"
BASE32_FROM, BASE32_TO = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HIDDEN = ("script", "style", "template", "noscript", "iframe", "svg", "textarea")
BREAKING = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header"
    " hr html li main nav ol option p pre section select table tbody td tfoot th thead title tr ul".split()
)
TAG = re.compile(r"<(?:(!--)|[!?]|/?([A-Za-z][^\s/>]*))")
ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in HIDDEN}


def page_text(page: str | None) -> str:
    """Readable text of a page: a line per block element, white space folded, entities resolved.

    Linear in the page: comments, tags and hidden elements that are never closed reach to the end.
    """
    page = page or ""
    out, at = [], 0
    while (m := TAG.search(page, at)) is not None:
        out.append(page[at : m.start()])
        close = page.find("-->" if m[1] else ">", m.end())
        if close < 0:
            at = len(page)
            break
        at = close + (3 if m[1] else 1)
        name = (m[2] or "").lower()
        if name in BREAKING:
            out.append("\n")
        elif name in ENDS and page[m.start() + 1] != "/":
            end = ENDS[name].search(page, at)
            close = page.find(">", end.end()) if end else -1
            at = close + 1 if close >= 0 else len(page)
    out.append(page[at:])
    lines = (" ".join(line.split()) for line in entities.unescape("".join(out)).split("\n"))
    return "\n".join(line for line in lines if line)


@F.pandas_udf(StringType())
def page_texts(pages: pd.Series) -> pd.Series:
    return pages.map(page_text)


def sha1_label(data: Column) -> Column:
    """``sha1:`` and the digest in base 32, as crawlers write it."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.concat(F.lit("sha1:"), F.translate(F.concat(*parts), BASE32_FROM, BASE32_TO))


def record_id(*parts: Column) -> Column:
    """A urn:uuid that follows from the parts (version 5 layout)."""
    h = F.sha1(F.concat_ws("\u0000", *[F.coalesce(p.cast("string"), F.lit("\u0001")) for p in parts]))
    cut = lambda a, n: F.substring(h, a, n)
    uuid = F.concat_ws("-", cut(1, 8), cut(9, 4), F.concat(F.lit("5"), cut(14, 3)), F.concat(F.lit("8"), cut(18, 3)), cut(21, 12))
    return F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))


def one_line(value: Column) -> Column:
    """A header value: control characters, line ends among them, become blanks."""
    return F.regexp_replace(value, r"[\x00-\x1F\x7F]+", " ")


def response_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", date: str = DATE) -> DataFrame:
    """Response records of raw pages: key, record_id, target_uri, date, http, payload and the two digests.

    A null page is an empty payload, a null url gives no target URI. Equal rows get equal record ids.
    """
    payload = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(payload).cast("string"), F.lit(CRLF + CRLF),
    )
    rows = pages.select(F.col(f"`{key}`").alias("key"), one_line(F.col(f"`{url}`")).alias("target_uri"), payload.alias("payload"), http.alias("http"))
    return rows.select(
        "key", record_id(F.lit("response"), F.col("key"), F.col("target_uri"), F.sha1("payload")).alias("record_id"), "target_uri",
        F.lit(date).alias("date"), "http", "payload", sha1_label(F.concat("http", "payload")).alias("block_digest"),
        sha1_label(F.col("payload")).alias("payload_digest"),
    )


def derive(responses: DataFrame) -> DataFrame:
    """Two records per response: ``metadata`` and ``conversion``.

    Columns: key, record_type, record_id, refers_to, target_uri, date, content_type, source_block_digest,
    source_payload_digest, block_digest, content_length and block. Empty payloads give an empty conversion block.
    """
    status = F.regexp_extract("http", r"^HTTP/\S+ (\d+)", 1)
    headers = F.transform(
        F.filter(F.slice(F.split("http", CRLF), 2, 1_000_000), lambda h: F.instr(h, ":") > 0), lambda h: F.concat(F.lit("http-header-"), h)
    )
    fields = F.concat(
        F.array(
            F.concat(F.lit("source-record: "), F.col("record_id")), F.concat(F.lit("source-block-digest: "), F.col("block_digest")),
            F.concat(F.lit("source-payload-digest: "), F.col("payload_digest")), F.concat(F.lit("http-status: "), status),
        ),
        headers,
    )
    whole = responses.withColumn("_metadata", F.concat(F.array_join(fields, CRLF), F.lit(CRLF))).withColumn("_text", page_texts("payload"))

    def kind(name: str, content_type: str, block: str) -> Column:
        return F.struct(
            F.lit(name).alias("record_type"), record_id(F.lit(name), F.col("record_id")).alias("record_id"),
            F.lit(content_type).alias("content_type"), F.col(block).alias("block"),
        )

    pair = F.array(kind("metadata", "application/warc-fields", "_metadata"), kind("conversion", "text/plain; charset=utf-8", "_text"))
    split = whole.select(
        "key", F.col("record_id").alias("refers_to"), "target_uri", "date", F.col("block_digest").alias("source_block_digest"),
        F.col("payload_digest").alias("source_payload_digest"), F.explode(pair).alias("r"),
    )
    return split.select(
        "key", "r.record_type", "r.record_id", "refers_to", "target_uri", "date", "r.content_type", "source_block_digest",
        "source_payload_digest", sha1_label(F.col("r.block")).alias("block_digest"),
        F.octet_length("r.block").cast("long").alias("content_length"), "r.block",
    )


def warc_text(records: DataFrame) -> DataFrame:
    """One column ``value`` with each record's WARC header and block; the record separator is left to the writer."""
    def line(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value))

    head = F.concat_ws(
        CRLF, F.lit("WARC/1.1"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Refers-To", F.col("refers_to")), line("WARC-Target-URI", F.col("target_uri")), line("WARC-Date", F.col("date")),
        line("WARC-Block-Digest", F.col("block_digest")), line("WARC-Source-Payload-Digest", F.col("source_payload_digest")),
        line("WARC-Source-Block-Digest", F.col("source_block_digest")), line("Content-Type", F.col("content_type")),
        line("Content-Length", F.col("content_length").cast("string")),
    )
    return records.select(F.concat(head, F.lit(CRLF + CRLF), F.col("block")).alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    """WARC files, one per partition, by Spark's text writer: its line separator is the end of a record."""
    warc_text(records).write.option("lineSep", CRLF + CRLF).text(path)


def read_warc(spark, path: str) -> DataFrame:
    """(headers map, block) of the records in files of ``write_warc``; large files are split between tasks."""
    pieces = spark.read.option("lineSep", f"{CRLF}{CRLF}WARC/1.1{CRLF}").text(path)
    text = F.regexp_replace("value", r"^WARC/1\.1\r\n", "")
    cut = F.instr(text, CRLF + CRLF)
    head = F.substring(text, F.lit(1), cut - 1)
    headers = F.map_from_entries(F.transform(F.split(head, CRLF), lambda h: F.struct(
        F.substring_index(h, ": ", 1), F.substring(h, F.instr(h, ": ") + 2, F.length(h)))))
    rest = F.substring(text, cut + 4, F.length(text)).cast("binary")
    return pieces.select(headers.alias("headers"), rest.alias("_rest")).select(
        "headers", F.substring("_rest", F.lit(1), F.col("headers")["Content-Length"].cast("int")).cast("string").alias("block")
    )


@query("op3_warc_derivatives")
def op3_warc_derivatives(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return derive(response_records(pages)).withColumnRenamed("key", "page_id")
