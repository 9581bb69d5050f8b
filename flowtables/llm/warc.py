"""WARC derivatives: a metadata and a plain-text conversion record for each response.

The derived records name their response in WARC-Refers-To, keep its target, date
and digests, and carry digests of their own blocks; the metadata block repeats the
response's HTTP headers. Record ids are made from the contents, so a repeated run
gives the same records.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from flowtables.llm.common import ship_functions

BLOCK_TAGS = "address article aside blockquote br dd div dl dt figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th title tr ul".split()


def _record_id(*parts: Column) -> Column:
    h = F.sha2(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)
    piece = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), piece(1, 8), F.lit("-"), piece(9, 4), F.lit("-5"), piece(14, 3), F.lit("-a"), piece(18, 3), F.lit("-"), piece(21, 12), F.lit(">"))


def _digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """page_id, record_id, target_uri, date, http_headers, payload, payload_digest, block_digest of fetched pages.

    For tables that hold (page_id, url, html) only: the HTTP headers are those that
    the body implies. A null page has an empty body, a null url an empty target.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n"))
    rows = pages.select("page_id", F.coalesce(F.col("url"), F.lit("")).alias("target_uri"), F.lit(date).alias("date"), headers.alias("http_headers"), body.alias("payload"))
    return rows.select(
        "page_id", _record_id(F.lit("response"), F.col("page_id"), F.col("target_uri"), F.col("payload")).alias("record_id"), "target_uri", "date", "http_headers", "payload",
        _digest(F.col("payload")).alias("payload_digest"), _digest(F.concat("http_headers", F.lit("\r\n"), "payload")).alias("block_digest"))


def plain_text(page: str, parts: re.Pattern, blocks: frozenset) -> tuple[str, str]:
    """Visible text and title. Block tags end a line; white space runs are one blank."""
    out, at, title = [], 0, ""
    for m in parts.finditer(page):
        out.append(page[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if name == "title" and not m["close"]:
            end = page.find("<", at)
            title = title or html.unescape(page[at : end if end >= 0 else len(page)])
        if name in blocks:
            out.append("\n")
    out.append(page[at:])
    text = html.unescape("".join(out))
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line), " ".join(title.split())


def derivatives(source: DataFrame) -> DataFrame:
    """Two rows for each response: page_id, kind, record_id, refers_to, target_uri, date, content_type, content_length, block_digest, source_digest, header, block.

    ``source`` is as :func:`responses` makes it. ``kind`` is ``metadata`` or
    ``conversion``; ``source_digest`` is the response's payload digest; ``header`` is the
    WARC header of the record. Scripts, styles and comments have no text; an
    unclosed one runs to the end. An empty page gives an empty conversion. Line ends and
    blanks in a target are percent-encoded. Rows alike give records alike. Whole pages of any length are read.
    """
    # comments, scripts and styles with their content, declarations, tags
    found = re.compile(
        r"<!--.*?(?:-->|\Z)|<(?:script|style|template|noscript)\b[^<>]*>.*?(?:</(?:script|style|template|noscript)\s*>|\Z)|<[!?][^<>]*+>"
        r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9]*)[^<>]*+>", re.S | re.I)
    blocks = frozenset(BLOCK_TAGS)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [plain_text(page, found, blocks) for page in frame["payload"]]
            out = frame.drop(columns="payload")
            out["text"], out["title"] = [t for t, _ in made], [t for _, t in made]
            out["payload_length"] = [len(p.encode("utf-8", "surrogatepass")) for p in frame["payload"]]
            yield out

    kept = source.select("page_id", "record_id", "target_uri", "date", "http_headers", "payload_digest", "block_digest", "payload")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "payload") + ", text string, title string, payload_length long"
    rows = kept.mapInPandas(work, schema)
    # status line, then one field per HTTP header
    fields = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace("http_headers", "^(HTTP/[^\r\n]*)", "http-status: $1"), r"\s+$", ""), "(?m)^(?!http-status)(?=[^\r\n])", "http-header-"), "\r?\n", "\r\n")
    about = F.concat(
        F.lit("source-record-id: "), "record_id", F.lit("\r\nsource-payload-digest: "), "payload_digest", F.lit("\r\nsource-block-digest: "), "block_digest",
        F.lit("\r\nsource-payload-length: "), F.col("payload_length").cast("string"), F.lit("\r\n"), fields, F.lit("\r\ntitle: "), "title",
        F.lit("\r\ntext-length: "), F.octet_length("text").cast("string"), F.lit("\r\n"))
    derived = F.array(
        F.struct(F.lit("metadata").alias("kind"), F.lit("application/warc-fields").alias("content_type"), about.alias("block")),
        F.struct(F.lit("conversion").alias("kind"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")))
    out = rows.select("page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", F.col("payload_digest").alias("source_digest"), F.inline(derived))
    out = out.withColumns({
        "record_id": _record_id(F.col("kind"), F.col("refers_to"), F.col("block")), "content_length": F.octet_length("block").cast("long"), "block_digest": _digest(F.col("block"))})
    uri = F.regexp_replace(F.regexp_replace(F.regexp_replace("target_uri", "\r", "%0D"), "\n", "%0A"), r"\s", "%20")
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), "kind", F.lit("\r\nWARC-Record-ID: "), "record_id", F.lit("\r\nWARC-Refers-To: "), "refers_to",
        F.when(uri != "", F.concat(F.lit("\r\nWARC-Target-URI: "), uri)).otherwise(F.lit("")), F.lit("\r\nWARC-Date: "), "date",
        F.lit("\r\nWARC-Block-Digest: "), "block_digest", F.lit("\r\nContent-Type: "), "content_type", F.lit("\r\nContent-Length: "), F.col("content_length").cast("string"), F.lit("\r\n"))
    return out.select("page_id", "kind", "record_id", "refers_to", "target_uri", "date", "content_type", "content_length", "block_digest", "source_digest", header.alias("header"), "block")


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """Files of whole records, header, blank line, block and two line ends each, written by Spark."""
    whole = F.concat("header", F.lit("\r\n"), "block", F.lit("\r\n"))
    records.select(whole.alias("record")).write.option("lineSep", "\r\n").option("compression", compression).text(path)


ship_functions(__name__)
