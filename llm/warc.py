"""WARC records: responses of pages, and the metadata and plain-text records derived from them."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.html_blocks import visible_text
from llm.shipping import ship

VERSION = "WARC/1.1"
CRAWL_DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
HEADER_ORDER = (
    "WARC-Type",
    "WARC-Record-ID",
    "WARC-Date",
    "WARC-Target-URI",
    "WARC-Refers-To",
    "WARC-Payload-Digest",
    "WARC-Block-Digest",
    "Content-Type",
    "Content-Length",
)
_TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.I | re.S)
_LANGUAGE = re.compile(r"<html[^>]*\slang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
_LINK = re.compile(r"<a\s[^>]*?href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def _digest(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content, 256))


def _record_id(*parts: Column) -> Column:
    """A urn:uuid made of the parts alone, so a rerun names records alike."""
    digest = F.md5(F.concat_ws("\n", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    cut = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def responses(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = CRAWL_DATE
) -> DataFrame:
    """Response records of fetched pages: source_id and the columns of :func:`read_warc`.

    The block is an HTTP header and the page. A null page is an empty one; a null url
    has no target. Rows alike in id, url and page have the same record id.
    """
    body = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("source_id"), F.col(url_col).cast("string").alias("url"), body.alias("body"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("body").cast("string"),
    )
    content = F.concat(head, F.lit(END), F.col("body"))
    rows = rows.select("source_id", "url", _digest(F.col("body")).alias("payload"), content.alias("content"))
    headers = F.map_filter(
        F.create_map(
            F.lit("WARC-Type"), F.lit("response"),
            F.lit("WARC-Record-ID"), _record_id(F.col("source_id"), F.col("url"), F.col("payload")),
            F.lit("WARC-Date"), F.lit(date),
            F.lit("WARC-Target-URI"), F.col("url"),
            F.lit("WARC-Payload-Digest"), F.col("payload"),
            F.lit("WARC-Block-Digest"), _digest(F.col("content")),
            F.lit("Content-Type"), F.lit("application/http; msgtype=response"),
            F.lit("Content-Length"), F.octet_length("content").cast("string"),
        ),
        lambda _, v: v.isNotNull(),
    )
    return rows.select("source_id", headers.alias("headers"), "content")


def _derive_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The metadata fields and the plain text of each response block."""
    for batch in batches:
        metadata, texts = [], []
        for value, digest in zip(batch.column("content"), batch.column("payload"), strict=True):
            head, _, body = (value.as_py() or "").partition(END)
            title = _TITLE.search(body)
            language = _LANGUAGE.search(body)
            fields = [f"source-payload-digest: {digest.as_py() or ''}"]
            fields += [f"source-http-header: {line}" for line in head.split("\r\n") if line]
            if title:
                fields.append(f"title: {' '.join(html.unescape(title[1]).split())}")
            if language:
                fields.append(f"language: {language[1].lower()}")
            for link in _LINK.findall(body):
                target = " ".join(html.unescape("".join(link)).split())
                if target:
                    fields.append(f"outlink: {target}")
            metadata.append("\r\n".join(fields) + "\r\n")
            texts.append(visible_text(body))
        yield pa.record_batch(
            [*(batch.column(c) for c in ("source_id", "headers")), pa.array(metadata, pa.string()), pa.array(texts, pa.string())],
            names=["source_id", "headers", "metadata", "conversion"],
        )


def derivatives(records: DataFrame) -> DataFrame:
    """A metadata and a conversion record for each response: source_id, headers, content.

    Takes response records (source_id, headers, content); records of other types derive
    nothing. Both refer to the response by WARC-Refers-To and keep its date, target and
    payload digest; the metadata record holds its HTTP header lines, title, language
    and links as fields, the conversion record its text without markup. Record ids
    follow from the response's. A response without content gives an empty text; a row
    with null headers is no response and derives nothing. Repeated responses derive
    repeated records of the same ids. An empty table gives an empty result; columns
    other than the three do not matter. Contents of any length are held one at a time.
    """
    ship(records.sparkSession)
    headers = F.map_filter(F.col("headers"), lambda _, v: v.isNotNull())
    rows = records.select(
        F.col("source_id").cast("long").alias("source_id"), headers.alias("headers"), F.coalesce("content", F.lit("")).alias("content")
    ).where(F.col("headers")["WARC-Type"] == "response")
    derived = rows.withColumn("payload", F.col("headers")["WARC-Payload-Digest"]).mapInArrow(
        _derive_batches, "source_id long, headers map<string,string>, metadata string, conversion string"
    )
    kinds = F.array(
        F.struct(F.lit("metadata").alias("kind"), F.lit("application/warc-fields").alias("type"), F.col("metadata").alias("content")),
        F.struct(F.lit("conversion").alias("kind"), F.lit("text/plain; charset=utf-8").alias("type"), F.col("conversion").alias("content")),
    )
    each = derived.select("source_id", "headers", F.explode(kinds).alias("d")).select("source_id", "headers", "d.*")
    source = F.col("headers")
    own = F.map_filter(
        F.create_map(
            F.lit("WARC-Type"), F.col("kind"),
            F.lit("WARC-Record-ID"), _record_id(source["WARC-Record-ID"], F.col("kind")),
            F.lit("WARC-Date"), source["WARC-Date"],
            F.lit("WARC-Target-URI"), source["WARC-Target-URI"],
            F.lit("WARC-Refers-To"), source["WARC-Record-ID"],
            F.lit("WARC-Payload-Digest"), source["WARC-Payload-Digest"],
            F.lit("WARC-Block-Digest"), _digest(F.col("content")),
            F.lit("Content-Type"), F.col("type"),
            F.lit("Content-Length"), F.octet_length("content").cast("string"),
        ),
        lambda _, v: v.isNotNull(),
    )
    return each.select("source_id", own.alias("headers"), "content")


def record_text(headers: Column, content: Column) -> Column:
    """A whole record but for the two line ends that close it."""
    lines = [F.concat(F.lit(f"{name}: "), headers[name]) for name in HEADER_ORDER]
    return F.concat(F.concat_ws("\r\n", F.lit(VERSION), *lines), F.lit(END), content)


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as WARC files below ``path``, one a task, through Spark's own committer."""
    rows = records.select(record_text(F.col("headers"), F.col("content")).alias("value"))
    rows.write.option("lineSep", END).option("compression", compression).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(headers, content) of the records in WARC files of UTF-8 text.

    Files are cut where a record's end meets the next one's version line. A piece whose
    length is not the stated one raises: its content held such a place itself.
    """
    rows = spark.read.option("lineSep", f"{END}{VERSION}\r\n").text(path)
    text = F.regexp_replace("value", rf"^{VERSION}\r\n", "")
    # The file's last record still has its end.
    head = F.substring_index(text, END, 1)
    lines = F.filter(F.split(head, "\r\n"), lambda x: x != "")
    headers = F.map_from_entries(
        F.transform(lines, lambda x: F.struct(F.substring_index(x, ": ", 1), F.substring(x, F.instr(x, ": ") + 2, F.length(x))))
    )
    rows = rows.select(headers.alias("headers"), F.expr("substring(value, 1)").alias("value"), head.alias("head"), text.alias("text"))
    body = F.expr(f"substring(text, char_length(head) + {len(END) + 1})")
    rows = rows.select("headers", body.alias("body"))
    size = F.col("headers")["Content-Length"].cast("long")
    content = F.when(F.octet_length("body") == size, F.col("body")).otherwise(
        F.when(
            F.expr(f"body like '%\\r\\n\\r\\n' and octet_length(body) - {len(END)} = cast(headers['Content-Length'] as long)"),
            F.expr(f"left(body, char_length(body) - {len(END)})"),
        )
    )
    checked = F.coalesce(content, F.raise_error(F.lit("a record's length is not the stated one")).cast("string"))
    return rows.select("headers", checked.alias("content"))
