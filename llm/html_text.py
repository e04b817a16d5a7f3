"""Main text of web pages by consensus of the pages of a host."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.sinks.staging import Staging
from llm.html_blocks import Block, inside, main_container, page_blocks
from llm.shipping import ship


def _vote_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One vote a page, for its best container."""
    for batch in batches:
        hosts, paths = [], []
        for host, page in zip(batch.column("host"), batch.column("html"), strict=True):
            best = main_container(page_blocks(page.as_py() or ""))
            if best is not None:
                hosts.append(host.as_py())
                paths.append(best)
        yield pa.record_batch(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array([1] * len(paths), pa.int64())],
            names=["host", "path", "votes"],
        )


def page_text(found: list[Block], won: str | None) -> str:
    """Text of the host's path and of what the page's own best container holds beyond it.

    Only where the host's path has the page's first heading, and the own container lies
    elsewhere and has none, the path is the article and the container a box beside it.
    """
    own = main_container(found)
    if own is None or won is None or won == own:
        return _joined(inside(found, own or won))
    ours, theirs = inside(found, own), inside(found, won)
    common = {id(b) for b in theirs}
    apart = not any(id(b) in common for b in ours)
    if apart and _headed(theirs) and not _headed(ours):
        return _joined(theirs)
    wanted = common | {id(b) for b in ours}
    return _joined([b for b in found if id(b) in wanted])


def _headed(found: list[Block]) -> bool:
    return any(b[3] == "h1" for b in found)


def _joined(found: list[Block]) -> str:
    return "\n\n".join(b[0] for b in found)


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, path in zip(batch.column("html"), batch.column("path"), strict=True):
            texts.append(page_text(page_blocks(page.as_py() or ""), path.as_py()))
        yield pa.record_batch(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def _pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    ship(pages.sparkSession)
    url = F.col(url_col).cast("string")
    # The part between // and the next of / ? # :, in lower case; without one, no host.
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        url.alias("url"),
        host.alias("host"),
        F.col(html_col).cast("string").alias("html"),
    )


def host_paths(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path, votes): the container path that most pages of a host find best.

    Votes are summed before the shuffle, so a host with most pages is no large group.
    Ties go to the first path by name.
    """
    votes = _pages(pages, id_col, url_col, html_col).select("host", "html")
    votes = votes.mapInArrow(_vote_batches, "host string, path string, votes long")
    counted = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    ranked = F.struct((-F.col("votes")).alias("rank"), "path")
    won = counted.groupBy("host").agg(F.min_by(F.struct("path", "votes"), ranked).alias("won"))
    return won.select("host", "won.path", "won.votes")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars.

    Each page's containers are scored by their text outside links and the best one,
    widened over what belongs to it, votes for its generalised path (tags and classes);
    the winning path of the host then extracts its pages. What the page's own best
    container holds beyond that path is kept too, so a page of another template loses
    nothing, however few such pages the host has, unless the path has the page's first
    heading and the container is apart from it.
    Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
    comments are left out by element, role or class, unless they hold the page.

    Null or empty pages and pages without text give an empty text; pages without a host
    vote together. Ids and urls may be null or repeat; rows are independent. Other
    columns do not matter; an empty table gives an empty result. Only the table of
    hosts is joined: broadcast while Spark knows it to be small, else by its key.
    """
    stage = Staging(pages.sparkSession)
    paths = stage(host_paths(pages, id_col, url_col, html_col), "host-paths").select("host", "path")
    rows = _pages(pages, id_col, url_col, html_col).join(paths, "host", "left")
    out = rows.select("page_id", "url", "html", "path").mapInArrow(_extract_batches, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
