"""Main text of web pages by consensus of their hosts.

Pages of one host share templates. Each page scores its containers and votes for the generalised
tag-class path of the best; Spark counts the votes per host; then every page is read again and its text
taken from the host's winning path, or from its own best container where the template differs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotape.llm.common import present, stored
from chronotape.llm.html_blocks import article_blocks, best_container, outermost, read_page
from chronotape.operators.sizing import broadcast_if_small

#: Winners are broadcast up to this many hosts; beyond it, pages and winners meet in a shuffle.
MAX_HOSTS = 200_000


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without www; empty when there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(present(url), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)), r"^www\.", "")


def path_votes(pages: DataFrame) -> DataFrame:
    """host, path and votes: each page with text has one vote, weighted by how much of its text the path holds."""

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hosts, paths, weights = [], [], []
            for host, html in zip(batch["host"], batch["html"], strict=True):
                page = read_page(html)
                best = best_container(page)
                if best is not None:
                    hosts.append(host)
                    paths.append(best.path)
                    weights.append(round(100 * page.chars(best.start, best.end) / max(1, page.chars(0, len(page.blocks)))))
            yield pd.DataFrame({"host": hosts, "path": paths, "votes": pd.Series(weights, dtype="int64")})

    rows = pages.select(host_of(F.col("url")).alias("host"), present(F.col("html")).alias("html"))
    return rows.mapInPandas(vote, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))


def winning_paths(pages: DataFrame) -> DataFrame:
    """host and its winning path; ties go to the first path in order."""
    ranked = F.min(F.struct((-F.col("votes")).alias("v"), "path"))
    return path_votes(pages).groupBy("host").agg(ranked.alias("best")).select("host", F.col("best.path").alias("path"))


def main_text(source: str, path: str | None) -> str:
    """The text under ``path``, unless the page's own best container has article text besides."""
    page = read_page(source)
    best = best_container(page)
    nodes = outermost(page, path) if path else []
    if nodes:
        held = {k for x in nodes for k in range(x.start, x.end)}
        if held and held.issuperset(article_blocks(page)):
            return " ".join(t for x in nodes if (t := page.text(x.start, x.end)))
    return page.text(best.start, best.end) if best is not None else page.text(0, len(page.blocks))


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) for every page, with its host and the path voted for.

    Takes page_id, url and html; other columns are ignored. A null page is empty and gives an empty text.
    Pages without a host vote together. Repeated rows give equal texts, an empty table an empty result.
    """
    winners = stored(winning_paths(pages), "extraction-paths").withColumnRenamed("host", "__host")

    def extract(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sources, paths in batches:
            yield pd.Series([main_text(s, p) for s, p in zip(sources, paths, strict=True)], dtype=object)

    joined = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).join(
        broadcast_if_small(winners, MAX_HOSTS), F.col("host") == F.col("__host"), "left"
    )
    text = F.pandas_udf(extract, "string")(present(F.col("html")), F.col("path"))
    out = joined.select("page_id", "url", text.alias("text"), "host", "path")
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "host", "path")
