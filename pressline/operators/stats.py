"""Run statistics and page sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressline.operators.batches import global_index


def collector_stats(links: DataFrame, fetches: DataFrame) -> DataFrame:
    """One row of link-collection statistics.

    ``links(page_url, url, kind, is_article)`` has one row per page and link,
    ``fetches(url, outcome)`` one row per page.  Article links are counted by
    occurrence; unique counts go through a partial aggregation by URL.
    """
    names = ("pages_visited", "links_found", "unique_links", "categories", "tags", "authors", "errors", "failed_urls")

    def row(df: DataFrame, **counts: Column) -> DataFrame:
        return df.select(*[counts.get(n, F.lit(0)).cast("bigint").alias(n) for n in names])

    article, kind, outcome = F.col("is_article"), F.col("kind"), F.col("outcome")
    per_url = links.groupBy("url", "kind", "is_article").agg(F.count("*").alias("n"))
    found = row(
        per_url, links_found=F.when(article, F.col("n")), unique_links=article,
        categories=kind == "category", tags=kind == "tag", authors=kind == "author",
    )
    pages = row(fetches, pages_visited=outcome == "ok", errors=outcome == "failed", failed_urls=outcome != "ok")
    return found.unionByName(pages).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def extraction_stats(rows: DataFrame, *, error: str = "error", content: str = "content") -> DataFrame:
    """One row: attempted, successful, failed and empty extractions."""
    failed = F.col(error).isNotNull()
    empty = F.col(error) == "No content extracted"
    return rows.agg(
        F.count("*").alias("total_attempted"),
        F.count_if(~failed).alias("successful_scrapes"),
        F.count_if(failed).alias("failed_scrapes"),
        F.count_if(F.coalesce(empty, F.lit(False)) & F.col(content).isNull()).alias("empty_content"),
    )


def error_histogram(rows: DataFrame, *, error: str = "error") -> DataFrame:
    """Errors by type: the part before the first colon."""
    return rows.where(F.col(error).isNotNull()).groupBy(
        F.substring_index(error, ":", 1).alias("error_type")
    ).agg(F.count("*").alias("n"))


def batch_tallies(rows: DataFrame, *, reason: str = "reject_reason", batch: str = "batch_no") -> DataFrame:
    """Per batch: processed, successful and skipped articles."""
    return rows.groupBy(batch).agg(
        F.count("*").alias("processed"),
        F.count_if(F.col(reason).isNull()).alias("successful"),
        F.count_if(F.col(reason).isNotNull()).alias("skipped"),
    )


def fetch_outcome(attempts: DataFrame, *, max_attempts: int = 5) -> DataFrame:
    """``(url, outcome, attempts)`` from a log of numbered attempts.

    The first 200 or 404 within the limit decides ('ok' / 'gone') and ends the
    fetch; without either the URL 'failed' after its last counted attempt.
    """
    final = attempts.where(F.col("attempt") <= max_attempts).groupBy("url").agg(
        F.min(F.when(F.col("status").isin(200, 404), F.col("attempt"))).alias("_end"),
        F.min_by("status", F.when(F.col("status").isin(200, 404), F.col("attempt"))).alias("_status"),
        F.max("attempt").alias("_last"),
    )
    return final.select(
        "url",
        F.when(F.col("_status") == 200, "ok").when(F.col("_status") == 404, "gone").otherwise("failed").alias("outcome"),
        F.coalesce("_end", "_last").cast("bigint").alias("attempts"),
    )


def run_summary(rows: DataFrame, *, start: str = "ts", end: str = "ts", links, articles) -> DataFrame:
    """One row: start, end, duration, links found, articles scraped, status."""
    span = rows.agg(
        F.min(start).alias("_t0"), F.max(end).alias("_t1"),
        links.alias("total_links_found"), articles.alias("articles_scraped"),
    )
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    return span.select(
        F.date_format("_t0", iso).alias("start_time"), F.date_format("_t1", iso).alias("end_time"),
        F.timestamp_diff("SECOND", "_t0", "_t1").cast("double").alias("duration_seconds"),
        "total_links_found", "articles_scraped", F.lit("Complete").alias("status"),
    )


def pages_until_empty(pages: DataFrame, *, by: Sequence[str] = ("listing",), k: int = 2,
                      max_page: int | None = None, first_must_have_links: bool = False) -> DataFrame:
    """Pages that a walk over a listing visits.

    ``pages(<by>, page, n_links)`` numbers the pages of a listing; numbers may be
    missing, and the pages that are there follow one another.  They are taken up
    to and including the ``k``-th empty one in a row, and up to page number
    ``max_page``.  With ``first_must_have_links`` a listing whose first page is
    empty stops there.

    All pages get their place in the order of listings and page numbers, without
    a window over a listing.  The page at place ``p`` ends a run of ``k`` empty
    ones iff the places ``p-k+1 .. p`` of its listing are empty.  Each empty page
    votes for the places it could count for, so the runs are found by a partial
    aggregation on (listing, place).
    """
    kept = pages if max_page is None else pages.where(F.col("page") <= max_page)
    placed = global_index(kept.withColumn("_key", F.struct(*by, "page")), "_key").drop("_key")
    empty = placed.where(F.col("n_links") == 0).select(*by, "idx")
    votes = empty.select(*by, F.explode(F.sequence(F.col("idx"), F.col("idx") + (k - 1))).alias("idx"))
    stops = votes.groupBy(*by, "idx").agg(F.count("*").alias("_n")).where(F.col("_n") == k).select(*by, "idx")
    if first_must_have_links:
        first = placed.groupBy(*by).agg(F.min("idx").alias("idx"), F.min_by("n_links", "idx").alias("_links"))
        stops = stops.unionByName(first.where(F.col("_links") == 0).select(*by, "idx"))
    cuts = stops.groupBy(*by).agg(F.min("idx").alias("_cut"))
    return (
        placed.join(cuts, list(by), "left").where(F.col("_cut").isNull() | (F.col("idx") <= F.col("_cut")))
        .select(*pages.columns)
    )


def new_links_per_page(links: DataFrame, *, by: Sequence[str] = (), page: str = "page", url: str = "url") -> DataFrame:
    """Growth of the link set: per page, the links not seen on an earlier page."""
    first = links.groupBy(*by, url).agg(F.min(page).alias(page)).groupBy(*by, page).agg(F.count("*").alias("new_links"))
    pages = links.select(*by, page).distinct()
    return pages.join(first, [*by, page], "left").select(
        *by, page, F.coalesce("new_links", F.lit(0)).cast("bigint").alias("new_links")
    )


def progress_marks(rows: DataFrame, *, key: str, every: int) -> DataFrame:
    """Every ``every``-th row in the order of a unique key, with its 1-based number."""
    return global_index(rows.select(key), key).select(key, (F.col("idx") + 1).alias("done")).where(F.col("done") % every == 0)
