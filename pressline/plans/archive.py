"""Whole runs: stored pages, or records, to the archive and all that is written beside it.

Each stage writes what the next one reads, under one folder, so that a run can be looked at and gone on
with; what it counts it takes from the writes themselves.
"""

from __future__ import annotations

import posixpath
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pressline.functions.text import clean_text
from pressline.operators.dedup import combine_summary, filter_rollup, later_copies, report_rows, without
from pressline.operators.links import remaining
from pressline.operators.language import record_verdict, split_sides
from pressline.operators.records import markers_in, record_url, render_records
from pressline.params import DEFAULT_RULES, Rules
from pressline.plans.articles import scrape_rows
from pressline.session import exists, tidy
from pressline.sources import readers, sinks


@dataclass(frozen=True)
class Paths:
    """What lies where below the folder of a run."""

    out: str

    def __getattr__(self, name: str) -> str:
        return posixpath.join(self.out, name)


def judge_records(records: DataFrame, out: str, *, rules: Rules = DEFAULT_RULES, compat: bool = False) -> dict[str, int]:
    """Records -> ``judged``, one folder for each language side; the counts of the write.

    This is the one job that reads the records.  The table holds the texts with
    their reading order, their URL and their side.
    """
    order = [c for c in readers.READ_ORDER if c in records.columns]
    judged = split_sides(record_verdict(records, lex=rules.lexicon, compat=compat))
    url = record_url("raw") if compat else F.col("url")
    rows = judged.select("lang_side", *order, url.alias("url"), "raw")
    counts, local = Observation(), F.col("lang_side") == "local"
    rows.observe(
        counts, F.count("*").alias("records"), F.count_if(local).alias("local"), F.count_if(~local).alias("foreign"),
        F.coalesce(F.sum(markers_in("raw")), F.lit(0)).alias("markers"),
    ).write.mode("overwrite").partitionBy("lang_side").parquet(Paths(out).judged)
    return counts.get


def _judged(spark, out: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(Paths(out).judged)


def build_archive(
    records: DataFrame, out: str, *, rules: Rules = DEFAULT_RULES, name: str = "archive", deduplicate: bool = True, clean: bool = False,
    compat: bool = False, compression: str | None = None, timestamp: Column | None = None,
) -> dict[str, int]:
    """Records -> sides, archive, summaries and report below ``out``; the counts that were taken on the way.

    ``judged``: all records with their side.  ``sides``: their texts by side and
    batch.  ``archive``: the local first-seen records in reading order.
    ``summary``: the archive's counts.  ``filter_counts`` and ``filter_summary``:
    local and foreign records by file, by directory and in all.  ``report``: the
    counts in words.  The input is read once; duplicates are found on positions,
    and texts are only moved to put the archive in order.
    """
    spark, at = records.sparkSession, Paths(out)
    order = [c for c in readers.READ_ORDER if c in records.columns]
    kinds = {f.name: f.dataType.simpleString() for f in records.schema}
    now = F.current_timestamp() if timestamp is None else timestamp
    counts = dict(judge_records(records, out, rules=rules, compat=compat))
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in order), "url string", "raw string", "lang_side string"])
    judged = _judged(spark, out, schema)
    sinks.write_split(judged, at.sides)
    local = judged.where("lang_side = 'local'").drop("lang_side")
    with tidy(spark):
        first = without(local, later_copies(local, order=order), order) if deduplicate else local
        kept = first.withColumn("raw", clean_text("raw")) if clean else first
        seen = sinks.write_archive(kept, at.archive, order=order, compression=compression)
    counts |= {"unique": seen["records"], "archive_markers": seen["markers"]}
    counts["input_files"] = local.agg(F.count_distinct("file")).first()[0]
    totals = spark.createDataFrame(
        [(counts["input_files"], counts["local"], counts["unique"], counts["local"] - counts["unique"])],
        "input_files bigint, total_articles bigint, unique_articles bigint, duplicate_articles bigint")
    summary = combine_summary(totals, at.archive, now)
    sinks.write_summary(summary, at.summary)
    sinks.write_report(report_rows(summary, name=name, generated=now), at.report)
    rollup = filter_rollup(judged.select("batch_no", "file", (F.col("lang_side") == "foreign").alias("is_foreign")), directory="batch_no")
    rollup.write.mode("overwrite").json(at.filter_counts)
    by_level = spark.read.schema(rollup.schema).json(at.filter_counts)
    sinks.write_summary(by_level.where("level = 'all'").select("total_processed", "local_articles", "foreign_articles", "batch_dirs_processed"), at.filter_summary)
    return counts


RUN = "run"


def next_run(spark: SparkSession, out: str) -> int:
    """Number of the next run: one more than the last that has finished its ledger."""
    ledger = Paths(out).progress
    if not exists(spark, f"{ledger}/{RUN}=*"):
        return 0
    last = spark.read.schema(f"batch_no int, url string, {RUN} int").json(ledger).agg(F.max(RUN)).first()[0]
    return 0 if last is None else last + 1


def scrape_pages(pages: DataFrame, out: str, *, rules: Rules = DEFAULT_RULES) -> dict[str, int]:
    """Pages with a batch number -> ``scraped`` rows, ``articles`` by batch and the ledger ``progress``, under the run's number.

    Rejected pages stay in ``scraped`` with their reason and are processed, too,
    so that the next run leaves them out.  The ledger is written last, from the
    written rows: a run that ends before it is done again under the same number,
    and replaces what it has left.
    """
    spark, at, run = pages.sparkSession, Paths(out), f"{RUN}={next_run(pages.sparkSession, out)}"
    rows = scrape_rows(pages, rules=rules, keep=("batch_no",))
    written = render_records(rows, site=rules.site, bl=rules.blacklist)
    raw = F.when(F.col("reject_reason").isNull(), F.col("raw"))
    table = written.select("page_id", "batch_no", "url", "reject_reason", raw.alias("raw"))
    counts, path = Observation(), posixpath.join(at.scraped, run)
    table.observe(
        counts, F.count("*").alias("processed"), F.count("reject_reason").alias("rejected"), F.count("raw").alias("written"),
    ).write.mode("overwrite").parquet(path)
    scraped = spark.read.schema(table.schema).parquet(path)
    sinks.write_articles(scraped, posixpath.join(at.articles, run), order=("page_id",), mode="overwrite")
    sinks.write_progress(scraped.where("url is not null").select("batch_no", "url").distinct(), posixpath.join(at.progress, run), mode="overwrite")
    return counts.get


def run_archive(pages: DataFrame, out: str, *, rules: Rules = DEFAULT_RULES, **options) -> dict[str, int]:
    """``pages(page_id, url, html, batch_no)`` -> everything: what is not yet in the ledger is scraped, then the archive is built.

    A second run on the same folder scrapes only pages that are new and builds
    the archive over all articles so far.
    """
    spark, at = pages.sparkSession, Paths(out)
    done = readers.read_progress(spark, at.progress).select("batch_no", "url").distinct()
    counts = scrape_pages(remaining(pages, done), out, rules=rules)
    records = readers.read_articles(spark, at.articles, glob="*.txt")
    return {**counts, **build_archive(records, out, rules=rules, **options)}
