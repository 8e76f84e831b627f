"""Writers for archives, link batches, ledgers and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pressline.operators.batches import batch_list
from pressline.operators.records import markers_in
from pressline.sources.readers import READ_ORDER


def _line(raw: Column) -> Column:
    """Record text without its last newline, which the text writer adds."""
    return F.regexp_replace(raw, r"\n\z", "")


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """Bring rows of a key together for partitioned output.

    Rebalancing splits a key that is too large for one task, and joins small
    ones, by their measured size.
    """
    return df.hint("rebalance", *keys)


def write_articles(records: DataFrame, path: str, *, raw: str = "raw", order: Sequence[str] = (), mode: str = "append") -> None:
    """Append the records of a batch to its own file set; no file is replaced.

    With ``order`` the records of a file stand in that order.
    """
    rows = _spread(records.where(F.col(raw).isNotNull()).select("batch_no", *order, _line(F.col(raw)).alias("value")), "batch_no")
    if order:
        rows = rows.sortWithinPartitions("batch_no", *order).drop(*order)
    rows.write.mode(mode).partitionBy("batch_no").text(path)


def write_split(judged: DataFrame, path: str, *, raw: str = "raw") -> None:
    """One write, one folder per language side; an empty side gets no folder."""
    rows = judged.select("lang_side", "batch_no", _line(F.col(raw)).alias("value"))
    _spread(rows, "lang_side", "batch_no").write.mode("overwrite").partitionBy("lang_side", "batch_no").text(path)


def write_archive(records: DataFrame, path: str, *, raw: str = "raw", order: Sequence[str] = READ_ORDER,
                  compression: str | None = None) -> dict[str, int]:
    """Combined archive in reading order: the part files follow one another; the written records and record markers.

    Counted behind the sort, whose sampling reads the rows once more.
    """
    seen = Observation()
    rows = records.orderBy(*order).select(_line(F.col(raw)).alias("value")).observe(
        seen, F.count("*").alias("records"), F.coalesce(F.sum(markers_in("value")), F.lit(0)).alias("markers"))
    out = rows.write.mode("overwrite")
    (out.option("compression", compression) if compression else out).text(path)
    return seen.get


def write_summary(summary: DataFrame, path: str) -> None:
    """A summary is one row, so it is one file."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def write_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).sortWithinPartitions("line_no").select("line").write.mode("overwrite").text(path)


def write_links(links: DataFrame, path: str) -> None:
    """Link list as JSON rows, one URL per line and any number of files."""
    links.select("url").write.mode("overwrite").json(path)


def write_batches(batches: DataFrame, path: str) -> None:
    """One file set per link batch; earlier batches are replaced."""
    _spread(batches, "batch_no").write.mode("overwrite").partitionBy("batch_no").json(path)


def write_progress(done: DataFrame, path: str, *, mode: str = "append") -> None:
    """Append processed URLs to the ledger."""
    done.select("batch_no", "url").write.mode(mode).json(path)


def write_batch_index(batches: DataFrame, path: str, *, size: int) -> dict[str, int]:
    """Index of the written batches in the folder ``path``: ``batch_index`` with the totals, ``batch_list`` with a row for each batch.

    The list grows with the links, so it is rows and not one array.  Both begin
    with an underscore on disk, and readers of the batches pass them over.
    """
    listed = batch_list(batches).withColumn("file", F.concat(F.lit(f"{path}/batch_no="), F.col("batch_no").cast("string")))
    listed.write.mode("overwrite").json(f"{path}/_batch_list")
    written = batches.sparkSession.read.schema(listed.schema).json(f"{path}/_batch_list")
    totals = written.agg(
        F.coalesce(F.sum("n_links"), F.lit(0)).cast("bigint").alias("total_links"), F.lit(size).cast("bigint").alias("batch_size"), F.count("*").alias("total_batches"))
    write_summary(totals, f"{path}/_batch_index")
    return batches.sparkSession.read.schema(totals.schema).json(f"{path}/_batch_index").first().asDict()
