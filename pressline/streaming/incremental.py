"""Incremental mode: new archive files in, processed records out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pressline import fixed_values as fv
from pressline.functions.text import strip
from pressline.operators.batches import batch_no_of
from pressline.operators.dedup import dedup_first_seen
from pressline.operators.records import record_url, with_marker
from pressline.session import cut, exists, tidy
from pressline.sources.readers import ARCHIVE_GLOB


def stream_articles(spark: SparkSession, path: str, *, glob: str = ARCHIVE_GLOB,
                    marker: str = fv.RECORD_MARKER, files_per_trigger: int | None = None) -> DataFrame:
    """Archive records of files as they appear: (batch_no, file, block, raw); ``block`` is the start of the split in its file."""
    reader = (
        spark.readStream.option("lineSep", marker).option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    chunks = reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return chunks.where(strip("value") != "").select(
        batch_no_of("file").alias("batch_no"), "file", "block", with_marker("value").alias("raw")
    )


def _finished(query: StreamingQuery, timeout: int | None) -> None:
    """Wait for a run; one that is not done in time is stopped and raises."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"the run was not done after {timeout} s")


def run_incremental(stream: DataFrame, out: str, checkpoint: str, *,
                    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
                    timeout: int | None = None) -> None:
    """Process everything that is new and stop.

    The checkpoint commits the input files together with the output rows, so a
    restart neither repeats nor loses a record.  A run that is not done within
    ``timeout`` seconds is stopped and raises ``TimeoutError``; the next run on the
    checkpoint goes on from there.
    """
    _finished(
        transform(stream).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(), timeout)


RUN = "run"


def run_path(table: str, number: int) -> str:
    """Where a run of a table lies; as a partition folder, so that the table reads as one."""
    return f"{table}/{RUN}={number}"


def runs_before(spark: SparkSession, table: str, number: int, schema: str) -> DataFrame | None:
    """The rows of earlier runs, None where there are none; runs that are not done yet do not count."""
    if not exists(spark, f"{table}/{RUN}=*"):
        return None
    return spark.read.schema(f"{schema}, {RUN} long").parquet(table).where(F.col(RUN) < number)


def _run_numbered(stream: DataFrame, commit: Callable[[DataFrame, int], None], checkpoint: str, timeout: int | None) -> None:
    """Hand each micro-batch over with its number; a number that was not finished comes again, with the same rows."""
    _finished(stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(), timeout)


def run_with_ledger(stream: DataFrame, out: str, ledger: str, checkpoint: str, *,
                    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
                    done: Sequence[str] = ("batch_no", "url"), timeout: int | None = None) -> None:
    """``run_incremental`` that also keeps the ledger of what was processed.

    Rows and ledger of a micro-batch lie under its number and replace what a
    broken run has left there.  The ledger is taken from the written rows, so the
    two agree, and a run that ends between them repeats and loses nothing.
    Failures are processed too: give them a row with an ``error``.
    """

    def commit(batch: DataFrame, number: int) -> None:
        rows = transform(batch)
        rows.write.mode("overwrite").parquet(run_path(out, number))
        written = rows.sparkSession.read.schema(rows.schema).parquet(run_path(out, number))
        ledger_rows = written.where(F.col(done[-1]).isNotNull()).select(*done).distinct()
        ledger_rows.write.mode("overwrite").json(run_path(ledger, number))

    _run_numbered(stream, commit, checkpoint, timeout)


def first_in_batch(batch: DataFrame, earlier: DataFrame | None, *, key: str, order: Sequence[str]) -> DataFrame:
    """The rows of a stored micro-batch that bring a key first, in ``order``, and those without a key.

    ``earlier`` has the keys of earlier runs.  They are only scanned, against the
    keys of this batch; what the batch shares with them is no larger than the batch.
    """
    first = dedup_first_seen(batch, key=key, order=order)
    if earlier is None:
        return first
    keys = cut(batch.where(F.col(key).isNotNull()).select(F.col(key).alias("_key")).distinct())
    known = cut(earlier.select(F.col(key).alias("_key")).join(keys, "_key", "left_semi").distinct())
    return first.join(known, F.col(key) == F.col("_key"), "left_anti")


def run_first_seen(stream: DataFrame, out: str, checkpoint: str, *, key: str = "url",
                   order: Sequence[str] = ("batch_no", "file", "block", "pos"), timeout: int | None = None) -> None:
    """Everything new, one row per key over all runs: the first in reading order of the micro-batch that brings it.

    ``pos`` is added here, in the order of the files' splits.  The written rows
    are the state: a key is known if an earlier number has written it, so there is
    nothing to lose, and a broken run is written anew under its own number.  Rows
    without a key are all kept.  Where batches come in reading order, the table
    equals ``dedup_first_seen`` over all of them.
    """
    kind = stream.schema[key].dataType.simpleString()

    def commit(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with tidy(spark):
            rows = cut(batch.withColumn("pos", F.monotonically_increasing_id()))
            earlier = runs_before(spark, out, number, f"{key} {kind}")
            if earlier is not None:
                earlier = earlier.where(F.col(key).isNotNull())
            first_in_batch(rows, earlier, key=key, order=order).write.mode("overwrite").parquet(run_path(out, number))

    _run_numbered(stream, commit, checkpoint, timeout)


def stream_dedup(stream: DataFrame, *, key: str = "url", watermark: tuple[str, str] | None = None) -> DataFrame:
    """One row per key across runs, as a streaming operator; rows without a key all pass through.

    ``run_first_seen`` keeps the first row in reading order; here, of rows that come in one run any may be the one that is kept; a key seen in an
    earlier run brings none.  Without a watermark the state keeps every key seen.
    With ``(time column, delay)`` only repeats within the delay are removed and
    the state stays bounded: weaker, but fit for endless streams.
    """
    keyed = stream.where(F.col(key).isNotNull())
    if watermark:
        keyed = keyed.withWatermark(*watermark).dropDuplicatesWithinWatermark([key])
    else:
        keyed = keyed.dropDuplicates([key])
    return keyed.unionByName(stream.where(F.col(key).isNull()))


def with_url(stream: DataFrame, *, raw: str = "raw", compat: bool = False) -> DataFrame:
    """The URL of each record; NULL where it is missing, or the missing mark with ``compat``."""
    url = record_url(raw)
    return stream.withColumn("url", url if compat else F.nullif(url, F.lit(fv.MISSING)))
