"""Helpers shared by the operators: inputs, held-out remainders, bounded samples, cut lineage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressline.session import cut

__all__ = ["broadcast_if", "cut", "driver_released", "held_out", "id_as_text", "id_as_was", "id_sample", "read", "released", "text_rows", "xxhash_unit"]


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def driver_released(spark: SparkSession) -> None:
    """Drop on the driver what finished jobs have left: their plans, broadcast tables and freed Python memory.

    Spark lets go of broadcasts and shuffle files when the driver's JVM collects its garbage, and a heap that
    grew during one job shrinks then; for work of many jobs, between them.
    """
    _give_back()
    spark._jvm.System.gc()


def released(run: Callable[[Iterator], Iterator], forget: Callable[[], None] = gc.collect) -> Callable[[Iterator], Iterator]:
    """A Python stage that ends a task with an empty hand: ``forget`` drops what its module holds, and freed memory is given back.

    Workers live on and serve the stages that follow, beside an executor that has grown meanwhile.
    """

    def stage(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            forget()
            _give_back()

    return stage


def text_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, so that no other column of the input can clash; null texts are empty."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def id_as_text(df: DataFrame) -> DataFrame:
    """Ids as text for a Python stage, where whole numbers beside nulls would become floats."""
    return df.withColumn("doc_id", F.col("doc_id").cast("string"))


def id_as_was(df: DataFrame, kind: str) -> DataFrame:
    return df.withColumn("doc_id", F.col("doc_id").cast(kind))


def held_out(id_col: str | Column, mod: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves this remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % mod == remainder


def xxhash_unit(*cols: str | Column) -> Column:
    """A number in [0, 1) that depends on the columns only."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / float(1 << 30)


def id_sample(rows: DataFrame, max_rows: int, *by: str) -> DataFrame:
    """At most ``max_rows`` rows (in each group of ``by``), chosen by a hash of the id.

    A count sets a threshold on the hash, so that few more rows than needed reach the sort.
    """
    counts = rows.groupBy(*by).count().collect()
    keep = F.lit(False)
    for row in counts:
        share = min(1.0, 1.2 * max_rows / row["count"] + 0.0) if row["count"] else 0.0
        hit = xxhash_unit("doc_id") < F.lit(share if share < 1 else 2.0)
        for name in by:
            hit &= F.col(name).eqNullSafe(F.lit(row[name]))
        keep |= hit
    kept = rows.where(keep)
    parts = [kept] if not by else [kept.where(F.col(by[0]).eqNullSafe(F.lit(r[0]))) for r in counts]
    out = None
    for part in parts:
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
        out = part if out is None else out.unionByName(part)
    return rows.limit(0) if out is None else out


def broadcast_if(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Broadcast a side whose counted rows are within the limit; else leave the join to the planner."""
    return F.broadcast(df) if rows <= limit else df
