"""Session settings the jobs rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import posixpath
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # pages are large rows: small Arrow batches bound the Python workers' memory
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="pressline-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a written table below the shared folder."""
    return posixpath.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


#: paths written since the innermost ``tidy`` began
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what ``cut`` writes inside; for work whose result is written before that."""
    token = _written.set([])
    try:
        yield
    finally:
        remove(spark, *_written.get())
        _written.reset(token)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written copy.

    A table keeps its size and its columns known to the planner, which a
    checkpointed row set does not.
    """
    spark = df.sparkSession
    path = new_path(spark, "cut")
    if (written := _written.get()) is not None:
        written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _path_of(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether any file matches the path or pattern."""
    at, fs = _path_of(spark, path)
    found = fs.globStatus(at)
    return found is not None and len(found) > 0


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete tables that this job has written for itself."""
    for path in paths:
        at, fs = _path_of(spark, path)
        fs.delete(at, True)
