"""Fixed-size link batches and what is known about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressline.functions.text import col
from pressline.session import cut

# a batch in a file or folder name, also as the partition folder our sinks write
BATCH_IN_PATH = r"batch_(?:no=)?(\d+)"


def batch_no_of(path: Column | str, default: int = 0) -> Column:
    """First batch number in a path, ``default`` where there is none."""
    return F.coalesce(F.regexp_extract(col(path), BATCH_IN_PATH, 1).try_cast("int"), F.lit(default))


def with_batch_no(df: DataFrame, *, path: str = "file", default: int = 0) -> DataFrame:
    return df.withColumn("batch_no", batch_no_of(path, default))


def global_index(df: DataFrame, key: str) -> DataFrame:
    """Add ``idx``: 0-based position in the order of a unique key.

    Range partitions are sorted on their own and written once; the row numbers
    inside each partition are then shifted by the sizes of the partitions before
    it.  Only one count per partition is ever gathered.
    """
    ranged = df.repartitionByRange(key).sortWithinPartitions(key)
    # the id is (partition << 33) + row number in the partition
    numbered = cut(ranged.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_offset"))
    # one row per partition: bounded by the number of partitions
    joined = numbered.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    in_part = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.withColumn("idx", F.col("_offset") + in_part).drop("_id", "_part", "_offset")


def assign_batches(links: DataFrame, *, size: int = 1000) -> DataFrame:
    """``(batch_no, url)``: the set of links in URL order, ``size`` per batch."""
    indexed = global_index(links.select("url").distinct(), "url")
    return indexed.select((F.floor(F.col("idx") / size) + 1).cast("int").alias("batch_no"), "url")


def batch_index(batches: DataFrame, *, size: int = 1000) -> DataFrame:
    """One row: total links, batch size, number of batches."""
    per_batch = batches.groupBy("batch_no").agg(F.count("*").alias("n"))
    return per_batch.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_links"),
        F.lit(size).cast("bigint").alias("batch_size"),
        F.count("*").alias("total_batches"),
    )


def batch_list(batches: DataFrame, *, prefix: str = "links_batch_") -> DataFrame:
    """The ordered batch list of the index, as rows: (batch_no, file, n_links).

    Rows instead of one array, because the list grows with the links.
    """
    counts = batches.groupBy("batch_no").agg(F.count("*").alias("n_links"))
    name = F.concat(F.lit(prefix), F.col("batch_no").cast("string"), F.lit(".json"))
    return counts.select("batch_no", name.alias("file"), "n_links").orderBy("batch_no")


def batch_status(files: DataFrame, progress: DataFrame) -> DataFrame:
    """Per batch: output files and processed URLs; batches known to either side."""
    n_files = files.groupBy("batch_no").agg(F.count_distinct("file").alias("output_files"))
    n_urls = progress.distinct().groupBy("batch_no").agg(F.count("*").alias("processed_urls"))
    return n_files.join(n_urls, "batch_no", "full_outer").select(
        "batch_no",
        F.coalesce("output_files", F.lit(0)).cast("bigint").alias("output_files"),
        F.coalesce("processed_urls", F.lit(0)).cast("bigint").alias("processed_urls"),
    )


def batch_results(rows: DataFrame, *, batch: str = "batch_no", failed: str = "failed") -> DataFrame:
    """A batch succeeds if none of its rows failed: (batch, success)."""
    return rows.groupBy(batch).agg((~F.bool_or(failed)).alias("success"))


def failed_batches(results: DataFrame, *, batch: str = "batch_no") -> DataFrame:
    """The batches to run again."""
    return results.where(~F.col("success")).select(batch)


def batch_success_counts(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if("success").alias("successes"), F.count_if(~F.col("success")).alias("failures"),
        F.count("*").alias("total_batches"),
    )


def order_batches(df: DataFrame, *, file: str = "file") -> DataFrame:
    """Natural order: batch number, then path."""
    return df.orderBy("batch_no", file)


def _selected(spec: str) -> tuple[str, list[int]]:
    if "-" in spec:
        return "range", [int(x) for x in spec.split("-")]
    return "list", [int(x) for x in spec.split(",")]


def select_batches(df: DataFrame, spec: str) -> DataFrame:
    """Batches ``a-b``, ``a,b,c`` or ``n``; numbers that do not exist drop out.

    A plain predicate on ``batch_no``, so tables partitioned by it are pruned.
    """
    kind, numbers = _selected(spec)
    b = F.col("batch_no")
    return df.where(b.between(*numbers) if kind == "range" else b.isin(*numbers))


def quick_sample(df: DataFrame, *, n_links: int = 50, link_size: int = 20) -> DataFrame:
    """The first ``n_links // link_size + 1`` batches: a sampling operator."""
    return df.where(F.col("batch_no") <= n_links // link_size + 1)
