"""First-seen de-duplication by URL and the counts around it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressline import fixed_values as fv
from pressline.session import cut

ORDER = ("batch_no", "file", "pos")


def first_rows(df: DataFrame, *, key: str = "url", order: Sequence[str] = ORDER) -> DataFrame:
    """``dedup_first_seen`` for narrow rows that are costly to compute, in one aggregation over them.

    Every task keeps only its own first row of a key before the shuffle, so a
    key that holds a large part of the table arrives as one row per task.  Rows
    without a key are spread by their order columns, which must identify a row.
    """
    rank = F.struct(*order)
    lone = F.when(F.col(key).isNull(), rank)
    first = df.groupBy(F.col(key).alias("_key"), lone.alias("_lone")).agg(F.min_by(F.struct(*df.columns), rank).alias("_row"))
    return first.select("_row.*")


def later_copies(df: DataFrame, *, key: str = "url", order: Sequence[str] = ORDER) -> DataFrame:
    """The order columns of the rows whose key occurs earlier; rows without a key are never among them.

    Only the key and the order columns are read.  Keys that occur once end in the
    aggregation; what is left meets the rows again in a join that adaptive
    execution splits where one key holds a large part of them.
    """
    rows = df.where(F.col(key).isNotNull()).select(key, *order)
    rank = F.struct(*order)
    first = rows.groupBy(key).agg(F.min(rank).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    return rows.join(first, key).where(rank > F.col("_first")).select(*order)


def without(df: DataFrame, dropped: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """The rows whose order columns are not among ``dropped``.

    ``dropped`` is written first, so that its measured size decides the join: as
    long as it can be broadcast, the rows are neither shuffled nor sorted.
    """
    positions = cut(dropped.select(*[F.col(c).alias(f"_{c}") for c in order]))
    return df.join(positions, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in order]), "left_anti")


def dedup_first_seen(df: DataFrame, *, key: str = "url", order: Sequence[str] = ORDER,
                     enabled: bool = True) -> DataFrame:
    """Keep the first row per key in ``order``; rows without a key are all kept.

    The order columns must identify a row, and be the same each time the input is
    read.  Rows to drop are found among the key and order columns alone, so texts
    stay where they are.
    """
    return without(df, later_copies(df, key=key, order=order), order) if enabled else df


def batch_dup_counts(df: DataFrame, *, key: str = "url", batch: str = "batch_no") -> DataFrame:
    """Per batch: articles added and duplicates skipped.

    One scan gives counts per (key, batch), which are written; all else works on
    that narrow table.  A key is added in its lowest batch, and rows without a
    key all are.
    """
    per_key = cut(df.groupBy(F.col(key).alias("key"), F.col(batch).alias("batch")).agg(F.count("*").alias("n")))
    firsts = per_key.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("batch").alias("batch")).select(
        "batch", F.lit(0).cast("long").alias("n"), F.lit(1).cast("long").alias("added"))
    every = per_key.select("batch", "n", F.when(F.col("key").isNull(), F.col("n")).otherwise(0).alias("added"))
    return every.unionByName(firsts).groupBy(F.col("batch").alias(batch)).agg(
        F.sum("added").alias("added"), (F.sum("n") - F.sum("added")).alias("duplicates"))


def combine_totals(df: DataFrame, *, key: str = "url", file: str = "file", deduplicate: bool = True) -> DataFrame:
    """One row: input files, total, unique and duplicate articles, in one scan."""
    total = F.count("*")
    unique = F.count_distinct(key) + F.count_if(F.col(key).isNull()) if deduplicate else total
    return df.agg(
        F.count_distinct(file).alias("input_files"), total.alias("total_articles"), unique.alias("unique_articles")
    ).withColumn("duplicate_articles", F.col("total_articles") - F.col("unique_articles"))


def success_rate(unique: Column | str, total: Column | str) -> Column:
    """Percentage of unique articles, two decimals, 0 for an empty input."""
    u, t = (F.col(c) if isinstance(c, str) else c for c in (unique, total))
    return F.round(F.coalesce(F.try_divide(u * 100.0, t), F.lit(0.0)), 2)


def combine_summary(totals: DataFrame, output_file: str, timestamp: Column) -> DataFrame:
    """The summary row written next to a combined archive."""
    return totals.select(
        F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "input_files", "total_articles", "unique_articles", "duplicate_articles",
        F.lit(output_file).alias("output_file"),
    )


def report_rows(summary: DataFrame, *, name: str, generated: Column) -> DataFrame:
    """Human-readable report of a summary: one row per line, with its number."""
    rate = success_rate("unique_articles", "total_articles")
    text = F.format_string(
        "\n".join(fv.REPORT_LINES).replace("{NAME}", name.upper()).replace("{name}", name),
        F.date_format(generated, "yyyy-MM-dd HH:mm:ss"),
        "input_files", "total_articles", "unique_articles", "duplicate_articles",
        "output_file", "unique_articles", "total_articles", rate,
    )
    return summary.select(F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def filter_rollup(judged: DataFrame, *, directory: str = "batch_dir", file: str = "file") -> DataFrame:
    """Local and foreign counts per file, per directory and in total.

    ``level`` is 'file', 'dir' or 'all'; the total row also has the number of
    directories.
    """
    counted = judged.groupBy(directory, file).agg(
        F.count_if(~F.col("is_foreign")).alias("n_local"),
        F.count_if("is_foreign").alias("n_foreign"),
    )
    rolled = counted.rollup(directory, file).agg(
        F.sum("n_local").alias("local_articles"),
        F.sum("n_foreign").alias("foreign_articles"),
        F.count_distinct(directory).alias("_dirs"),
        F.grouping_id().alias("_g"),
    )
    level = F.when(F.col("_g") == 0, "file").when(F.col("_g") == 1, "dir").otherwise("all")
    return rolled.select(
        level.alias("level"), directory, file,
        (F.col("local_articles") + F.col("foreign_articles")).alias("total_processed"),
        "local_articles", "foreign_articles",
        F.when(F.col("_g") == 3, F.col("_dirs")).alias("batch_dirs_processed"),
    )


def filter_summary(judged: DataFrame, *, directory: str = "batch_dir", file: str = "file") -> DataFrame:
    """The total row of ``filter_rollup`` as the summary that is written."""
    return filter_rollup(judged, directory=directory, file=file).where("level = 'all'").select(
        "total_processed", "local_articles", "foreign_articles", "batch_dirs_processed"
    )


