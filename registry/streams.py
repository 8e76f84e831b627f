"""Incremental mode, run to completion and compared with the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressline.operators import records
from pressline.session import new_path
from pressline.sources import readers, sinks
from pressline.streaming import incremental
from registry.common import ARTICLES_SQL, query, sql_strip, with_articles
from registry.records import RAW_SQL, rendered


def run(spark, sf, label, transform):
    """Two runs on one checkpoint: the second sees only the files that came later."""
    src, out, ckpt = (new_path(spark, f"{label}-{k}") for k in ("src", "out", "ckpt"))
    late = F.col("batch_no") > 10
    for part in (~late, late):
        sinks.write_articles(rendered(spark, sf).where(part), src)
        incremental.run_incremental(
            incremental.stream_articles(spark, src, glob="*.txt"), out, ckpt, transform=transform
        )
    return spark.read.parquet(out)


@query("s1_run_incremental", with_articles(f"SELECT md5({sql_strip('raw')}) AS digest FROM (SELECT {RAW_SQL} AS raw FROM a) WHERE raw IS NOT NULL"))
def s1(spark, sf):
    return run(spark, sf, "s1", lambda df: df).select(F.md5(records.strip("raw")).alias("digest"))


def ordered_runs(spark, sf, label, process):
    """Archive files whose records stand in reading order, one file a batch, brought in two runs."""
    src = new_path(spark, f"{label}-src")
    whole = rendered(spark, sf).where("raw is not null").select("batch_no", "file", "pos", F.regexp_replace("raw", r"\n\z", "").alias("value"))
    late = F.col("batch_no") > 10
    for part in (~late, late):
        in_order = whole.where(part).repartition("batch_no").sortWithinPartitions("batch_no", "file", "pos")
        in_order.select("batch_no", "value").write.mode("append").partitionBy("batch_no").text(src)
        process(incremental.stream_articles(spark, src, glob="*.txt"))


@query("s1_run_with_ledger", f"""WITH a AS ({ARTICLES_SQL}), w AS (SELECT * FROM a WHERE title <> '')
SELECT batch_no, count(*) AS n_rows, count(DISTINCT url) AS n_done FROM w GROUP BY batch_no""")
def s1_ledger(spark, sf):
    out, ledger, ckpt = (new_path(spark, f"s1-{k}") for k in ("out", "ledger", "ckpt"))
    ordered_runs(spark, sf, "s1", lambda stream: incremental.run_with_ledger(stream, out, ledger, ckpt, transform=incremental.with_url))
    rows = spark.read.parquet(out).groupBy("batch_no").agg(F.count("*").alias("n_rows"))
    done = readers.read_progress(spark, ledger).groupBy("batch_no").agg(F.count("*").alias("n_done"))
    return rows.join(done, "batch_no", "left").select("batch_no", "n_rows", F.coalesce("n_done", F.lit(0)).alias("n_done"))


@query("s2_first_seen", f"""WITH a AS ({ARTICLES_SQL}),
k AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY batch_no, file, pos) AS rn, {RAW_SQL} AS raw FROM a WHERE title <> '')
SELECT batch_no, url, md5({sql_strip('raw')}) AS digest FROM k WHERE url IS NULL OR rn = 1""")
def s2_first(spark, sf):
    out, ckpt = (new_path(spark, f"s2-{k}") for k in ("out", "ckpt"))
    ordered_runs(spark, sf, "s2", lambda stream: incremental.run_first_seen(incremental.with_url(stream), out, ckpt))
    return spark.read.parquet(out).select("batch_no", "url", F.md5(records.strip("raw")).alias("digest"))


@query("s2_stream_dedup", f"""WITH a AS ({ARTICLES_SQL}) SELECT url FROM (
  SELECT DISTINCT url FROM a WHERE title <> '' AND url IS NOT NULL UNION ALL SELECT url FROM a WHERE title <> '' AND url IS NULL)""")
def s2(spark, sf):
    done = run(spark, sf, "s2", lambda df: incremental.stream_dedup(incremental.with_url(df)))
    return done.select("url")


