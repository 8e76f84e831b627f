import random

import pytest
from pyspark.sql import functions as F

from pressline.operators import batches


def urls(spark, n, parts=7):
    return spark.range(0, n, 1, parts).select(F.concat(F.lit("https://news.example/"), F.xxhash64("id").cast("string")).alias("url"))


def test_reference_figures(spark):
    done = batches.assign_batches(urls(spark, 33363), size=1000)
    sizes = {r.batch_no: r.n for r in done.groupBy("batch_no").agg(F.count("*").alias("n")).collect()}
    assert len(sizes) == 34 and sizes[34] == 363 and all(sizes[b] == 1000 for b in range(1, 34))
    index = batches.batch_index(done, size=1000).first()
    assert (index.total_links, index.batch_size, index.total_batches) == (33363, 1000, 34)
    names = [r.file for r in batches.batch_list(done).collect()]
    assert names == [f"links_batch_{b}.json" for b in range(1, 35)]


def test_batches_follow_url_order(spark):
    done = batches.assign_batches(urls(spark, 5000), size=100).collect()
    in_order = sorted(r.url for r in done)
    place = {u: i for i, u in enumerate(in_order)}
    assert all(r.batch_no == place[r.url] // 100 + 1 for r in done)


def test_links_are_a_set(spark):
    twice = urls(spark, 50).unionByName(urls(spark, 50))
    assert batches.assign_batches(twice, size=10).count() == 50


def test_index_over_many_partitions(spark):
    # tiny partitions would be joined; keep them apart to cross their borders
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = batches.global_index(urls(spark, 1000), "url")
        assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 1
        rows = df.orderBy("url").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r.idx for r in rows] == list(range(1000))


def test_empty(spark):
    none = batches.assign_batches(urls(spark, 10).where("false"))
    assert none.count() == 0
    assert tuple(batches.batch_index(none).select("total_links", "total_batches").first()) == (0, 0)


@pytest.mark.parametrize("path, want", [
    ("/x/articles_batch_3/News_batch_1.txt", 3), ("/x/a.txt", 0), ("links_batch_12.json", 12), ("/batch_99999999999999/x", 0), ("/out/batch_no=7/part-0.txt", 7),
])
def test_batch_number_is_the_first_in_the_path(spark, path, want):
    assert spark.range(1).select(batches.batch_no_of(F.lit(path), 0)).first()[0] == want


def test_selection(spark):
    df = spark.createDataFrame([(b,) for b in (1, 2, 3, 4)], "batch_no int")
    pick = lambda spec: sorted(r.batch_no for r in batches.select_batches(df, spec).collect())
    assert pick("2-3") == [2, 3] and pick("1,9") == [1] and pick("4") == [4] and pick("3-99") == [3, 4]
    assert [r.batch_no for r in batches.quick_sample(df, n_links=50, link_size=20).collect()] == [1, 2, 3]


def test_selection_prunes_partitions(spark, tmp_path):
    df = spark.createDataFrame([(b, f"u{b}") for b in range(1, 9)], "batch_no int, url string")
    df.write.partitionBy("batch_no").parquet(str(tmp_path / "links"))
    plan = batches.select_batches(spark.read.parquet(str(tmp_path / "links")), "2-3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_no" in plan


def test_status_and_failures(spark):
    files = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "batch_no int, file string")
    progress = spark.createDataFrame([(1, "u"), (1, "u"), (3, "v")], "batch_no int, url string")
    assert {tuple(r) for r in batches.batch_status(files, progress).collect()} == {(1, 2, 1), (2, 1, 0), (3, 0, 1)}
    rows = spark.createDataFrame([(1, False), (1, True), (2, False)], "batch_no int, failed boolean")
    results = batches.batch_results(rows)
    assert [r.batch_no for r in batches.failed_batches(results).collect()] == [1]
    assert tuple(batches.batch_success_counts(results).first()) == (1, 1, 2)


def test_natural_order(spark):
    files = ["articles_batch_10/x_batch_1.txt", "articles_batch_2/x_batch_1.txt", "articles_batch_2/a_batch_1.txt", "none.txt"]
    random.Random(1).shuffle(files)
    df = batches.with_batch_no(spark.createDataFrame([(f,) for f in files], "file string"))
    assert [r.file for r in batches.order_batches(df).collect()] == [
        "none.txt", "articles_batch_2/a_batch_1.txt", "articles_batch_2/x_batch_1.txt", "articles_batch_10/x_batch_1.txt"]
