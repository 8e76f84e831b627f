from pyspark.sql import functions as F

from pressline.operators import dedup
from pressline.plans.articles import combine

SCHEMA = "batch_no int, file string, pos long, url string, body string"
ROWS = [
    (10, "f10", 0, "https://a", "late"), (2, "f2", 5, "https://a", "early"),
    (2, "f2", 6, None, "n1"), (10, "f10", 1, None, "n2"), (2, "f2", 1, "https://b", "b"),
]


def test_first_seen_and_keyless(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {r.body for r in dedup.dedup_first_seen(df).collect()}
    assert got == {"early", "n1", "n2", "b"}
    again = dedup.dedup_first_seen(dedup.dedup_first_seen(df))
    assert {r.body for r in again.collect()} == got
    assert dedup.dedup_first_seen(df, enabled=False).count() == 5


def test_counts_and_totals(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert {tuple(r) for r in dedup.batch_dup_counts(df).collect()} == {(2, 3, 0), (10, 1, 1)}
    t = dedup.combine_totals(df).first()
    assert tuple(t) == (2, 5, 4, 1)
    assert t.total_articles == t.unique_articles + t.duplicate_articles
    off = dedup.combine_totals(df, deduplicate=False).first()
    assert tuple(off) == (2, 5, 5, 0)
    assert tuple(dedup.combine_totals(df.where("false")).first()) == (0, 0, 0, 0)


def test_success_rate_of_nothing(spark):
    row = spark.range(1).select(dedup.success_rate(F.lit(0), F.lit(0)), dedup.success_rate(F.lit(1), F.lit(3))).first()
    assert tuple(row) == (0.0, 33.33)


def test_report(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    summary = dedup.combine_summary(dedup.combine_totals(df), "all.txt", F.current_timestamp())
    lines = [r.line for r in dedup.report_rows(summary, name="Press", generated=F.current_timestamp()).orderBy("line_no").collect()]
    assert lines[0] == "=== PRESS REPORT ===" and "- Success rate: 80.00%" in lines
    assert "- Articles successfully processed: 4 / 5" in lines


def hot_rows(spark, n=20000):
    return spark.range(0, n, 1, 8).select(
        F.lit(1).alias("batch_no"), F.lit("f").alias("file"), F.col("id").alias("pos"),
        F.when(F.col("id") % 3 == 0, "https://hot").when(F.col("id") % 3 == 1, F.concat(F.lit("https://"), F.col("id").cast("string"))).alias("url"),
        F.repeat(F.lit("text "), 20).alias("body"),
    )


def steps(df):
    """(operator, what it reads) of a formatted plan."""
    import re

    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [(name, tail) for name, tail in re.findall(r"\n\(\d+\) ([A-Za-z]+)[^\n]*\n(.*?)(?=\n\n|\Z)", text, re.S)]


def test_hot_key(spark):
    out = dedup.dedup_first_seen(hot_rows(spark))
    assert out.where("url = 'https://hot'").first().pos == 0
    assert out.where("url is null").count() == 20000 // 3
    narrow = hot_rows(spark).drop("body")
    assert dedup.first_rows(narrow).exceptAll(out.drop("body")).isEmpty() and out.count() == dedup.first_rows(narrow).count()
    plan = dedup.first_rows(narrow)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan and plan.count("Exchange") == 1


def test_texts_are_neither_sorted_nor_shuffled(spark, tmp_path):
    hot_rows(spark).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    moving = [tail for name, tail in steps(dedup.dedup_first_seen(stored)) if "Exchange" in name or "Sort" in name]
    assert moving and not any("body" in tail for tail in moving)
    reads = [tail for name, tail in steps(dedup.later_copies(stored)) if name == "Scan"]
    assert reads and not any("body" in tail for tail in reads)


def test_equal_order_columns_in_other_batches(spark):
    rows = [(b, f, p, u, f"{b}{f}{p}") for b in (1, 2) for f in ("f", None) for p in (0, 1) for u in ("https://a",)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [r.body for r in dedup.dedup_first_seen(df).collect()] == ["1None0"]  # no file comes before all files
    assert dedup.dedup_first_seen(df.where("false")).count() == 0


def test_rollup_levels(spark):
    rows = [("d1", "f1", True), ("d1", "f1", False), ("d1", "f2", False), ("d2", "f1", False)]
    df = spark.createDataFrame(rows, "batch_dir string, file string, is_foreign boolean")
    got = {(r.level, r.batch_dir, r.file): (r.total_processed, r.local_articles, r.foreign_articles, r.batch_dirs_processed)
           for r in dedup.filter_rollup(df).collect()}
    assert got[("all", None, None)] == (4, 3, 1, 2)
    assert got[("dir", "d1", None)] == (3, 2, 1, None) and got[("file", "d1", "f1")] == (2, 1, 1, None)
    assert tuple(dedup.filter_summary(df).first()) == (4, 3, 1, 2)


def test_combine_filters_then_keeps_first(spark):
    def raw(url, body):
        return f"<***>\nNASLOV: Jedan dva tri cetiri pet\nSTRANA: {url}\nAUTOR(I): A\n\n{body}\n\n"

    rows = [(3, "f", 0, raw("https://a", "domaci tekst treci")), (1, "f", 0, raw("https://a", "the that this these")),
            (2, "f", 0, raw("https://a", "domaci tekst drugi"))]
    got = combine(spark.createDataFrame(rows, "batch_no int, file string, pos long, raw string")).collect()
    # the foreign copy of batch 1 is gone before copies are compared
    assert [(r.batch_no, r.url) for r in got] == [(2, "https://a")]


def test_combine_without_urls_and_cleaning(spark):
    raw = "<***>\nNASLOV: Jedan\nSTRANA: N/A\nAUTOR(I): A\n\ndomaci  tekst , ovdje\n\n\n\n"
    df = spark.createDataFrame([(b, "f", 0, raw) for b in (1, 2)], "batch_no int, file string, pos long, raw string")
    assert combine(df).count() == 2
    assert [r.batch_no for r in combine(df, compat=True).collect()] == [1]
    assert combine(df, clean=True).first().raw.endswith("domaci  tekst, ovdje\n\n")
