import random

import pytest
from pyspark.sql import functions as F

from pressline.operators import stats


def walk(spark, counts, **options):
    df = spark.createDataFrame([("l", i + 1, c) for i, c in enumerate(counts)], "listing string, page int, n_links int")
    return sorted(r.page for r in stats.pages_until_empty(df, **options).collect())


def test_walk_stops_at_second_empty_page(spark):
    assert walk(spark, [5, 0, 3, 0, 0, 9], k=2) == [1, 2, 3, 4, 5]
    assert walk(spark, [5, 0, 3, 0, 0, 9], k=3) == [1, 2, 3, 4, 5, 6]
    assert walk(spark, [0, 0, 0], k=2) == [1, 2]
    assert walk(spark, [1, 1, 1], k=2, max_page=2) == [1, 2]
    assert walk(spark, [0, 5, 5], k=2, first_must_have_links=True) == [1]


@pytest.mark.parametrize("k", [1, 2, 3])
def test_walk_against_a_loop(spark, k):
    rnd = random.Random(k)
    lists = {f"l{i}": [rnd.choice([0, 0, 1]) for _ in range(rnd.randrange(1, 12))] for i in range(40)}
    rows = [(n, i + 1, c) for n, cs in lists.items() for i, c in enumerate(cs)]
    df = spark.createDataFrame(rows, "listing string, page int, n_links int")
    got = {(r.listing, r.page) for r in stats.pages_until_empty(df, k=k).collect()}
    want = set()
    for name, counts in lists.items():
        empty = 0
        for i, c in enumerate(counts):
            want.add((name, i + 1))
            empty = empty + 1 if c == 0 else 0
            if empty == k:
                break
    assert got == want


def test_no_listing_is_sorted_in_one_task(spark):
    df = spark.createDataFrame([("l", 1, 0)], "listing string, page int, n_links int")
    plan = stats.pages_until_empty(df)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.split("\n") if "Window" in x and "listing" in x]


def test_walk_over_gaps(spark):
    rows = [("a", 2, 0), ("a", 4, 0), ("a", 5, 7), ("b", 1, 3), ("b", 9, 0), ("b", 11, 4), ("b", 12, 0), ("b", 15, 0), ("b", 16, 1), ("c", 7, 0), ("c", 8, 1)]
    df = spark.createDataFrame(rows, "listing string, page int, n_links int")
    visited = lambda **o: sorted((r.listing, r.page) for r in stats.pages_until_empty(df, **o).collect())
    # page 3 is absent: pages 2 and 4 are empty one after the other
    assert visited(k=2) == [("a", 2), ("a", 4), ("b", 1), ("b", 9), ("b", 11), ("b", 12), ("b", 15), ("c", 7), ("c", 8)]
    assert visited(k=2, first_must_have_links=True) == [("a", 2), ("b", 1), ("b", 9), ("b", 11), ("b", 12), ("b", 15), ("c", 7)]
    assert visited(k=2, max_page=12) == [("a", 2), ("a", 4), ("b", 1), ("b", 9), ("b", 11), ("b", 12), ("c", 7), ("c", 8)]
    assert stats.pages_until_empty(df.where("false")).count() == 0


def test_set_growth(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "c"), (3, "a")], "page int, url string")
    assert {tuple(r) for r in stats.new_links_per_page(df).collect()} == {(1, 2), (2, 0), (3, 1)}


def test_fetch_outcomes(spark):
    log = {"gone": [404, 200], "ok": [503, 200, 404], "failed": [403] * 7, "late": [500, 500, 500, 500, 500, 200], "null": [None, None]}
    rows = [(u, i + 1, s) for u, statuses in log.items() for i, s in enumerate(statuses)]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "url string, attempt int, status int")
    got = {r.url: (r.outcome, r.attempts) for r in stats.fetch_outcome(df, max_attempts=5).collect()}
    assert got == {"gone": ("gone", 1), "ok": ("ok", 2), "failed": ("failed", 5), "late": ("failed", 5), "null": ("failed", 2)}


def test_collector_stats(spark):
    rows = [("p1", "u1", None, True), ("p2", "u1", None, True), ("p1", "c", "category", False), ("p2", "c", "category", False), ("p1", "t", "tag", False)]
    links = spark.createDataFrame(rows, "page_url string, url string, kind string, is_article boolean")
    fetches = spark.createDataFrame([("p1", "ok"), ("p2", "ok"), ("x", "gone"), ("y", "failed")], "url string, outcome string")
    assert stats.collector_stats(links, fetches).first().asDict() == {
        "pages_visited": 2, "links_found": 2, "unique_links": 1, "categories": 1, "tags": 1, "authors": 0, "errors": 1, "failed_urls": 2}
    assert stats.collector_stats(links.where("false"), fetches.where("false")).first().pages_visited == 0


def test_extraction_stats(spark):
    rows = [("b", None), (None, "No content extracted"), (None, "Timeout: x: y"), (None, "Timeout: z")]
    df = spark.createDataFrame(rows, "content string, error string")
    assert tuple(stats.extraction_stats(df).first()) == (4, 1, 3, 1)
    assert {tuple(r) for r in stats.error_histogram(df).collect()} == {("No content extracted", 1), ("Timeout", 2)}


def test_tallies_summary_marks(spark):
    df = spark.createDataFrame([(1, None), (1, "language"), (2, None)], "batch_no int, reject_reason string")
    assert {tuple(r) for r in stats.batch_tallies(df).collect()} == {(1, 2, 1, 1), (2, 1, 1, 0)}
    ts = spark.sql("select timestamp'2024-01-01 00:00:00' ts, 1 n union all select timestamp'2024-01-01 00:01:30', 2")
    row = stats.run_summary(ts, links=F.sum("n"), articles=F.count("*")).first()
    assert (row.start_time, row.duration_seconds, row.total_links_found, row.status) == ("2024-01-01T00:00:00", 90.0, 3, "Complete")
    marks = stats.progress_marks(spark.range(0, 95, 1, 5).withColumnRenamed("id", "url"), key="url", every=20)
    assert {tuple(r) for r in marks.collect()} == {(19, 20), (39, 40), (59, 60), (79, 80)}
