import random
from collections import deque

import pytest

from pressline.operators.graph import reachable


def run(spark, edges, seeds, **options):
    e = spark.createDataFrame(edges, "src string, dst string")
    s = spark.createDataFrame(seeds, "url string, depth int")
    return {(r.url, r.depth) for r in reachable(e, s, **options).collect()}


CYCLE = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "d"), ("a", "b")]


def test_cycle(spark):
    assert run(spark, CYCLE, [("a", 0)], max_depth=1) == {("a", 0), ("b", 1)}
    assert run(spark, CYCLE, [("a", 0)], max_depth=9) == {("a", 0), ("b", 1), ("c", 2)}


def test_seed_depths(spark):
    assert run(spark, CYCLE, [("a", 0), ("c", 1), ("x", 2)], max_depth=3) == {("a", 0), ("b", 1), ("c", 1), ("x", 2)}
    assert run(spark, CYCLE, [("a", 5)], max_depth=3) == set()


def test_pages_without_content_are_not_expanded(spark):
    fetched = spark.createDataFrame([("a",), ("c",)], "url string")
    assert run(spark, CYCLE, [("a", 0)], max_depth=5, fetched=fetched) == {("a", 0)}


def test_cap_counts_in_depth_order(spark):
    star = [("a", f"n{i}") for i in range(9)]
    assert run(spark, star, [("a", 0)], max_depth=5, cap=4) == {("a", 0), ("n0", 1), ("n1", 1), ("n2", 1)}


@pytest.mark.parametrize("seed", range(2))
def test_against_breadth_first_search(spark, seed):
    rnd = random.Random(seed)
    edges = [(f"n{rnd.randrange(60)}", f"n{rnd.randrange(60)}") for _ in range(90)] + [("n0", f"n{i}") for i in range(20)]
    dist, queue = {"n0": 0}, deque(["n0"])
    while queue:
        u = queue.popleft()
        for s, d in edges:
            if s == u and d not in dist and dist[u] < 3:
                dist[d] = dist[u] + 1
                queue.append(d)
    assert run(spark, edges, [("n0", 0)], max_depth=3) == set(dist.items())


def test_nothing_is_left_behind_and_reads_are_constant(spark):
    import os

    from pressline.operators.graph import Visited
    from pressline.session import shared_dir

    folder = shared_dir(spark).removeprefix("file:")
    before, tables = set(os.listdir(folder)), {t.name for t in spark.catalog.listTables()}
    chain = [(f"n{i}", f"n{i + 1}") for i in range(9)]
    assert run(spark, chain, [("n0", 0), (None, 0)], max_depth=20, cap=7) == {(f"n{i}", i) for i in range(7)}
    assert [x.split("-")[0] for x in sorted(set(os.listdir(folder)) - before)] == ["walk"]
    assert {t.name for t in spark.catalog.listTables()} == tables
    # after several levels the table is one scan in buckets, which the anti join takes as it comes
    visited = Visited(spark.createDataFrame([], "url string"))
    for depth in range(4):
        assert visited.append(spark.createDataFrame([(f"n{depth}",), (f"m{depth}",)], "url string"), depth) == 2
    new = spark.range(3000).selectExpr("concat('n', id) as url").distinct()
    out = new.join(visited.table().select("url").hint("merge"), "url", "left_anti")
    assert out.count() == 2996
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") <= 2 and "Bucketed: true" in plan
    visited.close()
