import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressline.llm import hard_negatives
from pressline.llm.hard_negatives import ResidueMatrix, mine, primes

SCHEMA = "vec_id long, embedding array<double>, label int, score double, id string, v int"
OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, n_positives=5, n_negatives=3):
    part = [
        (i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, done = [], []
    for i, label, v in part:
        if i % 50 or (i, label, v) in done:
            continue
        done.append((i, label, v))
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in part if j != i)
        for p, j, _ in [x for x in scored if x[2] == label][:n_positives]:
            far = [x for x in scored if x[2] != label and 50 * -p <= 100 * -x[0] <= 95 * -p]
            out += [(i, j, k + 1, far[k][1], -p, -far[k][0]) for k in range(min(n_negatives, len(far)))]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, label, 0.5, "x", 1) for i, v, label in rows], SCHEMA)
    return sorted(tuple(r) for r in mine(df, anchors=F.col("vec_id") % 50 == 0, **options).select(*OUT).collect())


def vectors(rng, n, width, kinds):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    return [(i, [c + rng.gauss(0, 0.7) for c in rng.choice(centres)], rng.randrange(kinds)) for i in range(n)]


@pytest.mark.parametrize("width,top", [(1, 3), (64, 300), (64, 10**6), (700, 5000), (2500, 10**5)])
def test_residue_products_are_exact(width, top):
    rng = np.random.default_rng(width)
    a, b = rng.integers(-top, top + 1, (13, width)), rng.integers(-top, top + 1, (17, width))
    a[0], b[0] = top, -top
    moduli = primes(min(width, hard_negatives.DEPTH), width * top * top)
    assert all(((p - 1) // 2) ** 2 * min(width, hard_negatives.DEPTH) <= hard_negatives.EXACT for p in moduli)
    got = ResidueMatrix(a, moduli).scores(ResidueMatrix(b, moduli), slice(0, 13))
    assert got.tolist() == (a @ b.T).tolist()


def test_equals_brute_force_over_several_cells(spark, monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(hard_negatives, "CELL_ROWS", 40)
    monkeypatch.setattr(hard_negatives, "CELL_ANCHORS", 2)
    monkeypatch.setattr(hard_negatives, "SCORES", 64)
    rows = vectors(rng, 251, 6, 3)
    want = brute(rows)
    assert len(want) > 40 and run(spark, rows) == want


def test_nulls_ties_repeated_rows_and_lengths(spark):
    rng = random.Random(5)
    rows = vectors(rng, 120, 3, 2)
    rows += [(None, [1.0, 1.0, 1.0], 0), (200, None, 0), (201, [1.0, None, 0.0], 1), (202, [float("nan")], 1), (203, [float("inf"), 1.0], 0), (204, [1.0], None)]
    rows += [(300, [], 0), (301, [0.5], 1), (302, [0.5, 0.25, 1.0, 7.0], 0), (350, [0.5, 0.25, 1.0, 7.0], 1)]
    rows += [(400 + k, [1.0, 0.5, 0.25], k % 2) for k in range(12)]  # equal vectors: ties by id
    rows += [(400, [1.0, 0.5, 0.25], 0), (407, [1.0, 0.5, 0.25], 1), (400, [0.0, 1.0, 1.0], 1)]  # a repeated row, and an id of two vectors
    assert run(spark, rows) == brute(rows)


def test_one_vector_for_a_third_of_all_rows(spark):
    rng = random.Random(7)
    rows = vectors(rng, 200, 4, 3) + [(1000 + k, [1.0, 0.0, -1.0, 0.5], k % 3) for k in range(100)]
    assert run(spark, rows) == brute(rows)


def test_empty_and_without_anchors(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []


def test_scores_beyond_64_bits_are_refused(spark):
    with pytest.raises(ValueError, match="64 bits"):
        run(spark, [(50, [1e30], 0), (51, [1.0], 0)])
