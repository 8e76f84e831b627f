import random

import pytest
from pyspark.sql import functions as F

from pressline.functions import language as L
from pressline.operators import language as OP
from pressline.params import Lexicon

LEX = Lexicon()


def verdicts(spark, rows):
    df = spark.createDataFrame(rows, "id int, title string, content string")
    out = OP.language_verdict(df, metrics=True).orderBy("id").collect()
    return [(r.foreign_reason, r.n_words, r.n_hits, r.max_run) for r in out]


def filler(n, hits=(), word="the"):
    return " ".join(word if i in hits else f"rijec{i}" for i in range(n))


def test_empty_body_is_local_before_all_rules(spark):
    rows = [(0, "Trump and the law", "N/A"), (1, "Trump", ""), (2, "Trump", None), (3, "Trump", "nesto")]
    assert [v[0] for v in verdicts(spark, rows)] == [None, None, None, "title_keyword"]


def test_title_rules(spark):
    body = filler(30)
    rows = [
        (0, "jedan dva tri would", body),          # 4 words, 1 hit
        (1, "jedan dva tri cetiri would", body),   # 5 words, 1 hit
        (2, "a b c d e f g would could", body),    # 9 words, 2 hits
        (3, "would, could!", body),                # punctuation is not stripped in titles
        (4, "", body), (5, None, body),
    ]
    assert [v[0] for v in verdicts(spark, rows)] == ["title_tokens", None, "title_tokens", None, None, None]


def test_share_is_strict_and_count_has_a_floor(spark):
    spread = lambda n, k: filler(n, range(0, k * 2, 2))
    rows = [(0, "x", spread(100, 8)), (1, "x", spread(100, 9)), (2, "x", filler(1000, range(0, 28, 2))),
            (3, "x", filler(1000, range(0, 30, 2)))]
    assert [v[0] for v in verdicts(spark, rows)] == [None, "token_share", None, "token_hits"]


def test_longest_run_sees_through_punctuation(spark):
    pad = " ".join(f"r{i}" for i in range(60))
    rows = [(0, "x", f"the, (that) {pad} \"this\" these"), (1, "x", f"{pad} \"the\" (that), this: {pad}")]
    got = verdicts(spark, rows)
    assert [(v[0], v[3]) for v in got] == [(None, 2), ("consecutive", 3)]


def test_phrases(spark):
    pad = filler(50)
    rows = [(0, "x", pad + " new york city " + pad), (1, "x", pad + " nella terra di " + pad), (2, "x", pad + " IL CASO DI " + pad)]
    assert [v[0] for v in verdicts(spark, rows)] == ["strong_phrase", "phrase_ab", "phrase_ab"]


def test_mid_sample(spark):
    df = spark.createDataFrame(
        [(0, filler(100, range(50, 60))), (1, filler(101, [50, 60, 70, 80, 90])), (2, filler(101, [0, 10, 20, 30, 40]))],
        "id int, content string",
    )
    got = OP.mid_sample_verdict(OP.language_verdict(df, title=None)).orderBy("id").collect()
    # 100 words are not sampled; 5 hits of 101 are local as a whole but 5 of 50 are not
    assert [r.mid_foreign for r in got] == [False, True, False]
    assert not got[1].is_foreign


def test_unicode_white_space_splits_words(spark):
    got = verdicts(spark, [(0, "x", "the that this　kraj\x1fkraj")])
    assert got[0][1:] == (5, 3, 3)


@pytest.mark.parametrize("seed", range(3))
def test_run_three_ways(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, " ".join(rnd.choice(["the,", "(that)", "x", "y—", "this"]) for _ in range(rnd.randrange(0, 40)))) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, content string")
    mask = OP.with_tokens(df).select("id", L.mask_max_run("hit_mask").alias("a"), L.max_run_folded("content", LEX).alias("b"))
    both = mask.join(OP.max_run_islands(df, "id"), "id").collect()
    assert len(both) == 50
    for r in both:
        runs, best = 0, 0
        for w in rows[r.id][1].lower().split():
            runs = runs + 1 if w.strip(LEX.strip_chars) in LEX.terms else 0
            best = max(best, runs)
        assert r.a == r.b == r.max_run == best


def test_sides_add_up(spark):
    rows = [(i, "x", filler(20, range(0, i % 7))) for i in range(70)]
    df = spark.createDataFrame(rows, "id int, title string, content string")
    sides = {r.lang_side: r.n for r in OP.split_sides(OP.language_verdict(df)).groupBy("lang_side").agg(F.count("*").alias("n")).collect()}
    assert sum(sides.values()) == 70 and set(sides) == {"local", "foreign"}


def test_filter_on_verdict_tokenises_once(spark):
    df = spark.createDataFrame([(1, "a", "b")], "id int, title string, content string")
    plan = OP.language_verdict(df).where(~F.col("is_foreign"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("array_join(transform(") == 1
