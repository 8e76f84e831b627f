import random

from pyspark.sql import functions as F

from pressline.functions import urls as U
from pressline.functions.language import body_terms
from pressline.functions.terms import TermSearch, terms_in
from pressline.functions.text import contains_any, count_contained, let
from pressline.params import Blacklist, Lexicon

LEX = Lexicon()


def texts(seed, n=300):
    rng = random.Random(seed)
    parts = [*LEX.terms, *LEX.phrases, "x", "the\u00e9", "th", "e ", " ", "\n", "\u4e2d", "persona non", "grata"]
    return [None, "", *("".join(rng.choice(parts) + rng.choice(("", " ")) for _ in range(rng.randrange(40))) for _ in range(n))]


def test_counts_equal_one_search_a_term(spark):
    df = let(spark.createDataFrame([(t,) for t in texts(1)], "low string"), t=body_terms("low", LEX))
    chain = [count_contained("low", terms) for terms in (LEX.terms_b, LEX.phrases_b, LEX.phrases)]
    got = df.select("t.*", *[c.alias(f"c{k}") for k, c in enumerate(chain)], F.col("low").isNull().alias("gone")).collect()
    assert all((r[0], r[1], r[2]) == ((None,) * 3 if r.gone else (r.c0, r.c1, r.c2)) for r in got)
    assert max(r[0] or 0 for r in got) > 20 and any(r[1] for r in got)


def test_overlapping_empty_and_shared_terms():
    lists = (("a", ("he", "she", "hers", "he")), ("b", ("", "his")), ("c", ()))
    assert TermSearch(lists).counts(["ushers", "", None, "his"]) == [[3, 0, None, 0], [1, 1, None, 2], [0, 0, None, 0]]
    assert TermSearch(lists).counts([]) == [[], [], []]
    assert TermSearch((("none", ()),)).counts(["x", None]) == [[0, None]]


def test_reasons_equal_the_form_for_arrays(spark):
    bl = Blacklist(urls=("https://h/no",), title_starters=("the",), title_indicators=LEX.terms_b, terms=("persona non", "they", "x x"))
    rng = random.Random(2)
    rows = [("https://h/" + rng.choice(("no", "en/", "persona-non", "a/they/b", "ok")), t) for t in texts(3)]
    df = spark.createDataFrame(rows, "url string, title string")
    plain = U.blacklist_reason("url", F.lower("url"), F.lower("title"), bl)
    got = U.with_blacklist_reason(df, bl, title="title").withColumn("plain", plain).collect()
    assert all(r.blacklist_reason == r.plain for r in got)
    assert len({r.plain for r in got}) >= 5


def test_one_python_stage_for_all_lists(spark):
    df = spark.createDataFrame([("a",)], "low string")
    plan = let(df, t=terms_in("low", a=["x"], b=["y"])).where("t.a > 0 or t.b > 0").select("t.a", "t.b")
    assert plan._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert contains_any("low", ()) is not None
