import random

import numpy as np

from pressline.llm import fm, langid, quality, toxicity


def test_scores_equal_all_pairs():
    rng = np.random.default_rng(0)
    model = fm.Model(0.3, rng.normal(size=1 << fm.BITS).astype(np.float32), rng.normal(0, 0.3, (1 << fm.BITS, fm.FACTORS)).astype(np.float32))
    i, x = np.array([3, 9, 70], np.int32), np.array([1.0, 0.5, 2.0], np.float32)
    z = 0.3 + float(model.w[i] @ x) + sum(float(model.v[i[a]] @ model.v[i[b]]) * x[a] * x[b] for a in range(3) for b in range(a))
    empty = (np.zeros(0, np.int32), np.zeros(0, np.float32))
    got = model.scores([empty, (i, x), empty])
    assert np.allclose(got, [1 / (1 + np.exp(-v)) for v in (0.3, z, 0.3)], atol=1e-5)


def test_words_that_only_matter_in_pairs(spark, docs):
    """An insult is harmless alone and so is the mention of a group; each word is as frequent under either label."""
    rng = random.Random(3)
    rows, labels = [], []
    for k in range(2400):
        insult, group = rng.choice(("zork", "blim")), rng.choice(("gnarl", "plov"))
        words = [insult, group, *(f"w{rng.randrange(400)}" for _ in range(rng.randrange(4, 25)))]
        rng.shuffle(words)
        rows.append((k, " ".join(words)))
        labels.append((k, int((insult == "zork") == (group == "gnarl"))))
    table = docs(*rows)
    known = spark.createDataFrame([x for x in labels if x[0] < 1800], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(table, toxicity.train(table, known)).collect()}
    right = [int(got[k] >= 0.5) == y for k, y in labels if k >= 1800]
    assert sum(right) > 0.95 * len(right)


def test_classifiers(spark, docs):
    clean = [(i, f"these are plain words number{i} of a calm text. It goes on for a while.") for i in range(60)]
    junk = [(100 + i, f"BUY!! NOW!! CLICK{i}!! $$$ ### %%% idiot") for i in range(60)]
    rows = [*clean, *junk, (200, None), (201, ""), (0, clean[0][1]), (None, "some text"), (300, "long text " * 50_000)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in clean[:40]] + [(i, 0, 1) for i, _ in junk[:40]] + [(300, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    df = docs(*rows)
    for module, good in ((quality, 1), (toxicity, 0)):
        model = module.train(df, labels)
        got = module.score(df, model).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        by_id = {r.doc_id: r.score >= 0.5 for r in got}
        assert all(by_id[i] == bool(good) for i, _ in clean) and all(by_id[i] != bool(good) for i, _ in junk)
        assert module.score(docs(), model).count() == 0
        none = module.train(df, labels.limit(0))
        assert {r.score for r in module.score(df, none).collect()} == {0.5}
    kept = quality.keep(df, quality.train(df, labels))
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {i for i, _ in clean}


def test_languages(spark):
    words = {"xx": ["lorem", "ipsum", "dolor", "amet"], "yy": ["grün", "schön", "straße", "über"], "zz": ["привет", "мир", "как", "дела"]}
    rng = np.random.default_rng(1)
    rows = [(n, " ".join(rng.choice(words[x], 12)), x) for n, x in enumerate(["xx", "yy", "zz"] * 30)]
    rows += [(900, None, "xx"), (901, "123 !!", "yy"), (902, "", None), (903, "grün", None), (None, "lorem ipsum", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(df, langid.train(df.where("doc_id % 5 <> 0 or doc_id is null"))).collect()}
    assert all(got[i][0] == x for i, _, x in rows[:90])
    assert got[900] == got[901] == got[902] == ("und", 0.0) and got[903][0] == "yy" and got[None][0] == "xx"
    assert langid.train(df.limit(0)) is None
    assert {r.lang_pred for r in langid.predict(df, None).collect()} == {"und"}
    assert langid.predict(df.limit(0), None).count() == 0
