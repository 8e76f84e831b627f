import hashlib
import random

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _id string"


def written(spark, folder, rows, labels, items):
    full = [(i, t, "en", "s", len(t) if t is not None else None, 0.5, "x") for i, t in rows]
    spark.createDataFrame(full, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def sentence(rng, n):
    return " ".join(rng.choice(("alpha", "beta", "gamma", "delta")) + str(rng.randrange(4000)) for _ in range(n))


def test_all_stages_on_awkward_rows(spark, tmp_path):
    rng = random.Random(1)
    good = [sentence(rng, 40) + "." for _ in range(60)]
    junk = ["$$$ ### " * 30 + f"{k} %%%" for k in range(60)]
    item = " ".join(f"bench{k}" for k in range(20))
    rows = [(k, t) for k, t in enumerate(good)] + [(1000 + k, t) for k, t in enumerate(junk)]
    labels = [(i, int(i < 1000), 0) for i, _ in rows] + [(None, 1, 0), (5, None, None)]
    extra = [
        (None, good[3]), (None, sentence(rng, 30)), (None, sentence(rng, 30)),  # a copy without id, and two others without
        (7, good[7]), (7, sentence(rng, 25)),  # a repeated row, and another text under its id
        (200, good[9] + " one more word"),  # a near copy
        (201, sentence(rng, 15) + " " + item + " " + sentence(rng, 15)),  # a benchmark passage
        (202, sentence(rng, 45) + " mail me at anna.smith@example.com now."),
        (203, sentence(rng, 6000)),  # long
    ]
    written(spark, str(tmp_path), rows + extra + [(300, ""), (301, None)], labels, [(1, item), (2, None), (3, "")])
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        docs = corpus_pipeline.cut(out)
        kept.append([(r.doc_id, r.text) for r in docs.collect()])
    quality, near, clean, masked = kept
    texts = [t for _, t in quality]
    assert not set(junk) & set(texts) and set(good) <= set(texts)
    # near copies: one of each group; nothing else goes, without id or with a repeated one
    known = [x for x in near if x[1]]
    assert sorted(t for _, t in known) == sorted({t for t in texts if t} - {good[9] + " one more word"})
    assert sum(i is None for i, _ in known) == 2 and (3, good[3]) in known and (7, good[7]) in known
    assert {i for i, _ in near} - {i for i, _ in clean} == {201}
    assert [t for i, t in masked if i == 202][0].endswith(" mail me at <email> now.")
    assert sorted((i, t) for i, t in masked if i not in (None, 202)) == sorted((i, t) for i, t in clean if i not in (None, 202))

    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lib.no_truncation()
    want = []
    for i, t in masked:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_tables(spark, tmp_path):
    written(spark, str(tmp_path), [], [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    written(spark, str(tmp_path / "b"), [(1, "a few words"), (2, None)], [], [])
    assert corpus_pipeline.run(spark, str(tmp_path / "b")).where(F.col("n_tokens") >= 0).count() == 2
