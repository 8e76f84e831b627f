import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pressline.llm import spelling
from pressline.llm.spelling import TwoWayIndex, group, search, variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def one_error(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:k] + b[k + 1 :] for k in range(len(b)))


def brute(n):
    near = {w: [v for v in n if one_error(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = top if top is not None and n[top] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def answer(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def edits(rng, word, letters):
    k = rng.randrange(len(word) + 1)
    kind = rng.randrange(3)
    if kind == 0:
        return word[:k] + rng.choice(letters) + word[k:]
    return word[:k] + (rng.choice(letters) if kind == 1 else "") + word[k + 1 :]


def lexicon(seed, size, letters, first=""):
    rng = random.Random(seed)
    words = {first + "".join(rng.choices(letters, k=rng.randrange(6, 12))) for _ in range(size)}
    for _ in range(2):
        words |= {edits(rng, w, letters) for w in sorted(words)}
    return {w: rng.choice((5, 6, 30, 160, 800, 4000)) for w in sorted(words) if len(w) >= 6}


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "aeiouàßÿ×"])
def test_index_search_equals_brute_force(letters):
    words = sorted(lexicon(1, 60, letters))
    index = TwoWayIndex(words)
    patterns = words + ["zzzzzz", letters[0] * 40, "aaaaaaa"]
    halves = np.array([len(p) // 2 for p in patterns])
    who, what = search(index, patterns, halves)
    got = sorted(zip(who.tolist(), what.tolist()))
    want = [(i, j) for i, p in enumerate(patterns) for j, w in enumerate(words) if one_error(p, w) and w.startswith(p[: len(p) // 2])]
    assert got == want


@pytest.mark.parametrize("letters,first", [("ab", ""), ("abcdef", ""), ("abcd", "prefix"), ("xyzéÉ", "")])
def test_groups_equal_brute_force(spark, letters, first, monkeypatch):
    # small ranges and crowds, so that patterns cross ranges and ranges are searched by several tasks
    monkeypatch.setattr(spelling, "RANGE_WORDS", 60)
    monkeypatch.setattr(spelling, "CROWD", 1)
    monkeypatch.setattr(spelling, "PATTERNS", 16)
    n = lexicon(2, 60, letters, first)
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    want = brute(n)
    assert answer(group(words)) == want
    assert any(form for form, *_ in want.values())


def test_documents(docs, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 50)
    monkeypatch.setattr(spelling, "HELD_WORDS", 7)
    rng = random.Random(4)
    words = ["ÉtéMots", "Variant", "variant", "variants", "varient", "VARIANT", "separate", "seperate", "sep", "straße", "naïveté", "x" * 90]
    weights = [3, 60, 60, 9, 2, 5, 40, 4, 9, 6, 7, 1]
    rows = [(i, " ".join(rng.choices(words, weights, k=40)) + rng.choice(["", "-", "1 中文 "])) for i in range(150)]
    rows += [(None, "variant separate"), (None, None), (7, None), (8, ""), (9, "12 34"), (9, "variant, Seperate. variant-variant")] + rows[:3]
    assert answer(variants(docs(*rows))) == brute(counted(rows))


def test_chain_of_forms_and_ties(spark):
    n = {"abcdef": 5, "abcdefg": 25, "abcdefgh": 125, "abcdefghi": 700, "bbcdefg": 25, "qqqqqq": 9, "qqqqqr": 45, "qqqqqs": 45, "lonely-": 8}
    n = {w.replace("-", "y"): c for w, c in n.items()}
    got = answer(group(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got == brute(n)
    assert got["abcdef"][1] == "abcdefghi" and got["qqqqqq"][0] == "qqqqqr"


def test_empty_tables(spark, docs):
    assert answer(variants(docs())) == {}
    assert answer(variants(docs((1, "few words here")))) == {}
