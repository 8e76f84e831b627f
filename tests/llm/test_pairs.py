import random
import re
from itertools import combinations, combinations_with_replacement

import corpus_pipeline
from pressline.llm import decontaminate, fingerprint, ngram_join
from pressline.llm.components import components

WORDS = [f"w{i}" for i in range(400)]


def sets_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 4]) for k in range(max(1, len(words) - 3))} if words else set()


def brute(rows):
    sets = {i: sets_of(t) for i, t in rows}
    low = {i: i for i in sets}
    for _ in sets:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a < b and both and 100 * both >= 85 * len(sets[a] | sets[b]) and low[a] != low[b]:
                    low[a] = low[b] = min(low[a], low[b])
                    changed = True
        if not changed:
            break
    return {i: (len(sets[i]), low[i]) for i in sets}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = rng.choice(WORDS)
    return out


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", "   ", "One", "one", "two words", "a b c", "A B C"]
    for size in (8, 14, 20, 30, 60, 150):
        base = rng.choices(WORDS, k=size)
        texts += [" ".join(edited(rng, base, n % 4)) for n in range(9)] + [" ".join(base[:-1]), " ".join(base[1:]), " ".join(base)]
    hot = rng.choices(WORDS, k=90)
    texts += [" ".join(edited(rng, hot, rng.choice((0, 1, 1, 2)))) for _ in range(70)]
    texts += [" ".join(rng.choices(WORDS, k=40)) for _ in range(20)] + ["same again " * 300]
    return list(enumerate(texts))


def test_join_equals_brute_force(docs, monkeypatch):
    # small limits, so that the tiles and both rounds take part
    monkeypatch.setattr(ngram_join, "LONG_LIST", 8)
    monkeypatch.setattr(ngram_join, "TILE", 16)
    for seed in (1, 2):
        rows = corpus(seed)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs(*rows)).collect()}
        assert got == brute(rows)


def test_light_keys_link_exactly():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(300):
        a = np.unique(rng.integers(0, 40, rng.integers(1, 22)).astype(np.uint64))
        b = np.unique(np.concatenate([rng.choice(a, len(a) - rng.integers(0, min(3, len(a)))), rng.integers(0, 40, rng.integers(0, 3)).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        link = 100 * both >= 85 * (len(a) + len(b) - both)
        if len(a) <= 24 and len(b) <= 24:
            shared = {k for k, _ in ngram_join.light_keys(a, 24)} & {k for k, _ in ngram_join.light_keys(b, 24)}
            # keys of one size may be shared by sets of that size only
            assert bool(shared) == link or (len(a) != len(b) and not link)


def test_repeated_rows_and_one_of_each(docs):
    text = " ".join(WORDS[:50])
    rows = [(7, text), (3, text), (3, text), (9, text + " more"), (5, None), (5, None), (8, ""), (None, "a b c d e"), (2**60 + 1, "k l m n o p")]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.join(docs(*rows)).collect())
    assert got == sorted([("7", 47, "3"), ("3", 47, "3"), ("3", 47, "3"), ("9", 48, "3"), ("5", 0, "5"), ("5", 0, "5"), ("8", 0, "8"), ("None", 2, "None"), (str(2**60 + 1), 3, str(2**60 + 1))])
    kept = ngram_join.one_of_each(docs(*rows))
    assert sorted((str(r.doc_id), r.text) for r in kept.where("text <> ''").collect()) == [(str(2**60 + 1), "k l m n o p"), ("3", text), ("None", "a b c d e")]
    assert kept.columns == docs(*rows).columns
    assert ngram_join.join(docs()).count() == 0


def test_one_of_each_with_null_and_repeated_ids(docs):
    text, other, third, nulls = (" ".join(WORDS[k : k + 50]) for k in (0, 60, 120, 180))
    rows = [
        (3, text), (None, text), (None, text + " more"), (None, "a b c d e"), (None, ""), (None, None), (None, other),
        (7, third), (7, text + " tail"), (7, third.upper()), (None, nulls), (None, nulls + " end"), (None, nulls + " last"), (2, other + " x"),
    ]
    kept = [(r.doc_id, r.text) for r in ngram_join.one_of_each(docs(*rows)).collect()]
    groups = [(None, nulls), (None, nulls + " end"), (None, nulls + " last")], [(7, third), (7, third.upper())]
    assert all(sum(r in g for r in kept) == 1 for g in groups)
    rest = [r for r in kept if not any(r in g for g in groups)]
    assert sorted(map(str, rest)) == sorted(map(str, [(3, text), (None, "a b c d e"), (None, ""), (None, None), (2, other + " x")]))


def test_the_stage_links_what_lies_between_the_two_thresholds(spark, docs):
    base = [f"b{k}" for k in range(200)]
    rows = [(1, " ".join(base)), (2, " ".join(base + [f"n{k}" for k in range(44)])), (3, " ".join(base[:80] + [f"m{k}" for k in range(15)] + base[95:])), (4, " ".join(base[:120]))]
    rows += [(10, "a b c d e f g h i j k l m"), (11, "a b c d e f g h i j k l m n"), (12, "a b c d e f g h i j k x y")]
    assert {r.doc_id for r in ngram_join.one_of_each(docs(*rows)).collect()} == {1, 2, 3, 4, 10, 12}
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, docs(*rows), "").collect()} == {1, 4, 10, 12}


def test_other_parameters_equal_brute_force(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "LONG_LIST", 8)
    monkeypatch.setattr(ngram_join, "TILE", 16)
    rows = corpus(4)
    got = {r.doc_id: r.component_id for r in ngram_join.join(docs(*rows), shingle=5, percent=80).collect()}
    sets = {}
    for i, text in rows:
        words = (text or "").lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    low = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a, b in combinations(sets, 2):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]) and low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    assert got == low


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 160), 100)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_decontamination(spark, docs):
    rng = random.Random(5)
    item = rng.choices(WORDS, k=40)
    changed = list(item)
    for k in (6, 17, 29):
        changed[k] = "other"
    noise = lambda n: rng.choices([w + "x" for w in WORDS], k=n)
    rows = [
        (1, " ".join(noise(30) + item + noise(30))), (2, " ".join(noise(5) + changed + noise(9))), (3, " ".join(noise(60))),
        (4, " ".join(noise(20) + item[10:26] + noise(20))), (5, " ".join(noise(20) + item[10:17] + noise(20))),
        (6, None), (7, ""), (8, ", ".join(item).upper()), (9, "Short item of six words. " * 2), (1, "nothing here"), (10, " ".join(noise(30_000) + item)),
    ]
    bench = spark.createDataFrame([(0, " ".join(item)), (1, "short item of six words"), (2, None), (3, "too few")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(docs(*rows), bench).collect()}
    assert got == {(1, 0), (2, 0), (4, 0), (8, 0), (10, 0), (9, 1)}
    assert decontaminate.overlaps(docs(), bench).count() == 0 and decontaminate.overlaps(docs(*rows), bench.limit(0)).count() == 0


def longest_stretch(item, text):
    """Agreeing words of the longest stretches, side by side at any shift, of which four fifths agree."""
    best = 0
    for shift in range(-len(item), len(text)):
        same = [item[k] == text[k + shift] if 0 <= k + shift < len(text) else None for k in range(len(item))]
        for i in range(len(item)):
            good = 0
            for j in range(i, len(item)):
                if same[j] is None:
                    break
                good += same[j]
                if 5 * good >= 4 * (j + 1 - i):
                    best = max(best, good)
    return best


def test_decontamination_equals_brute_force(spark, docs):
    rng = random.Random(6)
    items = {n: [f"i{n}x{k}" for k in range(n)] for n in (5, 6, 9, 10, 11, 13, 14, 20, 30, 60)}
    noise = lambda n: rng.choices(WORDS, k=n)
    texts = []
    for item in items.values():
        passages = [item[:n] for n in range(5, 18)] + [item[-n:] for n in (12, 13)]
        passages += [["other" if k % step == at else w for k, w in enumerate(item)] for step in (3, 4, 5, 6, 7, 9) for at in range(step)]
        passages += [[rng.choice(WORDS) if rng.random() < share else w for w in item] for share in (0.1, 0.15, 0.2, 0.25, 0.3) for _ in range(6)]
        texts += [noise(rng.randrange(9)) + p + noise(rng.randrange(9)) for p in passages]
    want = {(d, n) for d, t in enumerate(texts) for n, item in items.items() if longest_stretch(item, t) >= min(13, -(-9 * n // 10))}
    bench = spark.createDataFrame([(n, " ".join(t)) for n, t in items.items()], "item_id long, text string")
    got = decontaminate.overlaps(docs(*((d, " ".join(t)) for d, t in enumerate(texts))), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(r.n_words <= r.last_word - r.first_word + 1 <= r.n_words * 1.25 for r in got)


def test_masks_miss_no_admitted_change():
    windows = [re.compile("(?=" + m.replace("0", ".") + ")") for m in decontaminate.MASKS]
    for ones, zeros in ((9, 1), (10, 1), (11, 1), (12, 1), (13, 0), (13, 1), (13, 2), (13, 3), (16, 4), (20, 5), (24, 6)):
        for gaps in combinations_with_replacement(range(1, ones), zeros):
            words = "".join("0" * gaps.count(k) + "1" for k in range(ones)) if zeros else "1" * ones
            assert any(w.search(words) for w in windows), words


def test_fingerprints(docs):
    a, b = " ".join(WORDS[:200]), " ".join(WORDS[200:])
    rows = [(1, a), (2, a), (3, b), (4, None), (5, ""), (6, "one"), (9, a + " tail"), (9, a + " tail"), (None, "é🎉 x")]
    got = fingerprint.edited(docs(*rows)).collect()
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].fingerprint == by_id[2].fingerprint != by_id[3].fingerprint and by_id[4].fingerprint == by_id[5].fingerprint
    assert by_id[2].near_next == 1.0 and by_id[3].near_next == 0.0 and by_id[None].n_chars == 4
    import hashlib

    for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True):
        t, n = t or "", n or ""
        half = len(t) // 2
        if i != 9:
            assert by_id[i].edited_sha256 == hashlib.sha256((t[: len(t) - half] + n[:half]).encode()).hexdigest()
    assert fingerprint.edited(docs()).count() == 0


def test_fingerprints_follow_order(docs):
    words = [f"u{i}" for i in range(300)]
    moved = words[150:] + words[:150]
    one = docs((1, " ".join(words)), (2, " ".join(moved)), (3, " ".join(words[:295])))
    got = {r.doc_id: r.fingerprint for r in fingerprint.fingerprints(one, "text", "doc_id").collect()}
    alike = lambda x, y: sum(p == q for p, q in zip(got[x], got[y], strict=True)) / fingerprint.FUNCTIONS
    assert alike(1, 3) > 0.8 and alike(1, 2) < 0.8


def test_the_driver_lets_go_after_rounds(spark, monkeypatch):
    import importlib

    stars = importlib.import_module("pressline.llm.components")
    done, release = [], stars.driver_released
    monkeypatch.setattr(stars, "driver_released", lambda s: done.append(release(s)))
    edges = spark.createDataFrame([(k, k + 1) for k in range(5)], "u long, v long")
    assert sorted(map(tuple, stars.components(edges).collect())) == [(k, 0) for k in range(6)]
    assert done
