import random

import numpy as np
import public_tokenizers
import pytest

from pressline.llm import bpe, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = ["a", "b", "s", "l", "ll", "'", "'s", "ve", "T", " ", "\n", "é", "e\u0301", "<|endoftext|>", "1", "中", "ß", "É", "²", "\x1c", "\u3000", "Σ", "İ", ".", "!!", "-", "🎉", "th", "ing"]


@pytest.fixture(scope="module")
def word_bpe():
    return bpe.WordBpe(PATH)


def whole(word_bpe, text):
    return word_bpe.lib.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("block", [7, 40, 1000])
def test_blocks_give_the_ids_of_the_whole_text(word_bpe, block):
    rng = random.Random(block)
    for n in range(300):
        text = "".join(rng.choices(ALPHABET, k=rng.randint(0, 250)))
        if n % 3 == 0:
            text = "".join(text.split())
        got = np.frombuffer(bpe.encode_text(word_bpe, text, block), "<u4").tolist()
        assert got == whole(word_bpe, text), repr(text)


def test_operator(spark, docs, word_bpe):
    long = "unsplit" * 900 + " and words " * 400
    rows = [(1, None), (2, ""), (3, "One two"), (3, "One two"), (None, "x<|endoftext|>"), (5, long), (2**60 + 1, "   \n")]
    got = bpe.decode(bpe.encode(docs(*rows), tokenizer_path=PATH, block_chars=1000), tokenizer_path=PATH).collect()
    want = sorted((str(i), bytes(np.array(whole(word_bpe, t or ""), "<u4")), word_bpe.lib.decode(whole(word_bpe, t or ""), skip_special_tokens=False)) for i, t in rows)
    assert sorted((str(r.doc_id), bytes(r.ids), r.decoded) for r in got) == want
    both = bpe.encode(docs(*rows), tokenizer_path=PATH, block_chars=1000, with_text=True).collect()
    assert sorted((str(r.doc_id), bytes(r.ids), r.decoded) for r in both) == want
    assert bpe.encode(docs(), tokenizer_path=PATH).count() == 0


@pytest.mark.parametrize("block", [3, 1 << 19])
def test_separator_scan(spark, docs, word_bpe, tmp_path, block):
    texts = [None, "", "some words here and more of them", "<|endoftext|>", "again, again " * 20, "last"]
    path = str(tmp_path / "flat")
    token_counts.write_flat(docs(*enumerate(texts)).coalesce(1), path, tokenizer_path=PATH, separator=49407)
    got = token_counts.scan(spark, path, separator=49407, block_tokens=block).orderBy("doc_no").collect()
    plain = bpe.WordBpe(PATH, literal_special=True)
    want = [len(plain.encode(t or "")) // 4 for t in texts]
    assert [r.n_tokens for r in got] == want and [r.doc_no for r in got] == list(range(len(texts))) and all(r.closed for r in got)


def test_scan_of_an_open_end(spark, tmp_path):
    (tmp_path / "part-0").write_bytes(np.array([5, 9, 7, 7, 9, 9, 1, 2, 3], "<u2").tobytes())
    got = token_counts.scan(spark, str(tmp_path), separator=9, block_tokens=2).orderBy("doc_no").collect()
    assert [(r.first_token, r.n_tokens, r.closed) for r in got] == [(0, 1, True), (2, 2, True), (5, 0, True), (6, 3, False)]


def test_scan_of_a_file_beyond_two_gigabytes(spark, tmp_path):
    path, tokens = tmp_path / "part-0", 1_100_000_000  # 2.2 GB, nearly all of it a hole in the file
    with path.open("wb") as file:
        for at in (5, 700_000_000, tokens - 3):
            file.seek(2 * at)
            file.write(np.array([9], "<u2").tobytes())
        file.truncate(2 * tokens)
    got = token_counts.scan(spark, str(tmp_path), separator=9, block_tokens=1 << 23).orderBy("doc_no").collect()
    path.unlink()
    assert [(r.first_token, r.n_tokens, r.closed) for r in got] == [(0, 5, True), (6, 699_999_994, True), (700_000_001, tokens - 3 - 700_000_001, True), (tokens - 2, 2, False)]


def test_scan_where_only_spark_reads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_counts, "ranges_open", lambda path: False)
    (tmp_path / "part-0").write_bytes(np.array([5, 9, 7, 7, 9, 9, 1, 2, 3], "<u2").tobytes())
    got = token_counts.scan(spark, str(tmp_path), separator=9, block_tokens=2).orderBy("doc_no").collect()
    assert [(r.first_token, r.n_tokens) for r in got] == [(0, 1), (2, 2), (5, 0), (6, 3)]
