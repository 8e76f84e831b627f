"""BPE encoding and decoding by tree concatenation.

White space ends every pre-token of the vocabulary, so words between white space are encoded
on their own and kept in a bounded cache.  A long text is cut into blocks of equal length,
wherever the cuts fall, and its blocks are encoded in parallel.  The unsplit run at each join
is put together as a tree: the window around the join is encoded again and grows until it
shares a token (same id, same place) with the left side and one with the right side.  From a
shared token on the window continues the left side exactly, and up to a shared token it leads
into the right side exactly, because a BPE token sequence is valid if all neighbours are.

Cases: null text is empty text and has no tokens; empty input gives no rows; repeated rows
give a row each; other columns of the input are not read; strings of special tokens in a text
become their ids, as the library does by default (``literal_special`` makes them plain text).
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressline.llm.common import id_as_text, id_as_was, released, text_rows

BLOCK_CHARS = 32_768
WINDOW = 32
CACHED_WORDS = 150_000
TEXTS_AT_ONCE = 64  # whose words are held together
WORDS_AT_ONCE = 2_048

# Python counts four control characters as white space that the vocabulary's pattern keeps
CONTROL = re.compile("[\x1c-\x1f]")
SPACE = re.compile(r"[\t-\r \x85\xa0  -     　]+")
# letters of these words have one form and lower-case one by one
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
PRE_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def byte_letters() -> list[str]:
    """The printable letter that byte-level BPE uses for each byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(kept) else chr(next(rest)) for b in range(256)]


class WordBpe:
    """The library's encoder behind a bounded cache of words; a pre-token of a plain word is a word, too."""

    def __init__(self, path: str, literal_special: bool = False, cached_words: int = CACHED_WORDS):
        # one worker has one core; ids are packed in the machine's order, which must be the result's
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("ids are packed as little-endian 32-bit integers")
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.lib.encode_special_tokens = literal_special
        self.model = Tokenizer(self.lib.model)
        self.letters = byte_letters()
        self.words: dict[str, bytes] = {}
        self.cached_words = cached_words

    def _learn(self, words: list[str]) -> None:
        """Encode words that the cache lacks."""
        split, odd = [], []
        for w in words:
            if w.isascii() and w.isalpha():
                split.append((w, (w.lower(),)))
            elif PLAIN.fullmatch(w) and "<|" not in w:
                split.append((w, PRE_TOKEN.findall(w.lower())))
            else:
                odd.append(w)
        known, letters = self.words, self.letters
        new = list({p for _, parts in split for p in parts if p not in known})
        mapped = [p if p.isascii() else "".join([letters[b] for b in p.encode()]) for p in new]
        for k in range(0, len(new), WORDS_AT_ONCE):  # the library's results are large beside the ids
            found = self.model.encode_batch_fast(mapped[k : k + WORDS_AT_ONCE], add_special_tokens=False)
            for piece, e in zip(new[k : k + WORDS_AT_ONCE], found, strict=True):
                known[piece] = array("I", e.ids).tobytes()
        for word, parts in split:
            known[word] = known[parts[0]] if len(parts) == 1 else b"".join([known[p] for p in parts])
        for word in odd:
            self.words[word] = array("I", self.lib.encode(word, add_special_tokens=False).ids).tobytes()

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, as little-endian unsigned 32-bit integers; a few texts at a time."""
        return [ids for k in range(0, len(texts), TEXTS_AT_ONCE) for ids in self._encode_some(texts[k : k + TEXTS_AT_ONCE])]

    def _encode_some(self, texts: list[str]) -> list[bytes]:
        """The cache is bounded: beyond the limit it starts anew before the next texts."""
        if len(self.words) > self.cached_words:
            self.words.clear()
        split, words = [split_words(t) for t in texts], self.words
        new = {w for part in split for w in part if w not in words}
        if new:
            self._learn(list(new))
        return [b"".join([words[w] for w in part]) for part in split]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def run(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an unsplit run and the (start, end) of each."""
        e = self.lib.encode(text, add_special_tokens=False)
        return np.array(e.ids, np.int64), np.array(e.offsets, np.int64).reshape(-1, 2)


def split_words(text: str) -> list[str]:
    if CONTROL.search(text):
        return [w for w in SPACE.split(text) if w]
    return text.split()


_ENCODERS: dict[tuple[str, bool, int], WordBpe] = {}


def encoder(path: str, literal_special: bool = False, cached_words: int = CACHED_WORDS) -> WordBpe:
    """One encoder for each Python worker; its cache serves all tasks of the worker, until one forgets it."""
    key = (path, literal_special, cached_words)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordBpe(path, literal_special, cached_words)
    return _ENCODERS[key]


_TOKENS: dict[str, list[str]] = {}


def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def tokens_of(path: str) -> list[str]:
    """Token of each id; the vocabulary has no decoder, so a text is its tokens between spaces."""
    if path not in _TOKENS:
        loaded = next((bpe.lib for (at, *_), bpe in _ENCODERS.items() if at == path), None)
        lib = loaded or _library(path)
        _TOKENS[path] = [lib.id_to_token(i) or "" for i in range(lib.get_vocab_size(with_added_tokens=True))]
    return _TOKENS[path]


def forget() -> None:
    """Vocabularies and caches of this worker."""
    _ENCODERS.clear()
    _TOKENS.clear()


def decode_ids(tokens: list[str], ids: bytes) -> str:
    return " ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


# --- joins --------------------------------------------------------------------
def _shared(a: tuple, b: tuple, shift: int, last: bool, lo: int, hi: int) -> tuple[int, int] | None:
    """Indexes of a token that both sides have at the same place, strictly between lo and hi.

    ``shift`` takes b's places to a's.  The first shared token, or the last.  A place with
    several tokens (a character of several bytes) can't be told apart and doesn't count.
    """
    (a_ids, a_at), (b_ids, b_at) = a, b
    single = lambda at: (at[:, 0] < at[:, 1]) & (np.append(at[1:, 0], -1) != at[:, 0]) & (np.insert(at[:-1, 0], 0, -1) != at[:, 0])
    a_ok, b_ok = (single(a_at), single(b_at)) if len(a_ids) and len(b_ids) else ((), ())
    there = {(int(s) + shift, int(e) + shift, int(i)): n for n, ((s, e), i) in enumerate(zip(b_at, b_ids, strict=True)) if len(b_ok) and b_ok[n]}
    order = range(len(a_ids) - 1, -1, -1) if last else range(len(a_ids))
    for n in order:
        s, e = int(a_at[n, 0]), int(a_at[n, 1])
        if len(a_ok) and a_ok[n] and lo < s and e < hi and (s, e, int(a_ids[n])) in there:
            return n, there[(s, e, int(a_ids[n]))]
    return None


def join_runs(bpe: WordBpe, left: tuple, right: tuple) -> tuple:
    """Join two neighbouring runs (text, ids, places) without white space at the join."""
    l_text, l_ids, l_at = left
    r_text, r_ids, r_at = right
    text, cut, w = l_text + r_text, len(l_text), WINDOW
    while True:
        lo, hi = max(0, cut - w), min(len(text), cut + w)
        ids, at = bpe.run(text[lo:hi])
        at = at + lo
        # the window's own ends, and the ends at the join, are not those of the whole text
        from_left = (0, 0) if lo == 0 else _shared((l_ids, l_at), (ids, at), 0, False, lo + w // 4, cut - w // 4)
        to_right = (len(r_ids), len(ids)) if hi == len(text) else _shared((r_ids, r_at + cut), (ids, at), 0, True, cut + w // 4, hi - w // 4)
        if from_left and to_right and from_left[1] <= to_right[1]:
            (a, b), (c, d) = from_left, to_right
            return text, np.concatenate([l_ids[:a], ids[b:d], r_ids[c:]]), np.concatenate([l_at[:a], at[b:d], r_at[c:] + cut])
        w *= 2


def join_tree(bpe: WordBpe, parts: list[tuple]) -> tuple:
    """Join neighbouring runs pair by pair, level by level."""
    while len(parts) > 1:
        pairs = [join_runs(bpe, *parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        parts = pairs
    return parts[0]


def block_parts(bpe: WordBpe, text: str) -> tuple[str, bytes, str]:
    """Run up to the first white space, ids of the words between, run after the last white space.

    A block without white space is one run, kept in the first place.
    """
    first = SPACE.search(text)
    if first is None:
        return text, b"", ""
    start, end = first.start(), len(text)
    while end > first.end() and not SPACE.match(text, end - 1):
        end -= 1
    return text[:start], bpe.encode(text[first.end() : end]), text[end:]


def assemble(bpe: WordBpe, blocks: list[tuple[bool, str, bytes, str]]) -> bytes:
    """Ids of a text from its blocks (has white space, head, ids between, tail), in order."""
    out, open_run = [], []

    def close() -> None:
        parts = [p for p in open_run if p]
        if parts:
            ids = join_tree(bpe, [(p, *bpe.run(p)) for p in parts])[1]
            out.append(ids.astype("<u4").tobytes())
        open_run.clear()

    for spaced, head, ids, tail in blocks:
        open_run.append(head)
        if spaced:
            close()
            out.append(ids)
            open_run.append(tail)
    close()
    return b"".join(out)


def encode_text(bpe: WordBpe, text: str, block_chars: int = BLOCK_CHARS) -> bytes:
    """One text through the same steps as the operator, in one process."""
    cuts = [text[i : i + block_chars] for i in range(0, len(text), block_chars)]
    if len(cuts) < 2:
        return bpe.encode(text)
    return assemble(bpe, [(SPACE.search(c) is not None, *block_parts(bpe, c)) for c in cuts])


# --- operators ------------------------------------------------------------------
def encode(
    df: DataFrame, *, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    block_chars: int = BLOCK_CHARS, literal_special: bool = False, with_text: bool = False,
    cached_words: int = CACHED_WORDS, forgetful: bool = False,
) -> DataFrame:
    """Ids of every whole text: (doc_id, ids binary of little-endian unsigned 32-bit integers).

    ``with_text`` adds ``decoded``, the text of the ids, in the same Python process: a stage of its own
    would keep a second worker, with a second vocabulary, beside each first one.  ``forgetful`` workers drop
    vocabulary and cache at the end of a task, for jobs whose other stages need the memory.
    """
    done = (lambda run: released(run, forget)) if forgetful else (lambda run: run)
    rows = text_rows(df, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows, schema = id_as_text(rows), "doc_id string, ids binary" + (", decoded string" if with_text else "")

    def result(doc_ids: list, ids: list[bytes]) -> pa.RecordBatch:
        columns = {"doc_id": pa.array(doc_ids, pa.string()), "ids": pa.array(ids, pa.binary())}
        if with_text:
            tokens = tokens_of(tokenizer_path)
            columns["decoded"] = pa.array([decode_ids(tokens, i) for i in ids], pa.string())
        return pa.RecordBatch.from_pydict(columns)

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer_path, literal_special, cached_words)
        for batch in batches:
            for k in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(k, TEXTS_AT_ONCE)
                yield result(part.column("doc_id").to_pylist(), bpe.encode_many(part.column("text").to_pylist()))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                text = r["text"]
                for k in range(0, len(text), 16 * block_chars):
                    cuts = [text[i : i + block_chars] for i in range(k, min(len(text), k + 16 * block_chars), block_chars)]
                    n, first = len(cuts), k // block_chars
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["row"]] * n, pa.int64()), pa.array([r["doc_id"]] * n, pa.string()), pa.array(range(first, first + n), pa.int64()), pa.array(cuts, pa.string())],
                        names=["row", "doc_id", "block", "text"])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer_path, literal_special, cached_words)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            parts = [block_parts(bpe, t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("block"), pa.array([SPACE.search(t) is not None for t in texts], pa.bool_()),
                 *(pa.array([p[k] for p in parts], kind) for k, kind in enumerate((pa.string(), pa.binary(), pa.string())))],
                names=["row", "doc_id", "block", "spaced", "head", "ids", "tail"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer_path, literal_special, cached_words)
        for batch in batches:
            for r in batch.to_pylist():
                ids = assemble(bpe, [(p["spaced"], p["head"], p["ids"], p["tail"]) for p in r["parts"]])
                yield result([r["doc_id"]], [ids])

    long = rows.where(F.length("text") > block_chars).withColumn("row", F.monotonically_increasing_id())
    cuts = long.mapInArrow(blocks, "row long, doc_id string, block long, text string").repartition("row", "block")
    parts = cuts.mapInArrow(done(encoded), "row long, doc_id string, block long, spaced boolean, head string, ids binary, tail string")
    whole = parts.groupBy("row", "doc_id").agg(F.sort_array(F.collect_list(F.struct("block", "spaced", "head", "ids", "tail"))).alias("parts"))
    return id_as_was(rows.where(F.length("text") <= block_chars).mapInArrow(done(short), schema).unionByName(
        whole.select("doc_id", "parts").mapInArrow(done(joined), schema)), kind)


def decode(df: DataFrame, *, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The text of ids, special tokens kept: (doc_id, ids, decoded). Null ids are no ids."""
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{ids_col}`"), F.lit(b"")).alias("ids"))

    kind = rows.schema["doc_id"].dataType.simpleString()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(tokenizer_path)
        for batch in batches:
            decoded = pa.array([decode_ids(tokens, i) for i in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), decoded], names=["doc_id", "ids", "decoded"])

    return id_as_was(id_as_text(rows).mapInArrow(released(texts, forget), "doc_id string, ids binary, decoded string"), kind)
