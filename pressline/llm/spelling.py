"""Spelling variants of a corpus, grouped under their most frequent near word.

Words are counted over whole texts.  A near word differs by exactly one inserted, deleted or replaced
code point, so one half of the pattern occurs in it unchanged: as its beginning or as its end.  The
vocabulary is dealt in ranges, once by word and once by reversed word; a pattern goes to the ranges that
its first (or reversed last) half can lie in.  Each range has a bidirectional FM index over its delimited
words: the half is matched from the middle to the delimiter, then the search turns round and crosses the
other half with one error.  The rank of the delimited match is the word.

* Null and empty texts have no words; a null id counts as empty text in ``<doc_id>:<run>``.  Repeated
  rows count each.  Columns other than the two named ones are not read.  An empty table gives no rows.
* Long texts are read in pieces that end between runs.
* Ties between near words of one count go to the first in code-point order.
* A range that gets many more patterns than it has words is searched by several tasks.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressline.llm.common import cut, id_as_text, released, text_rows

LETTERS = "A-Za-zÀ-ÿ"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: characters of a text that are searched for runs at once
PIECE = 1 << 20
#: different words a task counts before it hands them on
HELD_WORDS = 200_000
#: words of one index, words that make a range worth a task of its own, and patterns searched at once
RANGE_WORDS = 32_768
TASK_WORDS = 4_096
PATTERNS = 8_192
#: patterns a task gets for one range, in words of a full range
CROWD = 4
#: rows of a rank block
BLOCK = 64


# ---- words -------------------------------------------------------------------------------------------------

def pieces(text: str) -> Iterator[str]:
    gap = re.compile(f"[^{LETTERS}]")
    start = 0
    while start < len(text):
        end = start + PIECE
        if end < len(text):
            found = gap.search(text, end)
            end = found.start() if found else len(text)
        yield text[start:end]
        start = end


def misspelt(run: str, doc: int, one_in: int) -> str:
    """The run as this document has it: where ``one_in`` divides the hash, a letter is lost.  ``doc`` is the hash of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), doc)
    if h % one_in:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def count_words(shortest: int, one_in: int):
    runs = re.compile(f"[{LETTERS}]{{{shortest},}}")

    def handed_on(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc = zlib.crc32(f"{doc_id or ''}:".encode())
                for piece in pieces(text.as_py()):
                    for word, n in Counter(runs.findall(piece.encode().translate(LOWER).decode())).items():
                        held[misspelt(word, doc, one_in)] += n
                    if len(held) > HELD_WORDS:
                        yield handed_on(held)
                        held = Counter()
        if held:
            yield handed_on(held)

    return run


def vocabulary(docs: DataFrame, *, shortest: int = 6, least: int = 5, one_in: int = 199, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words of at least ``shortest`` code points that occur ``least`` times."""
    rows = id_as_text(text_rows(docs, id_col, text_col).where(F.length("text") >= shortest))
    words = rows.mapInArrow(released(count_words(shortest, one_in)), "word string, n long").where(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# ---- the index ---------------------------------------------------------------------------------------------

def sorted_rotations(codes: np.ndarray, kinds: int) -> np.ndarray:
    """Starts of the rotations of a text in sorted order, by doubling the compared length."""
    width = max(1, int(62 // np.log2(max(2, kinds))))
    rank = np.zeros(len(codes), np.int64)
    for k in range(width):
        rank = rank * kinds + np.roll(codes, -k)
    while True:
        order = np.argsort(rank, kind="stable")
        place = np.cumsum(np.r_[0, np.diff(rank[order]) != 0])
        rank = np.empty(len(codes), np.int64)
        rank[order] = place
        if place[-1] == len(codes) - 1:
            return order
        rank, width = rank * len(codes) + np.roll(rank, -width), width * 2


class Ranks:
    """Last column of the sorted rotations, with counts of smaller and equal symbols before any row."""

    def __init__(self, codes: np.ndarray, kinds: int) -> None:
        order = sorted_rotations(codes, kinds)
        self.last = codes[order - 1].astype(np.uint8)
        self.first = np.r_[0, np.cumsum(np.bincount(codes, minlength=kinds))]
        n_blocks = len(codes) // BLOCK + 1
        self.rows = np.full((n_blocks, BLOCK), 255, np.uint8)
        self.rows.ravel()[: len(codes)] = self.last
        seen = np.bincount(np.arange(len(codes)) // BLOCK * kinds + self.last, minlength=n_blocks * kinds).reshape(n_blocks, kinds)
        before = np.cumsum(seen, axis=0) - seen
        self.smaller = np.zeros((n_blocks, kinds + 1), np.int32)
        self.smaller[:, 1:] = np.cumsum(before, axis=1)

    def before(self, symbols: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many symbols before each row are smaller, and how many are equal."""
        block, rest = rows // BLOCK, rows % BLOCK
        there = np.arange(BLOCK) < rest[:, None]
        held = self.rows[block]
        less = self.smaller[block, symbols]
        equal = self.smaller[block, symbols + 1] - less
        return less + ((held < symbols[:, None]) & there).sum(1), equal + ((held == symbols[:, None]) & there).sum(1)


class TwoWayIndex:
    """FM index of delimited words that grows a match at either end.

    A match is (row in the index of the text, row in that of the reversed text, size), kept in step.
    ``words`` are sorted; code 0 is the delimiter, and the rank of a delimited word is its place.
    """

    def __init__(self, words: list[str]) -> None:
        raw = np.frombuffer(("\0" + "\0".join(words)).encode("latin-1"), np.uint8)
        used = np.unique(raw)
        self.kinds = len(used)
        self.code = np.full(256, -1, np.int16)
        self.code[used] = np.arange(self.kinds)
        codes = self.code[raw].astype(np.int64)
        self.text, self.reversed = Ranks(codes, self.kinds), Ranks(codes[::-1].copy(), self.kinds)
        self.size = len(codes)

    @staticmethod
    def grown(side: Ranks, row: np.ndarray, other: np.ndarray, size: np.ndarray, symbols: np.ndarray):
        known = np.maximum(symbols, 0)
        less, equal = side.before(known, row)
        less_end, equal_end = side.before(known, row + size)
        return side.first[known] + equal, other + less_end - less, np.where(symbols < 0, 0, equal_end - equal)

    def left(self, match, symbols):
        row, other, size = self.grown(self.text, match[0], match[1], match[2], symbols)
        return row, other, size

    def right(self, match, symbols):
        other, row, size = self.grown(self.reversed, match[1], match[0], match[2], symbols)
        return row, other, size

    def followers(self, match) -> tuple[np.ndarray, np.ndarray]:
        """(place of the match, symbol) for each symbol that follows it in the text."""
        small = np.flatnonzero(match[2] <= 2 * self.kinds)
        sizes = match[2][small]
        at = np.repeat(small, sizes)
        rows = np.repeat(match[1][small] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        pairs = np.unique(at * self.kinds + self.reversed.last[rows])
        large = np.flatnonzero(match[2] > 2 * self.kinds)  # too long to list: every symbol is tried
        return (np.r_[pairs // self.kinds, np.repeat(large, self.kinds)], np.r_[pairs % self.kinds, np.tile(np.arange(self.kinds), len(large))])


def chosen(match, at):
    return tuple(x[at] for x in match)


def alive(owner, match):
    at = np.flatnonzero(match[2] > 0)
    return owner[at], chosen(match, at)


def joined(parts):
    owners, matches = zip(*parts, strict=True)
    return np.concatenate(owners), tuple(np.concatenate(x) for x in zip(*matches, strict=True))


def search(index: TwoWayIndex, patterns: list[str], halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pattern, rank of the word) of the words that keep the first half and differ by one error behind it.

    An inserted letter stands behind equal letters, of equal letters the last one is lost: so each word is found once.
    """
    lengths = np.fromiter(map(len, patterns), np.int64, len(patterns))
    raw = np.zeros((len(patterns), int(lengths.max(initial=0)) + 2), np.uint8)
    raw[np.arange(raw.shape[1]) < lengths[:, None]] = np.frombuffer("".join(patterns).encode("latin-1"), np.uint8)
    letters = index.code[raw].astype(np.int64)  # the delimiter fills the end

    owner = np.arange(len(patterns))
    start = np.zeros(len(patterns), np.int64)
    match = (start, start, np.full(len(patterns), index.size))
    for step in range(int(halves.max(initial=0)) + 1):  # from the middle to the delimiter before the word
        going = halves[owner] >= step
        symbols = np.where(halves[owner] == step, 0, letters[owner, np.maximum(halves[owner] - 1 - step, 0)])
        grown = index.left(chosen(match, going), symbols[going])
        owner, match = alive(*joined([(owner[~going], chosen(match, ~going)), (owner[going], grown)]))

    none = (np.zeros(0, np.int64), (np.zeros(0, np.int64),) * 3)
    wrong, found = none, [none]
    for step in range(int((lengths - halves).max(initial=0)) + 1):  # across the other half
        at, symbols = index.followers(match)
        other = (symbols != 0) & (symbols != letters[owner[at], halves[owner[at]] + step])
        at, symbols = at[other], symbols[other]
        one_more = alive(owner[at], index.right(chosen(match, at), symbols))
        pool = joined([wrong, one_more])
        pool = alive(pool[0], index.right(pool[1], letters[pool[0], halves[pool[0]] + step]))
        ended = halves[pool[0]] + step == lengths[pool[0]]
        found.append((pool[0][ended], chosen(pool[1], ended)))
        wrong = (pool[0][~ended], chosen(pool[1], ~ended))

        inside = halves[owner] + step < lengths[owner]
        owner, match = owner[inside], chosen(match, inside)
        here = halves[owner] + step
        lost = letters[owner, here] != letters[owner, here + 1]
        replaced = halves[one_more[0]] + step < lengths[one_more[0]]
        wrong = joined([wrong, (one_more[0][replaced], chosen(one_more[1], replaced)), (owner[lost], chosen(match, lost))])
        owner, match = alive(owner, index.right(match, letters[owner, here]))
    owner, match = joined(found)
    return owner, match[0]


# ---- ranges and patterns -----------------------------------------------------------------------------------

def turned(word: str, way: int) -> str:
    return word[::-1] if way else word


def kept_half(length: int, way: int) -> int:
    """Letters that way 0 keeps at the beginning and way 1 at the end."""
    return length - length // 2 if way else length // 2


class Ranges:
    """Where words and patterns go: for each way the first word of every range, and tasks a range."""

    def __init__(self, starts: list[list[str]]) -> None:
        self.starts, self.tasks = starts, [[1] * len(s) for s in starts]

    def of_word(self, word: str, way: int) -> int:
        return max(0, bisect_right(self.starts[way], turned(word, way)) - 1)

    def of_pattern(self, word: str, way: int) -> range:
        """The ranges that can hold words with the kept half of this one."""
        half = turned(word, way)[: kept_half(len(word), way)]
        return range(max(0, bisect_right(self.starts[way], half) - 1), bisect_right(self.starts[way], half + "Ā"))

    def split(self, crowds: dict[tuple[int, int], int], crowd: int) -> None:
        for (way, k), n in crowds.items():
            self.tasks[way][k] = max(1, -(-n // crowd))


def count_patterns(ranges: Ranges):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                for way in (0, 1):
                    seen.update((way, k) for k in ranges.of_pattern(word, way))
        yield pa.RecordBatch.from_pylist([{"way": w, "k": k, "n": n} for (w, k), n in seen.items()], pa.schema([("way", pa.int32()), ("k", pa.int32()), ("n", pa.int64())]))

    return run


DEALT = "way int, k int, task int, is_pattern boolean, word string, n long"


def deal(ranges: Ranges):
    schema = pa.schema([("way", pa.int32()), ("k", pa.int32()), ("task", pa.int32()), ("is_pattern", pa.bool_()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for way in (0, 1):
                    k = ranges.of_word(word, way)
                    out += [(way, k, task, False, word, n) for task in range(ranges.tasks[way][k])]
                    out += [(way, k, zlib.crc32(word.encode()) % ranges.tasks[way][k], True, word, None) for k in ranges.of_pattern(word, way)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)

    return run


class RangeSearch:
    """One range of words, and the patterns that come after them."""

    def __init__(self, way: int, words: list[str], counts: list[int]) -> None:
        self.way = way
        order = sorted(range(len(words)), key=lambda i: turned(words[i], way))
        self.words = [words[i] for i in order]
        self.n = np.array([counts[i] for i in order], np.int64)
        self.place = np.empty(len(words), np.int64)
        self.place[sorted(range(len(words)), key=self.words.__getitem__)] = np.arange(len(words))
        self.index = TwoWayIndex([turned(w, way) for w in self.words]) if words else None

    def near(self, patterns: list[str]) -> pa.RecordBatch:
        """(word, n_near, best_n, best) of the patterns with near words here that the other way does not find."""
        if self.index is None:
            return summed([], [], [], [])
        halves = np.array([kept_half(len(w), self.way) for w in patterns], np.int64)
        who, what = search(self.index, [turned(w, self.way) for w in patterns], halves)
        if self.way:  # a word with both halves unchanged is found from its beginning
            alone = [not self.words[b].startswith(patterns[a][: len(patterns[a]) // 2]) for a, b in zip(who.tolist(), what.tolist())]
            who, what = who[alone], what[alone]
        order = np.lexsort((self.place[what], -self.n[what], who))
        who, what = who[order], what[order]
        heads = np.flatnonzero(np.r_[True, who[1:] != who[:-1]]) if len(who) else np.zeros(0, np.int64)
        return summed([patterns[i] for i in who[heads]], np.diff(np.r_[heads, len(who)]), self.n[what[heads]], [self.words[i] for i in what[heads]])


NEAR = "word string, n_near long, best_n long, best string"


def summed(words, n_near, best_n, best) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(words, pa.string()), pa.array(n_near, pa.int64()), pa.array(best_n, pa.int64()), pa.array(best, pa.string())], names=["word", "n_near", "best_n", "best"])


def near_in_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (way, range, task, words before patterns); one index and some patterns are held at a time."""
    cell, words, counts, patterns, there = None, [], [], [], None
    for batch in batches:
        for *key, is_pattern, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            if key != cell:
                if patterns:
                    yield there.near(patterns)
                cell, words, counts, patterns, there = key, [], [], [], None
            if not is_pattern:
                words.append(word)
                counts.append(n)
                continue
            if there is None:
                there = RangeSearch(key[0], words, counts)
                words, counts = [], []
            patterns.append(word)
            if len(patterns) >= PATTERNS:
                yield there.near(patterns)
                patterns = []
    if patterns:
        yield there.near(patterns)


def range_starts(words: DataFrame, way: int, n_ranges: int) -> list[str]:
    """The first word of each range: one row for each ``RANGE_WORDS`` words, at least, reaches the driver."""
    key = F.reverse("word") if way else F.col("word")
    first = words.select(key.alias("key")).repartitionByRange(n_ranges, "key").groupBy(F.spark_partition_id().alias("k")).agg(F.min("key").alias("key"))
    return sorted(r["key"] for r in first.collect())


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best), one row or more for each word of the written table ``words`` that has near words."""
    parallel = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = words.count()
    n_ranges = max(1, -(-total // RANGE_WORDS), min(parallel, -(-total // TASK_WORDS)))
    ranges = Ranges([range_starts(words, way, n_ranges) for way in (0, 1)])
    crowds = words.select("word").mapInArrow(count_patterns(ranges), "way int, k int, n long").groupBy("way", "k").agg(F.sum("n").alias("n")).collect()
    ranges.split({(r["way"], r["k"]): r["n"] for r in crowds}, CROWD * RANGE_WORDS)
    dealt = words.select("word", "n").mapInArrow(deal(ranges), DEALT)
    cells = dealt.repartition("way", "k", "task").sortWithinPartitions("way", "k", "task", "is_pattern")
    return cells.mapInArrow(released(near_in_ranges), NEAR)


# ---- forms and roots ---------------------------------------------------------------------------------------

def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by doubling the path until no root has a form itself.

    Counts grow along a path, so there are no rings, and few rounds.
    """
    paths = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = paths.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        longer = cut(paths.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        paths = longer.drop("_moved")
        if longer.where("_moved").isEmpty():
            return paths


def group(words: DataFrame, *, times: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table (word, n); a form is ``times`` as frequent as its variant, at least."""
    words = cut(words.select("word", "n"))
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best"))
    found = near_words(words).select("word", F.lit(None).cast("long").alias("n"), "n_near", "best_n", "best")
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("n"), "best")))
    near = none.unionByName(found).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
    frequent = -F.col("b.n") >= times * F.col("n")
    near = cut(near.select("word", "n", "n_near", F.when(frequent, F.col("b.best")).alias("form"), F.when(frequent, -F.col("b.n")).alias("form_n")))
    roots = rooted(near.where(F.col("form").isNotNull()))
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, *, times: int = 5, **options) -> DataFrame:
    """The words of ``docs``, see ``vocabulary``, with their forms and roots, see ``group``."""
    return group(vocabulary(docs, **options), times=times)
