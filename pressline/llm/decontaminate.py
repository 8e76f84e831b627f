"""Benchmark decontamination with spaced seeds; DataFrame functions only.

A mask fixes which words of a window count; the others are ignored, so a substituted word at an
ignored place does not break a hit.  Hashes of all masked windows of the benchmark meet those of the
texts in a join, and each hit is verified: all words that text and item have beside each other at the
hit's shift are compared one by one, and the longest stretch of which at least 80 % agree must hold
``MIN_WORDS`` words that do (nine tenths of a shorter item).

The masks miss no such stretch.  Of 32 words or more, one half is such a stretch, too; the shorter ones
hold one of 13 agreeing words and up to 3 others, 16 and 4, 20 and 5 or 24 and 6, and each of these, in
any order, has a window of one of the three masks (the tests go through them).

Texts are not shuffled: windows are hashed where the text is read, against the benchmark's hashes,
which are broadcast in parts of at most ``BROADCAST_SEEDS`` rows (a larger benchmark takes more
passes over the texts, not a larger broadcast).

Cases: words are runs of letters and digits, lower-cased; null and empty texts have none and no hits;
benchmark items under ``MIN_ITEM`` words are no evidence and are left out, and those too short for
the masks are searched as a whole; repeated rows (same id and text) count as one; empty tables give no
rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressline.llm.common import cut, text_rows

MASKS = ("111111", "101100111", "10101111")
MIN_ITEM = 5
MIN_WORDS = 13
LOSS = 4  # of a word that differs, to 1 for one that agrees: 80 % of a stretch agree if it gains no less than it loses
BROADCAST_SEEDS = 1_000_000


def words(text: Column) -> Column:
    """Hashes of the words of a text."""
    return F.transform(F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), ""), lambda w: F.xxhash64(w))


def seed(h: Column, at: Column, mask: str) -> Column:
    return F.xxhash64(F.lit(mask), *[F.get(h, at + k) for k, m in enumerate(mask) if m == "1"])


def seeds(rows: DataFrame, masks: tuple[str, ...], *keep: str) -> DataFrame:
    """(.., n, at, mask, seed) for each place and mask whose window lies in the words ``h``.

    The words stay behind: what follows carries the hashes only.
    """
    shortest = min(map(len, masks))
    places = rows.where(F.size("h") >= shortest).select(*keep, "h", F.explode_outer(F.sequence(F.lit(0), F.size("h") - shortest)).alias("at"))
    each = F.array(*[F.when(F.col("at") + len(m) <= F.size("h"), seed(F.col("h"), F.col("at"), m)) for m in masks])
    hashed = places.select(*keep, F.size("h").alias("n"), "at", each.alias("seeds"))
    return hashed.select(*keep, "n", "at", F.posexplode("seeds").alias("mask", "seed")).where("seed is not null")


def steps(scores: Column, better) -> Column:
    """The running best (``better`` of two) of the scores, from the first on."""
    first = F.slice(scores, 1, 1)
    rest = F.slice(scores, F.lit(2), F.size(scores) - 1)
    return F.aggregate(rest, first, lambda acc, x: F.concat(acc, F.array(better(F.element_at(acc, -1), x))))


def longest(same: Column) -> Column:
    """(start, end, n): the longest stretch of which at least 80 % agree, and how many of its words do.

    A word that agrees scores 1, another one less 4 (0.8 to 0.2), so a stretch stands if the running sum is no lower at its
    end than at its start.  Starts are tried at running minima, ends at running maxima from behind; both only move on.
    """
    sums = F.aggregate(same, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + F.when(x, 1).otherwise(-LOSS))))
    held = F.struct(sums.alias("s"), steps(sums, F.least).alias("low"), F.reverse(steps(F.reverse(sums), F.greatest)).alias("high"))

    def move(acc: Column, x: Column) -> Column:
        i, j = acc["i"], acc["j"]
        stands = F.get(x["low"], i) <= F.get(x["high"], j)
        gain = F.get(x["s"], j) - F.get(x["s"], i)
        more = stands & ((j - i > acc["end"] - acc["start"]) | ((j - i == acc["end"] - acc["start"]) & (gain > acc["gain"])))
        return F.struct((i + F.when(stands, 0).otherwise(1)).alias("i"), (j + F.when(stands, 1).otherwise(0)).alias("j"),
                        F.when(more, i).otherwise(acc["start"]).alias("start"), F.when(more, j).otherwise(acc["end"]).alias("end"), F.when(more, gain).otherwise(acc["gain"]).alias("gain"))

    zero = F.struct(*[F.lit(0).alias(n) for n in ("i", "j", "start", "end", "gain")])
    found = F.transform(F.array(held), lambda x: F.aggregate(F.sequence(F.lit(1), 2 * F.size(x["s"])), zero, lambda acc, _: move(acc, x)))[0]
    n = ((found["gain"] + LOSS * (found["end"] - found["start"])) / (LOSS + 1)).cast("int")
    return F.struct(found["start"].alias("start"), found["end"].alias("end"), n.alias("n"))


def overlaps(df: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
             item_text_col: str = "text", masks: tuple[str, ...] = MASKS, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, item_id, n_hits, n_words, first_word, last_word) for texts that hold a passage of an item."""
    rows = text_rows(df, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("h"))
    items = benchmark.select(F.col(f"`{item_col}`").alias("item_id"), words(F.coalesce(F.col(f"`{item_text_col}`"), F.lit(""))).alias("h")).where(F.size("h") >= MIN_ITEM)
    span = min((len(m) for m in masks if "0" not in m), default=max(map(len, masks)))  # from there on a whole item has a window
    short = [r["n"] for r in items.where(F.size("h") < span).select(F.size("h").alias("n")).distinct().collect()]
    whole = tuple("1" * n for n in sorted(short))  # at most span - MIN_ITEM of them
    every = masks + whole
    length = F.element_at(F.array(*[F.lit(len(m)) for m in every]), F.col("mask") + 1)
    seeded = seeds(items, every, "item_id").where((F.col("mask") < len(masks)) | ((F.col("at") == 0) & (F.col("n") == length)))
    seeded = seeded.select("item_id", F.col("at").alias("item_at"), F.col("mask").alias("item_mask"), "seed")
    parts = max(1, -(-seeded.count() // BROADCAST_SEEDS))
    met = None
    places = seeds(rows, every, "doc_id", "text_hash")
    for part in range(parts):
        side = seeded.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        one = places.join(F.broadcast(side), "seed").where("mask = item_mask").select("doc_id", "text_hash", "at", "mask", "item_id", "item_at")
        met = one if met is None else met.unionByName(one)
    # one row for each text, item and shift between them; few beside the texts, and only their texts are read again
    met = met.distinct().groupBy("doc_id", "text_hash", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).agg(F.count("*").alias("n_hits"))
    met = cut(met)
    texts = rows.join(met.select("doc_id", "text_hash").distinct().withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"}),
                      F.expr("doc_id <=> _id and text_hash = _hash"), "left_semi").dropDuplicates(["doc_id", "text_hash"])
    texts = texts.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    hits = met.join(texts, F.expr("doc_id <=> _id and text_hash = _hash")).join(items.select("item_id", F.col("h").alias("t")), "item_id")
    # the item's words that lie in the text at this shift, each beside its own
    low, high = F.greatest(F.lit(0), -F.col("shift")), F.least(F.size("t"), F.size("h") - F.col("shift"))
    beside = F.zip_with(F.slice("t", low + 1, high - low), F.slice("h", low + F.col("shift") + 1, high - low), lambda x, y: x == y)
    sides = hits.where(high > low).select("doc_id", "text_hash", "item_id", "n_hits", (low + F.col("shift")).alias("first"), F.size("t").alias("item_words"), beside.alias("same"))
    enough = F.least(F.lit(min_words), F.ceil(F.lit(0.9) * F.col("item_words")))
    sides = sides.where(F.size(F.filter("same", lambda x: x)) >= enough)
    found = sides.select("*", F.explode(F.array(longest(F.col("same")))).alias("best")).where(F.col("best.n") >= enough)
    return found.groupBy("doc_id", "text_hash", "item_id").agg(
        F.sum("n_hits").alias("n_hits"), F.max("best.n").alias("n_words"),
        F.min(F.col("first") + F.col("best.start")).alias("first_word"), F.max(F.col("first") + F.col("best.end") - 1).alias("last_word"))
