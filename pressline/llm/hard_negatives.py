"""Hard negatives of anchors, by exact integer scores from residue matrix products.

The vectors are rounded to integers.  A block of anchors and a block of rows meet in one cell of a grid;
there the score matrix is computed once for each of several small primes, on centred residues in float32,
where every partial sum stays below 2**24 and is therefore exact.  Chinese remaindering gives the signed
integer scores back.  Each cell keeps the first few of every anchor; windows merge the cells.

* A row without id, label or vector, or with a null or non-finite component, takes no part.
* Vectors may differ in length; missing components count as 0, an empty vector scores 0 with all.
* Ties go to the smaller id.  A repeated row counts as often as it is there; equal anchors are searched
  once, unequal anchors of one id each for themselves.  Rows of an anchor's own id are never its partners.
* Columns other than the three named ones are not read.  No anchors, or no rows: an empty result.
* Scores must fit 64 bits; a table whose components are too large for that raises ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: a sum of this many products of centred residues must stay exact in float32
EXACT = 1 << 24
#: components in one product; longer vectors are multiplied in parts
DEPTH = 1024
#: rows and anchors that meet in one cell at most, and rows that make a cell worth a task of its own
CELL_ROWS = 65_536
CELL_ANCHORS = 4_096
TASK_ROWS = 512
#: scores held at once in a cell
SCORES = 1 << 20


def primes(depth: int, bound: int) -> list[int]:
    """Odd primes, the largest first, whose products of ``depth`` residues are exact and whose product exceeds 2 * bound."""
    top = 2 * int(np.sqrt(EXACT / depth)) + 1
    out, product = [], 1
    for p in range(top, 2, -1):
        if p % 2 and all(p % q for q in range(3, int(p**0.5) + 1, 2)):
            out.append(p)
            product *= p
            if product > 2 * bound:
                return out
    raise ValueError(f"scores up to {bound} need more primes than there are below {top}")


def centred(values: np.ndarray, p: int) -> np.ndarray:
    """Residues modulo ``p`` between -(p - 1) / 2 and (p - 1) / 2."""
    half = (p - 1) // 2
    return (values + half) % p - half


class ResidueMatrix:
    """Integer vectors as centred float32 residues, one matrix for each prime."""

    def __init__(self, values: np.ndarray, moduli: list[int]) -> None:
        self.moduli = moduli
        self.parts = [centred(values, p).astype(np.float32) for p in moduli]

    def products(self, other: ResidueMatrix, rows: slice) -> Iterator[np.ndarray]:
        """The score matrix of some rows modulo each prime, as 64-bit integers."""
        for p, a, b in zip(self.moduli, self.parts, other.parts, strict=True):
            a, total = a[rows], 0
            for k in range(0, max(1, a.shape[1]), DEPTH):
                total = total + (a[:, k : k + DEPTH] @ b[:, k : k + DEPTH].T).astype(np.int64)
            yield centred(total, p)

    def scores(self, other: ResidueMatrix, rows: slice) -> np.ndarray:
        """Exact scores by Chinese remaindering in mixed radix; centred digits give the signed value."""
        digits: list[np.ndarray] = []
        for k, rest in enumerate(self.products(other, rows)):
            p = self.moduli[k]
            for digit, q in zip(digits, self.moduli, strict=False):
                rest = centred((rest - digit) * pow(q, -1, p), p)
            digits.append(rest)
        value = digits[-1]
        for digit, q in zip(digits[-2::-1], self.moduli[len(digits) - 2 :: -1], strict=False):
            value = value * q + digit
        return value


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A column of integer lists as one matrix, short lists filled with 0."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), max(1, sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def pair_of(anchors: np.ndarray, rows: np.ndarray) -> tuple[ResidueMatrix, ResidueMatrix]:
    """Both sides in the residues that their own lengths require."""
    width = max(anchors.shape[1], rows.shape[1])
    anchors, rows = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (anchors, rows))
    longest = [int(np.ceil(np.sqrt((m.astype(np.float64) ** 2).sum(1).max(initial=0)))) + 1 for m in (anchors, rows)]
    moduli = primes(min(width, DEPTH), longest[0] * longest[1])
    return ResidueMatrix(anchors, moduli), ResidueMatrix(rows, moduli)


def first_of_each(groups: np.ndarray, k: int) -> np.ndarray:
    """Marks the first k entries of each run of equal values."""
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(groups) else np.zeros(0, int)
    sizes = np.diff(np.r_[starts, len(groups)])
    return np.arange(len(groups)) - np.repeat(starts, sizes) < k


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest allowed scores of each row, ties by the lower column."""
    low = np.iinfo(np.int64).min
    held = np.where(allowed, scores, low)
    if held.shape[1] > k:
        allowed = allowed & (held >= np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k, None])
    r, c = np.nonzero(allowed)
    order = np.lexsort((c, -scores[r, c], r))
    order = order[first_of_each(r[order], k)]
    return r[order], c[order]


def in_parts(n_anchors: int, n_rows: int) -> Iterator[slice]:
    step = max(1, SCORES // max(1, n_rows))
    for k in range(0, n_anchors, step):
        yield slice(k, k + step)


def by_id(rows: pa.Table) -> pa.Table:
    return rows.sort_by("id")


POSITIVES = "anchor_id long, anchor_key long, positive_id long, score long"
NEGATIVES = "anchor_id long, anchor_key long, place int, positive_id long, positive_score long, negative_id long, negative_score long"


def table(schema: str, columns: list[np.ndarray]) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.table([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[name for name, _ in fields])


def stacked(schema: str, found: list[list[np.ndarray]]) -> pa.Table:
    width = len(schema.split(", "))
    return table(schema, [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * width)


def positives_in_cell(n: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = []
        rows = by_id(rows)
        labels, kinds = rows["label"].to_numpy(), anchors["label"].to_numpy()
        for label in np.unique(kinds) if rows.num_rows else ():
            mine, theirs = anchors.take(np.flatnonzero(kinds == label)), rows.take(np.flatnonzero(labels == label))
            if not theirs.num_rows:
                continue
            a, b = pair_of(matrix(mine["v"]), matrix(theirs["v"]))
            ids, keys, others = mine["id"].to_numpy(), mine["key"].to_numpy(), theirs["id"].to_numpy()
            for part in in_parts(len(ids), len(others)):
                scores = a.scores(b, part)
                r, c = best(scores, ids[part, None] != others, n)
                found.append([ids[part][r], keys[part][r], others[c], scores[r, c]])
        return stacked(POSITIVES, found)

    return run


def negatives_in_cell(n: int, low: int, high: int):
    """Limits of the negative's score are percentages of the positive's."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = []
        rows = by_id(rows)
        if not (rows.num_rows and anchors.num_rows):
            return stacked(NEGATIVES, found)
        a, b = pair_of(matrix(anchors["v"]), matrix(rows["v"]))
        ids, keys, kinds = (anchors[x].to_numpy() for x in ("id", "key", "label"))
        others, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
        partners, theirs = matrix(anchors["positive_ids"]), matrix(anchors["positive_scores"])
        count = np.diff(anchors["positive_ids"].combine_chunks().offsets.to_numpy())
        for part in in_parts(len(ids), len(others)):
            scores = a.scores(b, part)
            different = (kinds[part, None] != labels) & (ids[part, None] != others)
            for j in range(partners.shape[1]):
                # 100 s >= low * p and 100 s <= high * p, in whole numbers
                least, most = -(-low * theirs[part, j] // 100), high * theirs[part, j] // 100
                within = different & (scores >= least[:, None]) & (scores <= most[:, None]) & (count[part, None] > j)
                some = np.flatnonzero(within.any(1))
                if not len(some):
                    continue
                r, c = best(scores[some], within[some], n)
                r = some[r]
                found.append([ids[part][r], keys[part][r], np.full(len(r), j), partners[part, j][r], theirs[part, j][r], others[c], scores[r, c]])
        return stacked(NEGATIVES, found)

    return run


def prepared(df: DataFrame, anchors: Column, scale: float, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, v, is_anchor) of the rows that take part, components as whole numbers."""
    whole = F.transform(F.col(f"`{vector_col}`").cast("array<double>"), lambda x: F.floor(x * F.lit(scale)))
    sound = F.forall(F.col(f"`{vector_col}`").cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    keep = F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & F.col(f"`{vector_col}`").isNotNull()
    return df.where(keep & F.coalesce(sound, F.lit(False))).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), whole.alias("v"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"))


def mine(
    df: DataFrame, *, anchors: Column, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` marks the rows that search.  A positive is one of the ``n_positives`` best rows of the
    anchor's label; a negative one of the ``n_negatives`` best rows of other labels whose score lies
    between ``low`` and ``high`` per cent of the positive's.  All anchors meet all rows in the cells of
    a grid, so that a cell's size is bounded and no side is broadcast.
    """
    rows = prepared(df, anchors, scale, id_col, vector_col, label_col)
    size = rows.agg(
        F.count("*").alias("n"), F.count_if("is_anchor").alias("a"), F.max(F.size("v")).alias("width"),
        F.max(F.array_max(F.transform("v", F.abs))).alias("top")).first()
    if (size["width"] or 0) * (size["top"] or 0) ** 2 >= 1 << 56 or (size["top"] or 0) >= 1 << 31:
        raise ValueError("the scores of these vectors do not fit 64 bits")
    parallel = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    down = max(1, -(-size["n"] // CELL_ROWS), min(parallel, -(-size["n"] // TASK_ROWS)))
    across = max(1, -(-size["a"] // CELL_ANCHORS))

    v = F.col("v").cast("array<int>").alias("v")
    searchers = rows.where("is_anchor").select("id", "label", v).withColumn("key", F.xxhash64("label", "v")).dropDuplicates(["id", "key"])
    dealt = rows.select("id", "label", v, (F.monotonically_increasing_id() % down).alias("_down")).withColumn(
        "_cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(across - 1)), lambda g: F.col("_down") * across + g))).drop("_down")

    def met(side: DataFrame, run, schema: str) -> DataFrame:
        group = F.pmod(F.xxhash64("id", "key"), F.lit(across))
        copies = side.withColumn("_cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(down - 1)), lambda r: r * across + group)))
        copies = copies.select(*(F.col(c).alias(c) for c in copies.columns))  # columns of its own: both sides come from the same rows
        return copies.groupBy("_cell").cogroup(dealt.groupBy("_cell")).applyInArrow(run, schema)

    def first(found: DataFrame, k: int, by: list[str], score: str, other: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc(score), other)
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    near = first(met(searchers, positives_in_cell(n_positives), POSITIVES), n_positives, ["anchor_id", "anchor_key"], "score", "positive_id")
    lists = near.groupBy(F.col("anchor_id").alias("id"), F.col("anchor_key").alias("key")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "positive_id", "score"))).alias("p"))
    searchers = searchers.join(lists, ["id", "key"]).select(
        "id", "label", "v", "key", F.col("p.positive_id").alias("positive_ids"), F.col("p.score").alias("positive_scores"))
    far = first(
        met(searchers, negatives_in_cell(n_negatives, low, high), NEGATIVES), n_negatives, ["anchor_id", "anchor_key", "place"], "negative_score", "negative_id")
    return far.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
