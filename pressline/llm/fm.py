"""Second-order factorisation machine over hashed features.

    score(x) = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2))

The pairwise term costs one pass over the features of a text (sum-of-squares identity).
Features are computed on the executors; the model is fitted on a bounded sample of labelled
texts (``max_rows``), whose hashed features alone come to the driver, and has a fixed size, so
it can be sent to every task.  Learned are the features whose share differs between the labels by a
two-sample test (``MIN_Z``), the strongest ``MAX_FEATURES`` of them, and frequent features that differ
only beside another one: a pair's share must differ more clearly than those of its two members.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressline.llm.common import driver_released, id_as_text, id_as_was, id_sample, released, text_rows

BITS = 17
FACTORS = 8
MAX_ROWS = 8192
MAX_FEATURES = 8192
MIN_Z = 3.0
#: most frequent features that are looked at in pairs, in how many texts they must be, and when a pair counts
PAIRED = 1024
MIN_PAIRED = 20
MIN_PAIR_Z = 6.0
MIN_GAIN = 2.0
CACHED_NAMES = 60_000

#: gives the features of a text as (names with weight 1/sqrt(their number), names with weight 1)
Features = Callable[[str], tuple[set[str], list[str]]]


class Hasher:
    """Hashed places of names, behind a bounded cache."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, names) -> np.ndarray:
        known = self.known
        if len(known) > CACHED_NAMES:
            known.clear()
        for n in names:
            if n not in known:
                known[n] = zlib.crc32(n.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)
        return np.fromiter((known[n] for n in names), np.int32, len(names))


def vector(hasher: Hasher, features: Features, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed places and weights of a text; names that meet in one place count once."""
    words, marks = features(text)
    a, b = np.unique(hasher(words)), np.unique(hasher(marks))
    b = np.setdiff1d(b, a, assume_unique=True)
    weight = np.float32(1 / np.sqrt(max(1, len(a))) * 4)
    return np.concatenate([a, b]), np.concatenate([np.full(len(a), weight, np.float32), np.ones(len(b), np.float32)])


@dataclass
class Model:
    w0: float
    w: np.ndarray
    v: np.ndarray

    def scores(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Probability of label 1 for a batch of feature vectors, in linear time."""
        sizes = np.array([len(i) for i, _ in vectors], np.int64)
        out = np.full(len(vectors), self.w0, np.float64)
        if sizes.sum():
            idx, x = (np.concatenate(p) for p in zip(*vectors, strict=True))
            filled = np.flatnonzero(sizes)
            starts = (np.cumsum(sizes) - sizes)[filled]
            vx = self.v[idx] * x[:, None]
            s, q = np.add.reduceat(vx, starts), np.add.reduceat(vx * vx, starts)
            out[filled] += np.add.reduceat(self.w[idx] * x, starts) + 0.5 * (s * s - q).sum(1)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def apart(ones: np.ndarray, zeros: np.ndarray, totals: list[int]) -> np.ndarray:
    """Two-sample statistic of how clearly a share differs between the labels, from the counts under label 1 and label 0."""
    both = (ones + zeros + 1.0) / (totals[0] + totals[1] + 2.0)
    return np.abs(ones / totals[1] - zeros / totals[0]) / np.sqrt(both * (1 - both) * (1 / totals[0] + 1 / totals[1]))


def paired(rows: list[tuple[int, np.ndarray, np.ndarray]], counts: np.ndarray, z: np.ndarray, totals: list[int]) -> np.ndarray:
    """Frequent features that tell the labels apart together with another one, and better than either alone."""
    share = counts / max(1, len(rows))
    frequent = np.flatnonzero((counts >= MIN_PAIRED) & (share <= 0.5))
    frequent = np.sort(frequent[np.argsort(-counts[frequent], kind="stable")[:PAIRED]])
    if len(frequent) < 2:
        return frequent[:0]
    place = np.full(len(counts), -1)
    place[frequent] = np.arange(len(frequent))
    together = []
    for y in (0, 1):
        mine = [place[r[1]] for r in rows if r[0] == y]
        found = np.zeros((len(mine), len(frequent)), np.float32)
        for k, at in enumerate(mine):
            found[k, at[at >= 0]] = 1
        together.append((found.T @ found).astype(np.float64))
    pair = apart(together[1], together[0], totals)
    alone = z[frequent]
    better = (pair >= MIN_PAIR_Z) & (pair >= np.maximum(alone[:, None], alone) + MIN_GAIN)
    np.fill_diagonal(better, False)
    return frequent[better.any(1)]


def chosen(rows: list[tuple[int, np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """Mask of the features that are learned: those whose share differs between the labels, and those that differ in pairs."""
    totals = [max(1, sum(r[0] == y for r in rows)) for y in (0, 1)]
    df = [np.bincount(np.concatenate([np.zeros(0, np.int32), *(r[1] for r in rows if r[0] == y)]), minlength=size) for y in (0, 1)]
    z = apart(df[1], df[0], totals)
    order = np.argsort(-z, kind="stable")[:MAX_FEATURES]
    known = np.zeros(size, bool)
    known[order[z[order] >= MIN_Z]] = True
    known[paired(rows, df[0] + df[1], z, totals)] = True
    return known


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], *, epochs: int = 12, rate: float = 0.15, l2: float = 1e-3,
        positive_weight: float = 1.0, seed: int = 7) -> Model:
    """Adagrad over small batches. Without rows every score is 0.5."""
    size, rng = 1 << BITS, np.random.default_rng(seed)
    w, v = np.zeros(size, np.float32), rng.normal(0, 0.02, (size, FACTORS)).astype(np.float32)
    if not rows:
        return Model(0.0, w, np.zeros_like(v))
    known = chosen(rows, size)
    v[~known] = 0
    # one more feature that every row has, so that no row is empty
    rows = [(y, np.append(i[known[i]], size), np.append(x[known[i]], np.float32(1))) for y, i, x in rows]
    w, v = np.append(w, np.float32(0)), np.vstack([v, np.zeros((1, FACTORS), np.float32)])
    share = np.clip(np.mean([r[0] for r in rows]), 0.02, 0.98)
    w0, g0 = float(np.log(share / (1 - share))), 1.0
    gw, gv = np.full(size + 1, 0.1, np.float32), np.full((size + 1, FACTORS), 0.1, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            part = [rows[k] for k in order[at : at + 64]]
            y = np.array([r[0] for r in part], np.float32)
            sizes = np.array([len(r[1]) for r in part])
            starts = np.cumsum(sizes) - sizes
            idx, x = np.concatenate([r[1] for r in part]), np.concatenate([r[2] for r in part])
            vx = v[idx] * x[:, None]
            s, q = np.add.reduceat(vx, starts), np.add.reduceat(vx * vx, starts)
            z = w0 + np.add.reduceat(w[idx] * x, starts) + 0.5 * (s * s - q).sum(1)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * np.where(y > 0, positive_weight, 1.0).astype(np.float32)
            slope = np.repeat(err, sizes) * x
            by = np.argsort(idx, kind="stable")
            places, first = np.unique(idx[by], return_index=True)
            dw = np.add.reduceat(slope[by], first) + l2 * w[places]
            dv = np.add.reduceat((slope[:, None] * (np.repeat(s, sizes, 0) - vx))[by], first) + l2 * v[places]
            keep = places < size  # the common feature only fills empty rows
            places, dw, dv = places[keep], dw[keep], dv[keep]
            gw[places] += dw * dw
            gv[places] += dv * dv
            w[places] -= rate * dw / np.sqrt(gw[places])
            v[places] -= rate * dv / np.sqrt(gv[places])
            d0 = float(err.sum())
            g0 += d0 * d0
            w0 -= rate * d0 / g0**0.5
    return Model(w0, w[:-1], v[:-1])


def train(docs: DataFrame, labels: DataFrame, features: Features, *, label_col: str, id_col: str = "doc_id",
          text_col: str = "text", max_rows: int = MAX_ROWS, **options) -> Model:
    """Fit on at most ``max_rows`` labelled texts, chosen by a hash of the id; null labels don't count."""
    rows = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("y")).where("y is not null and doc_id is not null")
    sample = id_sample(rows.groupBy("doc_id").agg(F.max("y").alias("y")), max_rows)
    texts = text_rows(docs, id_col, text_col).join(F.broadcast(sample), "doc_id")  # max_rows bounds it

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            found = [vector(hasher, features, t) for t in batch.column("text").to_pylist()]
            parts = [pa.array([p[k].tobytes() for p in found], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), *parts], names=["doc_id", "y", "i", "x"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    got = texts.mapInArrow(released(vectors), f"doc_id {kind}, y int, i binary, x binary").collect()
    got.sort(key=lambda r: (str(r["doc_id"]), r["i"], r["x"]))  # the order of the tasks must not matter
    model = fit([(r["y"], np.frombuffer(r["i"], np.int32), np.frombuffer(r["x"], np.float32)) for r in got], **options)
    del got
    driver_released(docs.sparkSession)
    return model


def score(df: DataFrame, model: Model, features: Features, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score double) for every whole text; null texts score as empty ones."""
    rows = text_rows(df, id_col, text_col)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, fitted = Hasher(), sent.value
        for batch in batches:
            found = fitted.scores([vector(hasher, features, t) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return id_as_was(id_as_text(rows).mapInArrow(released(scored), "doc_id string, score double"), kind)


def keep(df: DataFrame, model: Model, features: Features, *, text_col: str = "text", at_least: float = 0.5) -> DataFrame:
    """The rows of the input, all columns as they are, whose text scores at least so much; only the text goes through Python."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher, fitted = Hasher(), sent.value
        for batch in batches:
            yield pa.array(fitted.scores([vector(hasher, features, t or "") for t in batch.to_pylist()]), pa.float64())

    @F.arrow_udf("double")
    def udf(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return released(scored)(texts)

    return df.where(udf(F.col(f"`{text_col}`")) >= at_least)
