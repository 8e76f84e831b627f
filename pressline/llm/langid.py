"""Language identification with string kernels.

The kernel of two texts blends presence kernels of the letter n-grams of orders 1 to 4: for each
order the number of n-grams that both texts have, over the geometric mean of the numbers that
each has, averaged over the orders.  n-grams are hashed, and the kernel looks at the
``VOCABULARY`` hashed n-grams whose share varies most between the texts of the sample.
``LANDMARKS`` sampled texts, dealt over the languages, span the Nystroem space
K(x, L) K(L, L)^(-1/2), in which one-versus-rest kernel ridge regression gives a line for each
language; texts are scored in batches by two matrix products.

Cases: null texts and texts without letters are ``und`` with score 0; repeated rows get a row each;
an empty table gives no rows; without texts to learn from every text is ``und``; rows without a
language are not learned from; extra columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressline.llm.common import id_as_text, id_as_was, id_sample, text_rows

ORDERS = 4
BITS = 16
VOCABULARY = 8192
LANDMARKS = 128
MAX_ROWS = 256  # sampled texts of a language
RIDGE = 1e-2
BATCH = 128

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point: 1 for letters and the marks on them."""
    if not _LETTERS:
        table = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            if unicodedata.category(chr(c))[0] in "LM":
                table[c] = 1
        _LETTERS.append(table)
    return _LETTERS[0]


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def ngrams(text: str) -> np.ndarray:
    """Mask over orders x hash places: which letter n-grams the whole text has."""
    size = 1 << BITS
    mask = np.zeros(ORDERS * size, bool)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    known = letters()[np.minimum(codes, 0x10FFFF)] == 1
    codes = np.where(known, codes, np.uint32(32))
    if len(codes) > 1:  # a run of other characters is one space
        codes = codes[~((codes == 32) & (np.insert(codes[:-1], 0, 0) == 32))]
    rolled = codes * np.uint32(2654435761)
    for n in range(ORDERS):
        if n:
            rolled = rolled[:-1] * np.uint32(16777619) ^ codes[n:] * np.uint32(2654435761)
        mask[n * size + ((rolled >> np.uint32(7)) & np.uint32(size - 1))] = True
    return mask


@dataclass
class Model:
    langs: list[str]
    vocabulary: np.ndarray  # places, ordered by order of the n-grams
    bounds: np.ndarray  # where each order begins in the vocabulary
    landmarks: np.ndarray
    weights: np.ndarray

    def predict(self, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language and a score from 0 to 1 for each mask over the vocabulary."""
        out = normalised(masks, self.bounds) @ self.landmarks.T @ self.weights
        best = out.argmax(1)
        e = np.exp(4 * (out - out.max(1, keepdims=True)))
        return best, (e / e.sum(1, keepdims=True))[np.arange(len(best)), best]


def normalised(masks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows whose products are the blended presence kernel."""
    x = masks.astype(np.float32)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        x[:, a:b] /= np.sqrt(ORDERS * np.maximum(1, x[:, a:b].sum(1, keepdims=True)))
    return x


def fit(rows: list[tuple[str, np.ndarray]]) -> Model | None:
    """rows: (language, places of the text's n-grams)."""
    if not rows:
        return None
    langs = sorted({r[0] for r in rows})
    share = np.zeros((len(langs), ORDERS << BITS), np.float32)
    for k, lang in enumerate(langs):
        own = [p for x, p in rows if x == lang]
        for places in own:
            share[k, places] += 1 / len(own)
    spread = share.std(0) if len(langs) > 1 else share[0]
    vocabulary = np.sort(np.argsort(-spread, kind="stable")[:VOCABULARY])
    bounds = np.searchsorted(vocabulary, np.arange(ORDERS + 1) << BITS)
    masks = np.zeros((len(rows), len(vocabulary)), bool)
    for n, (_, places) in enumerate(rows):
        masks[n] = np.isin(vocabulary, places)
    x = normalised(masks, bounds)
    groups = [[n for n, r in enumerate(rows) if r[0] == lang] for lang in langs]
    each = max(1, LANDMARKS // len(langs))
    chosen = [n for g in groups for n in g[:each]]
    landmarks = x[chosen]
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    phi = (x @ landmarks.T).astype(np.float64) @ root
    y = np.where(np.array([r[0] for r in rows])[:, None] == np.array(langs)[None], 1.0, -1.0)
    weights = np.linalg.solve(phi.T @ phi + RIDGE * len(rows) * np.eye(len(chosen)) / 100, phi.T @ y)
    return Model(langs, vocabulary, bounds, landmarks, (root @ weights).astype(np.float32))


def train(docs: DataFrame, *, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS) -> Model | None:
    """Fit on at most ``max_rows`` texts of each language, chosen by a hash of the id."""
    named = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{lang_col}`").alias("lang"))
    sample = id_sample(named.where("lang is not null and doc_id is not null").distinct(), max_rows, "lang")
    texts = text_rows(docs, id_col, text_col).join(F.broadcast(sample), "doc_id")  # bounded by max_rows and the languages

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[[has_letter(t) for t in batch["text"]]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang": batch["lang"], "places": [np.flatnonzero(ngrams(t)).astype("<i4").tobytes() for t in batch["text"]]})

    kind = texts.schema["doc_id"].dataType.simpleString()
    got = texts.mapInPandas(places, f"doc_id {kind}, lang string, places binary").collect()
    got.sort(key=lambda r: (r["lang"], str(r["doc_id"]), r["places"]))
    return fit([(r["lang"], np.frombuffer(r["places"], "<i4")) for r in got])


def predict(df: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every whole text."""
    rows = text_rows(df, id_col, text_col)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitted = sent.value
        for batch in batches:
            texts = list(batch["text"])
            langs, scores = ["und"] * len(texts), np.zeros(len(texts))
            lettered = [n for n, t in enumerate(texts) if has_letter(t)] if fitted else []
            for at in range(0, len(lettered), BATCH):
                part = lettered[at : at + BATCH]
                best, found = fitted.predict(np.stack([ngrams(texts[n])[fitted.vocabulary] for n in part]))
                for n, b, s in zip(part, best, found, strict=True):
                    langs[n], scores[n] = fitted.langs[b], s
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": langs, "score": scores})

    kind = rows.schema["doc_id"].dataType.simpleString()
    return id_as_was(id_as_text(rows).mapInPandas(predicted, "doc_id string, lang_pred string, score double"), kind)
