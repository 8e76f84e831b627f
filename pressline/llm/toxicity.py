"""Toxicity: a factorisation machine over hashed terms.

Terms are the words of a text and the beginnings of its words, so that one stem with many endings
is one term.  Pairwise interactions raise the score of terms that are harmful together, which
additive weights miss.  Labels, language, source and id never enter a score.

Cases: null and empty texts score as a text without terms; repeated rows get a row each; an empty
table gives no rows; without labelled rows every score is 0.5; extra columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from pressline.llm import fm

WORD = re.compile(r"\w+")
STEMS = (3, 4, 5)


def features(text: str) -> tuple[set[str], list[str]]:
    words = set(WORD.findall(text.lower()))
    stems = {"^" + s for n in STEMS for s in {w[:n] for w in words if len(w) > n}}
    return set(), [*words, *stems]


def train(docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", max_rows: int = fm.MAX_ROWS) -> fm.Model:
    return fm.train(docs, labels, features, label_col=label_col, max_rows=max_rows, positive_weight=2.0)


def score(df: DataFrame, model: fm.Model, **columns) -> DataFrame:
    return fm.score(df, model, features, **columns)
