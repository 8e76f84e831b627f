"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Pairs of statistics (much punctuation with long words, say) and of statistics with words are
learned as low-rank interactions.  The metadata is what the text itself carries: its length and
its number of lines; labels, language, source and id never enter a score.

Cases: null and empty texts get the score of a text without words; repeated rows get a row each;
an empty table gives no rows; without labelled rows every score is 0.5; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame

from pressline.llm import fm

WORD = re.compile(r"\w+")
ODD = re.compile(r"[^\w\s.,;:'\"!?()-]")
UPPER = re.compile(r"[A-Z]")
DIGIT = re.compile(r"[0-9]")


def _bin(name: str, value: float, edges: tuple[float, ...]) -> str:
    return f"#{name}={sum(value >= e for e in edges)}"


SHARES = (0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9)


def features(text: str) -> tuple[set[str], list[str]]:
    """Words of a text, and its statistics in bins."""
    words = WORD.findall(text.lower())
    distinct, lines = set(words), text.split("\n")
    n, w = max(1, len(text)), max(1, len(words))
    top = max(Counter(words).values(), default=0)
    marks = [
        _bin("chars", len(text), (1, 20, 60, 150, 400, 1000, 4000, 16000, 64000)),
        _bin("lines", len(lines), (2, 4, 8, 16, 64, 256)),
        _bin("odd", len(ODD.findall(text)) / n, SHARES),
        _bin("upper", len(UPPER.findall(text)) / n, SHARES),
        _bin("digit", len(DIGIT.findall(text)) / n, SHARES),
        _bin("bang", text.count("!") / w, SHARES),
        _bin("pipe", text.count("|") / w, SHARES),
        _bin("stop", (text.count(".") + text.count("?")) / w, SHARES),
        _bin("distinct", len(distinct) / w, SHARES),
        _bin("top", top / w, SHARES),
        _bin("length", sum(map(len, words)) / w, (1, 2, 3, 4, 5, 6, 7, 8, 10, 14)),
        _bin("same", 1 - len(set(lines)) / len(lines), SHARES),
        _bin("short", sum(len(x) < 20 for x in lines) / len(lines), SHARES),
    ]
    return distinct, marks


def train(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", max_rows: int = fm.MAX_ROWS) -> fm.Model:
    return fm.train(docs, labels, features, label_col=label_col, max_rows=max_rows)


def score(df: DataFrame, model: fm.Model, **columns) -> DataFrame:
    return fm.score(df, model, features, **columns)


def keep(df: DataFrame, model: fm.Model, **options) -> DataFrame:
    return fm.keep(df, model, features, **options)
