"""Search for many terms at once: one pass over a text, whatever the number of terms and lists.

Built-in functions take one scan of the text for each term, or one pattern that tries its branches at
every place.  Here all terms of all lists make one Aho-Corasick automaton; texts reach it in Arrow
batches and only the counts come back.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import ahocorasick
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from pressline.functions.text import col

# ship the search with the task, so executors need no installed copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Lists = tuple[tuple[str, tuple[str, ...]], ...]


class TermSearch:
    """The automaton over all different terms of the lists."""

    def __init__(self, lists: Lists) -> None:
        numbers = {t: k for k, t in enumerate(dict.fromkeys(t for _, terms in lists for t in terms))}
        self.members = [frozenset(numbers[t] for t in terms) for _, terms in lists]
        self.always = {k for t, k in numbers.items() if not t}
        self.found = ahocorasick.Automaton()
        for term, k in numbers.items():
            if term:
                self.found.add_word(term, k)
        self.found.make_automaton()

    def counts(self, texts: Sequence[str | None]) -> list[list[int | None]]:
        """For each list, how many of its different terms occur in each text as substrings; the empty term occurs in every text."""
        rows = []
        for text in texts:
            if text is None:
                rows.append([None] * len(self.members))
                continue
            seen = {k for _, k in self.found.iter(text)} | self.always if text and len(self.found) else self.always
            rows.append([len(seen & m) for m in self.members])
        return [list(c) for c in zip(*rows)] if rows else [[] for _ in self.members]


def terms_in(c: Column | str, **lists: Sequence[str]) -> Column:
    """struct with a count for each named list: its different terms that occur in the text; NULL counts for a NULL text.

    Use it through ``let``, so that several rules on the counts share one pass; searches of one ``let`` share
    a Python worker too.
    """
    fixed: Lists = tuple((name, tuple(terms)) for name, terms in lists.items())
    kind = ", ".join(f"{name} bigint" for name in lists)
    made: list[TermSearch] = []  # each task has its own copy of this list

    @F.arrow_udf(f"struct<{kind.replace(' bigint', ': bigint')}>")
    def search(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(TermSearch(fixed))
        counts = made[0].counts(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()) for n in counts], names=[name for name, _ in fixed])

    return search(col(c))
