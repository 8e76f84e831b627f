"""String building blocks shared by every operator (all JVM-side columns)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that ``str.split()`` and ``str.strip()`` know: Unicode's, and the
# four separators 0x1c-0x1f.
WS_CHARS = "\t\n\x0b\f\r \x1c\x1d\x1e\x1f\x85\xa0" + "".join(
    chr(c) for c in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)
WS = r"(?U:[\s\x1c-\x1f])"
WS_RUN = r"(?U)[\s\x1c-\x1f]+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of white space on both ends."""
    return F.btrim(col(c), F.lit(WS_CHARS))


def blank_to_null(c: Column | str) -> Column:
    """NULL for a blank text; a computed text is computed once."""
    return F.get(F.filter(F.array(col(c)), lambda v: v != ""), F.lit(0))


def words(c: Column | str) -> Column:
    """Whitespace-separated words; blank text has none."""
    s = strip(c)
    return F.when(s != "", F.split(s, WS_RUN)).when(s == "", F.array().cast("array<string>"))


def literals(values: Iterable[str]) -> Column:
    """Literal array of texts without line breaks (folded to a constant)."""
    return F.split(F.lit("\n".join(values)), "\n")


def sql_text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def contains_any(c: Column | str, terms: Sequence[str]) -> Column:
    """True if any term occurs as a substring: one pattern, for short texts."""
    return col(c).rlike(any_of(terms)) if terms else F.lit(False)


def starts_with_any(c: Column | str, terms: Sequence[str]) -> Column:
    return col(c).rlike(f"^(?:{any_of(terms)})")


def count_contained(c: Column | str, terms: Sequence[str]) -> Column:
    """Number of distinct terms occurring as substrings.

    ``c`` should be a plain column: the search runs once per term.
    """
    c = col(c)
    return F.size(F.filter(literals(dict.fromkeys(terms)), lambda t: F.contains(c, t))).cast("bigint")


def any_of(terms: Iterable[str]) -> str:
    """Regex alternation of literal terms."""
    return "|".join(re.escape(t) for t in terms)


def first_rule(c: Column | str, rules: Sequence[tuple[Sequence[str], str]]) -> Column:
    """Value of the first rule with any term contained in ``c``, else NULL."""
    c = col(c)
    out = None
    for terms, value in rules:
        hit = F.contains(c, F.lit(terms[0])) if len(terms) == 1 else c.rlike(any_of(terms))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def clean_text(c: Column | str) -> Column:
    """Squeeze 3+ newlines to 2, then drop white space before punctuation."""
    squeezed = F.regexp_replace(col(c), r"\n{3,}", "\n\n")
    return F.regexp_replace(squeezed, WS_RUN + r"([.,;:!?])", "$1")


def na(c: Column | str, missing: str) -> Column:
    """Render NULL as the archive's missing mark."""
    return F.coalesce(col(c), F.lit(missing))


def from_na(c: Column | str, missing: str) -> Column:
    c = col(c)
    return F.when(c != missing, c)


def let(df, **columns: Column):
    """Add columns that are computed once, whatever uses them later.

    Catalyst substitutes plain aliases into filters above them, so an expensive
    column used by a filter would be computed again for each mention.  A
    one-element generator is a boundary that substitution does not cross.
    """
    one = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return df.select(*[c for c in df.columns if c not in columns], F.inline_outer(one))
