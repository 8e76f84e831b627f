"""Record text <-> article columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressline import fixed_values as fv
from pressline.functions.text import col, contains_any, from_na, na, strip
from pressline.params import Blacklist, Site

_KEY = dict(fv.RECORD_KEYS)


def _header(field: str) -> str:
    return _KEY[field] + ": "


def mask_subtitle(subtitle: Column | str, bl: Blacklist) -> Column:
    """NULL where the subtitle holds a blacklisted phrase."""
    s = col(subtitle)
    return F.when(~F.coalesce(contains_any(s, bl.subtitles), F.lit(False)), s)


def record_text(site: Site, *, subtitle: Column | str = "subtitle") -> Column:
    """Marker, eight header lines, blank line, body, blank line."""
    shown = {
        "source": F.lit(site.domain), "overline": F.lit(fv.MISSING),
        "subtitle": na(subtitle, fv.MISSING),
    }
    lines = [
        F.concat(F.lit(_header(f)), shown[f] if f in shown else na(f, fv.MISSING))
        for f, _ in fv.RECORD_KEYS
    ]
    return F.concat(
        F.lit(fv.RECORD_MARKER + "\n"), F.concat_ws("\n", *lines),
        F.lit("\n\n"), F.coalesce("content", F.lit("")), F.lit("\n\n"),
    )


def render_records(df: DataFrame, *, site: Site = Site(), bl: Blacklist = Blacklist(),
                   extracted: bool = False) -> DataFrame:
    """Add ``raw``: the record text, NULL for an article that is not written.

    NULL stands for the missing mark: an article whose title is not known is
    written with that mark, one with a blank title or without a body is not.
    Extracted articles must have no ``error``, and keep their subtitle as it is.
    """
    if extracted:
        written, subtitle = F.coalesce("error", F.lit("")) == "", F.col("subtitle")
    else:
        written = (na("title", fv.MISSING) != "") & (na("content", fv.MISSING) != fv.MISSING)
        subtitle = mask_subtitle("subtitle", bl)
    return df.withColumn("raw", F.when(written, record_text(site, subtitle=subtitle)))


def with_marker(raw: Column | str) -> Column:
    """Put the marker back in front of a chunk that lost it in the split."""
    raw = col(raw)
    return F.when(F.startswith(raw, F.lit(fv.RECORD_MARKER)), raw).otherwise(
        F.concat(F.lit(fv.RECORD_MARKER), raw)
    )


def _header_value(raw: Column, field: str, line_start: bool) -> Column:
    anchor = "(?m)^" if line_start else ""
    value = strip(F.regexp_extract(raw, anchor + re.escape(_header(field)) + "(.+)", 1))
    return F.when(raw.rlike(anchor + re.escape(_header(field)) + "."), value)


def record_header(raw: Column | str, field: str) -> Column:
    """Value of a header at a line's start, as ``parse_records`` reads it."""
    return _header_value(col(raw), field, True)


def record_url(raw: Column | str) -> Column:
    """URL of a record text, NULL if it has none."""
    return F.nullif(F.coalesce(_header_value(col(raw), "url", False), F.lit("")), F.lit(""))


def _body(raw: Column, compat: bool) -> Column:
    author = re.escape(_header("author"))
    if compat:
        # greedy up to the last blank line that has text behind it
        pattern = f"(?s){author}.+\n\n(.+)"
    else:
        pattern = f"(?s)(?:^|\n){author}[^\n]*\n\n(.+)"
    return F.when(raw.rlike(pattern), strip(F.regexp_extract(raw, pattern, 1)))


def parse_records(df: DataFrame, *, raw: str = "raw", compat: bool = False) -> DataFrame:
    """Add title, subtitle, category, date, author, url and content (NULL = missing).

    A header counts at the start of a line only, and the body is everything
    behind the first blank line after the headers.  ``compat`` reads headers
    anywhere (so the title key also matches inside the overline key) and takes
    the text behind the last blank line.
    """
    r = F.col(raw)
    fields = ["title", "subtitle", "category", "date", "author", "url"]
    return df.select(
        *[c for c in df.columns if c not in (*fields, "content")],
        *[from_na(_header_value(r, f, not compat), fv.MISSING).alias(f) for f in fields],
        from_na(_body(r, compat), fv.MISSING).alias("content"),
    )


def markers_in(text: Column | str, marker: str = fv.RECORD_MARKER) -> Column:
    """How often the record marker occurs in a text."""
    return F.regexp_count(col(text), F.lit(re.escape(marker)))


def marker_count(df: DataFrame, *, text: str = "raw", marker: str = fv.RECORD_MARKER) -> DataFrame:
    """How often the record marker occurs in an archive text."""
    n = markers_in(text, marker)
    return df.agg(F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("markers"))


