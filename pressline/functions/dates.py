"""Date text -> DATE and display text, as columns.

Text is taken apart with regular expressions and put together as
``yyyy-MM-dd`` for ``try_cast``: invalid days become NULL, also in ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressline import fixed_values as fv
from pressline.functions.text import blank_to_null, col, let, strip

_ENGLISH = [
    "january", "february", "march", "april", "may", "june", "july", "august",
    "september", "october", "november", "december",
]
_D = r"(3[01]|[12]\d|0[1-9]|[1-9])"
_M = r"(1[0-2]|0[1-9]|[1-9])"
_Y = r"(\d{4})"
_NAME = "(" + "|".join(_ENGLISH) + ")"
_ABBR = "(" + "|".join(m[:3] for m in _ENGLISH) + ")"

# (pattern, group of day, month, year); the month group may hold a name
_BASIC_FORMATS = [
    (rf"^{_D}/{_M}/{_Y}$", 1, 2, 3),
    (rf"^{_D}\.{_M}\.{_Y}$", 1, 2, 3),
    (rf"^{_D}\.{_M}\.{_Y}\.$", 1, 2, 3),
    (rf"(?i)^{_D}\s+{_NAME},\s+{_Y}$", 1, 2, 3),
    (rf"(?i)^{_D}\s+{_ABBR}\s+{_Y}$", 1, 2, 3),
    (rf"(?i)^{_NAME}\s+{_D},\s+{_Y}$", 2, 1, 3),
    (rf"^{_Y}-{_M}-{_D}$", 3, 2, 1),
]
_CASCADE_FORMATS = [
    (rf"^{_Y}-{_M}-{_D}$", 3, 2, 1),
    (rf"^{_D}\.{_M}\.{_Y}$", 1, 2, 3),
    (rf"^{_D}/{_M}/{_Y}$", 1, 2, 3),
    (rf"(?i)^{_NAME}\s+{_D},\s+{_Y}$", 2, 1, 3),
    (rf"(?i)^{_D}\s+{_NAME}\s+{_Y}$", 1, 2, 3),
    (rf"^{_Y}-{_M}-{_D}T\d{{1,2}}:\d{{1,2}}:\d{{1,2}}(?:Z|[+-]\d{{2}}:?\d{{2}})?$", 3, 2, 1),
]
_ISO = (
    r"^(\d{4})-?(\d{2})-?(\d{2})"
    r"(?:.(?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d(?:[.,]\d+)?)?)?"
    r"(?:Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)?)?$"
)


def _ymd(y: Column, m: Column, d: Column) -> Column:
    text = F.concat(F.lpad(y, 4, "0"), F.lit("-"), F.lpad(m, 2, "0"), F.lit("-"), F.lpad(d, 2, "0"))
    fits = (F.length(y) <= 4) & (F.length(m) <= 2) & (F.length(d) <= 2) & y.rlike("[1-9]")
    return F.when(fits, text).try_cast("date")


def _month_number(m: Column) -> Column:
    """English month name or abbreviation -> number; digits pass through."""
    key = F.lower(F.substring(m, 1, 3))
    out = F.when(m.rlike(r"^\d"), m)
    for i, name in enumerate(_ENGLISH, 1):
        out = out.when(key == name[:3], str(i))
    return out


def _try_format(s: Column, fmt: tuple[str, int, int, int]) -> Column:
    pattern, d, m, y = fmt
    month = F.regexp_extract(s, pattern, m)
    if _NAME in pattern or _ABBR in pattern:
        month = _month_number(month)
    return F.when(
        s.rlike(pattern),
        _ymd(F.regexp_extract(s, pattern, y), month, F.regexp_extract(s, pattern, d)),
    )


def _month_name_parts(s: Column, months, day_pattern: str) -> Column:
    """struct(day, month, year) of the first listed month named in the text."""
    low = F.lower(s)
    year = F.regexp_extract(s, r"\d{4}", 0)
    tries = []
    for name, number in months:
        day = F.regexp_extract(low, day_pattern + name, 1)
        tries.append(
            F.when(
                F.contains(low, F.lit(name)) & (day != "") & (year != ""),
                F.struct(day.alias("d"), F.lit(str(number)).alias("m"), year.alias("y")),
            )
        )
    return F.coalesce(*tries)


def display_date(d: Column) -> Column:
    return F.date_format(d, "dd.MM.yyyy")


def iso_date(c: Column | str) -> Column:
    s = col(c)
    return F.when(
        s.rlike(_ISO),
        _ymd(F.regexp_extract(s, _ISO, 1), F.regexp_extract(s, _ISO, 2), F.regexp_extract(s, _ISO, 3)),
    )


def date_of_display(c: Column | str) -> Column:
    """DATE behind a ``dd.MM.yyyy`` text, NULL for anything else."""
    p = r"^(\d{2})\.(\d{2})\.(\d{4})$"
    c = col(c)
    return F.when(
        c.rlike(p), _ymd(F.regexp_extract(c, p, 3), F.regexp_extract(c, p, 2), F.regexp_extract(c, p, 1))
    )


def date_in_url(url: Column | str) -> Column:
    """``/yyyy/mm/dd/`` in a URL as ``dd.MM.yyyy`` text, else NULL."""
    p, u = r"/(\d{4})/(\d{2})/(\d{2})/", col(url)
    return F.when(
        u.rlike(p),
        F.concat_ws(".", F.regexp_extract(u, p, 3), F.regexp_extract(u, p, 2), F.regexp_extract(u, p, 1)),
    )


def parse_date_basic(df: DataFrame, raw: str, *, date: str = "date", text: str = "date_text") -> DataFrame:
    """Month names, then seven formats, then the first three numbers as d, m, y.

    Adds ``date`` (DATE) and ``text`` (``dd.MM.yyyy``, or the raw text where it
    cannot be read).  A named month with an impossible day gives NULL and stops
    there.
    """
    step = let(df, _s=strip(raw))
    s = F.col("_s")
    step = let(
        step,
        _named=F.when(s.rlike(r"\p{L}{5}"), _month_name_parts(s, fv.MONTHS_BASIC, r"(\d+)\.?\s+")),
        _numbers=F.transform(
            F.regexp_extract_all(s, F.lit(r"\d+"), F.lit(0)),
            lambda d: F.regexp_replace(d, r"^0+(?=\d)", ""),
        ),
    )
    numbers, named = F.col("_numbers"), F.col("_named")
    third = F.get(numbers, F.lit(2))
    year = F.when(F.length(third) <= 2, (third.try_cast("int") + 2000).cast("string")).otherwise(third)
    by_numbers = _ymd(year, F.get(numbers, F.lit(1)), F.get(numbers, F.lit(0)))
    parsed = F.when(named.isNotNull(), _ymd(named["y"], named["m"], named["d"])).otherwise(
        F.coalesce(*[_try_format(s, f) for f in _BASIC_FORMATS], by_numbers)
    )
    done = let(step, _parsed=parsed).drop("_s", "_named", "_numbers")
    shown = F.coalesce(display_date(F.col("_parsed")), F.col(raw))
    return done.withColumn(text, shown).withColumn(date, F.col("_parsed")).drop("_parsed")


def parse_date_iso_first(df: DataFrame, raw: str, *, date: str = "date", text: str = "date_text") -> DataFrame:
    """ISO, then formats, then month names (unchecked), else the text itself.

    ``text`` may hold an impossible day such as ``31.02.2024``; ``date`` is then
    NULL.
    """
    step = let(df, _s=strip(raw))
    s = F.col("_s")
    step = let(step, _date=F.coalesce(iso_date(s), *[_try_format(s, f) for f in _CASCADE_FORMATS]))
    unread = F.col("_date").isNull() & s.rlike(r"\p{L}{5}")
    step = let(step, _named=F.when(unread, _month_name_parts(s, fv.MONTHS_BOTH_FORMS, r"(\d{1,2})\.?\s*")))
    named = F.col("_named")
    named_text = F.concat_ws(".", F.lpad(named["d"], 2, "0"), F.lpad(named["m"], 2, "0"), named["y"])
    shown = F.coalesce(display_date(F.col("_date")), F.when(named.isNotNull(), named_text), blank_to_null(s))
    done = let(step, _shown=shown).drop("_s", "_named", "_date")
    out = done.withColumn(date, date_of_display("_shown")).withColumn(text, F.col("_shown"))
    return out.drop("_shown")
