"""Category columns: ordered rule tables, the first match wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressline.functions.text import WS, col, first_rule, let, strip
from pressline.params import Categories, Site


def _segments(u: Column, table) -> Column:
    return first_rule(u, [([f"/{seg}/"], value) for seg, value in table])


def category_from_url(url: Column | str, cats: Categories) -> Column:
    """Path segment table, then keyword groups, then the default."""
    u = F.lower(col(url))
    return F.coalesce(
        _segments(u, cats.url_segments), first_rule(u, cats.url_keywords), F.lit(cats.default)
    )


def category_from_url_strict(url: Column | str, cats: Categories) -> Column:
    return _segments(F.lower(col(url)), cats.url_strict)


def similar_category(c: Column | str, cats: Categories) -> Column:
    """Nearest category by word stems."""
    return F.coalesce(first_rule(F.lower(col(c)), cats.stems), F.lit(cats.default))


def category_from_title(title: Column | str, cats: Categories) -> Column:
    return first_rule(F.lower(col(title)), cats.title)


def category_from_slug(url: Column | str, site: Site, cats: Categories) -> Column:
    """First path segment after the domain, named by table or title-cased."""
    pattern = site.domain.replace(".", r"\.") + r"/(?:category/)?([^/]+)/"
    u = col(url)
    slug = F.regexp_extract(u, pattern, 1)
    named = first_exact(slug, cats.url_segments)
    return F.when(slug != "", F.coalesce(named, title_case(F.replace(slug, F.lit("-"), F.lit(" ")))))


def first_exact(c: Column, table) -> Column:
    pairs = [x for key, value in dict(reversed(table)).items() for x in (F.lit(key), F.lit(value))]
    return F.try_element_at(F.create_map(*pairs), c)


def title_case(c: Column | str) -> Column:
    """Capital after every non-letter, like Python's ``str.title``.

    ``initcap`` only starts a new word at a space, so each run of letters is
    capitalised on its own.
    """
    runs = F.regexp_extract_all(F.lower(col(c)), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def standardize_category(df: DataFrame, cats: Categories, *, raw: str = "category_raw",
                         url: str = "url", out: str = "category") -> DataFrame:
    """Add ``out``: the standard category of a written category name.

    Exact name, then the parts of a multi-value name, then the name table
    (exact, then substring), then the URL.
    """
    r = F.col(raw)
    step = let(
        df,
        _low=strip(F.lower(r)),
        _by_url=category_from_url(url, cats),
        _parts=F.when(
            F.contains(r, F.lit(",")) | F.contains(r, F.lit(" i ")),
            F.transform(F.split(r, rf",|{WS}i{WS}"), strip_part),
        ),
    )
    mapped = F.transform(
        "_parts",
        lambda p: F.when(p.isin(*cats.standard), p).otherwise(
            F.nullif(similar_category(p, cats), F.lit(cats.default))
        ),
    )
    multi = F.get(F.filter(mapped, lambda m: m.isNotNull()), F.lit(0))
    named = first_exact(F.col("_low"), cats.names)
    inside = first_rule("_low", [([key], value) for key, value in cats.names])
    return step.withColumn(
        out,
        F.when(r.isNull() | (r == ""), F.col("_by_url"))
        .when(r.isin(*cats.standard), r)
        .otherwise(F.coalesce(multi, named, inside, F.col("_by_url"))),
    ).drop("_low", "_by_url", "_parts")


def strip_part(p: Column) -> Column:
    return strip(p)
