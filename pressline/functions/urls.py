"""URL columns: joining, host, link kind, article test, blacklist tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressline import fixed_values as fv
from pressline.functions.terms import terms_in
from pressline.functions.text import any_of, col, contains_any, count_contained, let, starts_with_any
from pressline.params import Blacklist, Site

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"


def host(url: Column | str) -> Column:
    """Authority part of an absolute URL ('' if there is none)."""
    return F.regexp_extract(col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def _without_dot_segments(path: Column) -> Column:
    """Resolve ``.`` and ``..`` in an absolute path.

    The fold walks the segments once; a trailing dot segment leaves a trailing
    slash, and ``..`` never climbs over the root.
    """
    segs = F.split(F.substring(path, 2, 1_000_000_000), "/")
    kept = F.aggregate(
        segs,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    tail = F.when(F.element_at(segs, -1).isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), tail)


def base_parts(base: Column | str) -> Column:
    """struct(url, origin, path, query, directory) of a page URL, for joining many links to it."""
    base = col(base)
    path = F.regexp_extract(base, _ORIGIN + r"([^?#]*)", 2)
    return F.struct(
        base.alias("url"),
        F.regexp_extract(base, _ORIGIN, 1).alias("origin"),
        path.alias("path"),
        F.regexp_extract(base, _ORIGIN + r"[^?#]*(\?[^#]*)?", 2).alias("query"),
        F.when(path == "", "/").otherwise(F.regexp_extract(path, r"^.*/", 0)).alias("directory"),
    )


def url_join(base: Column | str, href: Column | str) -> Column:
    """Resolve ``href`` against the page URL ``base`` (RFC 3986 reference forms)."""
    return join_parts(base_parts(base), href)


def join_parts(base: Column, href: Column | str) -> Column:
    """``url_join`` with the ``base_parts`` of the page URL."""
    href = col(href)
    ref_path = F.regexp_extract(href, r"^[^?#]*", 0)
    ref_rest = F.substr(href, F.length(ref_path) + 1)
    relative = F.regexp_replace(F.concat(base["directory"], ref_path), "/{2,}", "/")
    full = F.when(F.startswith(href, F.lit("/")), ref_path).otherwise(relative)
    dotted = F.contains(href, F.lit("./")) | F.contains(relative, F.lit("./")) | F.endswith(ref_path, F.lit("."))
    path = F.when(dotted & full.rlike(r"/\.\.?(/|$)"), _without_dot_segments(full)).otherwise(full)
    return (
        F.when(href == "", base["url"])
        .when(F.contains(href, F.lit(":")) & href.rlike(_SCHEME), href)
        .when(F.startswith(href, F.lit("//")), F.concat(F.regexp_extract(base["origin"], _SCHEME, 0), href))
        .when(F.startswith(href, F.lit("?")), F.concat(base["origin"], base["path"], href))
        .when(F.startswith(href, F.lit("#")), F.concat(base["origin"], base["path"], base["query"], href))
        .otherwise(F.concat(base["origin"], path, ref_rest))
    )


def link_kind(url: Column | str) -> Column:
    """'category', 'tag', 'author' or NULL; the first match wins."""
    u = col(url)
    return (
        F.when(F.contains(u, F.lit("/category/")), "category")
        .when(F.contains(u, F.lit("/tag/")), "tag")
        .when(F.contains(u, F.lit("/author/")), "author")
    )


def is_article_url(url: Column | str, site: Site) -> Column:
    """Include patterns, or a slug under the site's domain; excludes veto both."""
    u = col(url)
    included = u.rlike("|".join(fv.ARTICLE_INCLUDES))
    excluded = u.rlike("|".join(fv.ARTICLE_EXCLUDES))
    slashes = F.length(u) - F.length(F.replace(u, F.lit("/"), F.lit("")))
    slug = F.contains(u, F.lit(site.domain)) & F.endswith(u, F.lit("/")) & (slashes >= 4)
    return (included | slug) & ~excluded


def title_starts_foreign(title: Column | str, bl: Blacklist) -> Column:
    return starts_with_any(F.lower(col(title)), bl.title_starters)


def title_indicator_count(title: Column | str, bl: Blacklist) -> Column:
    return terms_in(F.lower(col(title)), n=bl.title_indicators)["n"]


def title_has_term(title: Column | str, bl: Blacklist) -> Column:
    return contains_any(F.lower(col(title)), bl.terms)


def url_has_term(url: Column | str, bl: Blacklist) -> Column:
    return contains_any(F.lower(col(url)), slugs(bl.terms))


def url_lang_path(url: Column | str, bl: Blacklist) -> Column:
    return F.lower(col(url)).rlike(any_of(bl.lang_paths))


def slugs(terms: Sequence[str]) -> list[str]:
    return [t.replace(" ", "-") for t in terms]


def url_terms(low_url: Column | str, bl: Blacklist) -> Column:
    """Counts of the terms that make a lower-cased URL unwanted, in one pass over it."""
    return terms_in(low_url, terms=slugs(bl.terms), lang_paths=bl.lang_paths, patterns=bl.url_patterns)


def title_terms(low_title: Column | str, bl: Blacklist) -> Column:
    """Counts of the terms that make a lower-cased title unwanted, in one pass over it."""
    return terms_in(low_title, indicators=bl.title_indicators, terms=bl.terms, rejects=[t.lower() for t in bl.title_rejects])


def blacklist_reason(url: Column | str, low_url: Column | str, low_title: Column | str | None, bl: Blacklist) -> Column:
    """First reason why a link is unwanted, NULL if it is fine: for links inside an array, with one search a list.

    Takes the lower-cased URL and title.  For rows ``with_blacklist_reason`` does
    the same in one pass over each.
    """
    low, title = col(low_url), None if low_title is None else col(low_title)
    of_url = {"terms": contains_any(low, slugs(bl.terms)), "lang_paths": contains_any(low, bl.lang_paths)}
    of_title = None if title is None else {
        "indicators": count_contained(title, bl.title_indicators) >= bl.title_indicator_min, "terms": contains_any(title, bl.terms)}
    return _reason(col(url), of_url, title, of_title, bl)


def _reason(url: Column, of_url, title: Column | None, of_title, bl: Blacklist) -> Column:
    """The rules in order; title rules run only where a title is known and not blank."""
    reason = F.when(url.isin(*bl.urls) if bl.urls else F.lit(False), "url")
    if title is not None:
        known = F.coalesce(title != "", F.lit(False))
        reason = (
            reason.when(known & starts_with_any(title, bl.title_starters), "title_start")
            .when(known & of_title["indicators"], "title_indicators")
            .when(known & of_title["terms"], "title_term")
        )
    return reason.when(of_url["terms"], "url_term").when(of_url["lang_paths"], "url_lang")


def with_blacklist_reason(df: DataFrame, bl: Blacklist, *, url: str = "url", title: str | None = None,
                          out: str = "blacklist_reason") -> DataFrame:
    """Add the first reason why a link is unwanted, NULL if it is fine."""
    return let(with_terms(df, bl, url=url, title=title), **{out: reason_of(url, title, bl)}).drop("_of_url", "_low_title", "_of_title")


def with_terms(df: DataFrame, bl: Blacklist, *, url: str = "url", title: str | None = None) -> DataFrame:
    """Add what the rules on URL and title look at: ``_of_url``, and with a title ``_low_title`` and ``_of_title``."""
    found = {"_of_url": url_terms(F.lower(url), bl)}
    if title is not None:
        found |= {"_low_title": F.lower(title), "_of_title": title_terms(F.lower(title), bl)}
    return let(df, **found)


def reason_of(url: str, title: str | None, bl: Blacklist) -> Column:
    """``blacklist_reason`` on the columns of ``with_terms``."""
    of_url = {k: F.col(f"_of_url.{k}") > 0 for k in ("terms", "lang_paths")}
    of_title = {"indicators": F.col("_of_title.indicators") >= bl.title_indicator_min, "terms": F.col("_of_title.terms") > 0}
    return _reason(F.col(url), of_url, None if title is None else F.col("_low_title"), of_title, bl)


def title_reject(title: Column | str, bl: Blacklist) -> Column:
    """Direct title reject: any of the reject terms as a substring."""
    return contains_any(F.lower(col(title)), [t.lower() for t in bl.title_rejects])
