"""Link tables: extraction, filters, seeds, resume and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressline import fixed_values as fv
from pressline.functions import urls as U
from pressline.functions.text import contains_any, let
from pressline.operators.nodes import (
    Selector, attr, cascade, descendants, find_all, find_firsts, sel, text_of,
)
from pressline.params import Blacklist, Categories, Site

SITE, BLACKLIST = Site(), Blacklist()


# --- from pages -------------------------------------------------------------------
# A page's links are a set.  The set is made inside the page's row, so taking the
# links out of pages moves no data between tasks.
def _absolute(dom: DataFrame, hrefs: Column) -> DataFrame:
    """(page_id, page_url, url): the set of a page's hrefs, resolved against its URL."""
    based = let(dom, _base=U.base_parts("url"), _hrefs=F.array_distinct(hrefs))
    return _rows(based, F.array_distinct(F.transform("_hrefs", lambda h: U.join_parts(F.col("_base"), h))))


def hrefs_of(anchors: Column) -> Column:
    return F.transform(anchors, lambda n: attr(n, "href"))


def _rows(dom: DataFrame, urls: Column) -> DataFrame:
    return dom.select("page_id", F.col("url").alias("page_url"), F.explode(urls).alias("url"))


def extract_links(dom: DataFrame, *, site: Site | None = None) -> DataFrame:
    """Links that stay on the site's host; without a site, on the page's own host.

    One row per page and URL, with the link kind.
    """
    host = F.lit(site.domain) if site else U.host("page_url")
    found = _absolute(dom, hrefs_of(find_all(sel("a", attr="href"))))
    return found.where(U.host("url") == host).withColumn("kind", U.link_kind("url"))


def article_links(links: DataFrame, *, site: Site = SITE) -> DataFrame:
    """Links whose URL looks like an article."""
    return links.where(U.is_article_url("url", site))


MODULES = Selector(tags=("article", "div"), cls_like=("item", "td-module"), fold=True)
HEADINGS = ("h1", "h2", "h3", "h4")
MAIN_CONTENT = Selector(tags=("div",), id_like="main-content")


def _wanted(anchors: Column, site: Site, bl: Blacklist) -> Column:
    """Set of hrefs on the site that are no listings and not blacklisted."""
    def keep(link: Column) -> Column:
        url, title = link["url"], F.lower(link["title"])
        listing = F.contains(url, F.lit("/category/")) | F.contains(url, F.lit("/tag/"))
        bad = U.blacklist_reason(url, F.lower(url), title, bl).isNotNull()
        return F.contains(url, F.lit(site.domain)) & ~listing & ~bad

    pairs = F.transform(anchors, lambda n: F.struct(attr(n, "href").alias("url"), text_of(n).alias("title")))
    return F.array_distinct(F.transform(F.filter(F.array_distinct(pairs), keep), lambda p: p["url"]))


def heading_links(dom: DataFrame, *, site: Site = SITE, bl: Blacklist = BLACKLIST) -> DataFrame:
    """First link of every heading inside an article module, unless unwanted."""
    def first_link(heading: Column) -> Column:
        return F.slice(F.filter(descendants(heading), lambda n: n["tag"] == "a"), 1, 1)

    headings = find_all(Selector(tags=HEADINGS, within=MODULES))
    found = F.filter(F.flatten(F.transform(headings, first_link)), lambda n: attr(n, "href").isNotNull())
    return _rows(dom, _wanted(found, site, bl))


def content_links(dom: DataFrame, *, area: str = "modules", segments: Sequence[str] = tuple(fv.ARTICLE_SEGMENTS),
                  site: Site = SITE, bl: Blacklist = BLACKLIST) -> DataFrame:
    """Links of article modules or of the main content whose href holds a segment."""
    if area == "modules":
        found = find_all(sel("a", attr="href", within=MODULES))
    else:
        main = find_firsts(MAIN_CONTENT)
        found = F.filter(
            F.flatten(F.transform(main, descendants)), lambda n: (n["tag"] == "a") & attr(n, "href").isNotNull()
        )
    dated = F.filter(found, lambda n: contains_any(attr(n, "href"), segments))
    return _rows(dom, _wanted(dated, site, bl))


PAGERS = [sel(cls=c) for c in ("pagination", "nav-links", "page-numbers", "wp-pagenavi", "paging", "page-navigation")]


def pagination_links(dom: DataFrame, visited: DataFrame | None = None) -> DataFrame:
    """Absolute links of the first pager on a page that were not visited yet."""
    def hrefs(pager: Column) -> Column:
        return hrefs_of(F.filter(descendants(pager), lambda a: (a["tag"] == "a") & attr(a, "href").isNotNull()))

    links = _absolute(dom, cascade(PAGERS, hrefs))
    return links if visited is None else links.join(visited.select("url").distinct(), "url", "left_anti")


def article_page_links(dom: DataFrame, *, site: Site = SITE) -> DataFrame:
    """Links ending in a page number that resolve to article URLs."""
    paged = F.filter(hrefs_of(find_all(sel("a", attr="href"))), lambda h: h.rlike(r"/\d+/$"))
    return article_links(_absolute(dom, paged), site=site)


# --- filters ------------------------------------------------------------------------
def drop_blacklisted_urls(links: DataFrame, blacklist: DataFrame, *, key: str = "url") -> DataFrame:
    """Exact URL blacklist given as a table.

    No broadcast is forced: Spark broadcasts the list only while its size is
    below the session's threshold, and splits hot keys otherwise.
    """
    return links.join(blacklist.select(F.col(key)).distinct(), key, "left_anti")


def filter_links(links: DataFrame, *, site: Site = SITE, bl: Blacklist = BLACKLIST) -> DataFrame:
    """Final link filter: listings, other domains, blacklist, foreign URL patterns."""
    u = F.col("url")
    listing = F.contains(u, F.lit("/author/")) | F.contains(u, F.lit("/tag/"))
    on_site = links.where(~listing & F.contains(u, F.lit(site.domain)))
    judged = let(U.with_terms(on_site, bl), _bad=U.reason_of("url", None, bl).isNotNull() | (F.col("_of_url.patterns") > 0))
    return judged.where(~F.col("_bad")).drop("_of_url", "_bad")


# --- seeds --------------------------------------------------------------------------
def listing_table(spark: SparkSession, *, site: Site = SITE, cats: Categories = Categories()) -> DataFrame:
    rows = [(name, f"{site.base_url}/category/{seg}/") for name, seg in cats.listing]
    return spark.createDataFrame(rows, "category string, url string")


def category_seeds(names: DataFrame, listing: DataFrame) -> DataFrame:
    """Configured category names with their listing URL; unknown names drop out."""
    return names.select("category").distinct().join(listing, "category")


def unknown_categories(names: DataFrame, listing: DataFrame) -> DataFrame:
    return names.select("category").distinct().join(listing, "category", "left_anti")


def page_seeds(listings: DataFrame, *, max_pages: int = 300) -> DataFrame:
    """URLs of pages 1..n of each listing."""
    base = F.regexp_replace("url", "/+$", "")
    page = F.col("page")
    return listings.withColumn("page", F.explode(F.sequence(F.lit(1), F.lit(max_pages)))).withColumn(
        "url", F.when(page == 1, F.concat(base, F.lit("/"))).otherwise(
            F.concat(base, F.lit("/page/"), page.cast("string"), F.lit("/"))
        )
    )


def archive_seeds(sites: DataFrame, *, start_year: int, end_year: int, today: date,
                  shapes: Sequence[str] = tuple(fv.ARCHIVE_SHAPES[:1]), month_pages: int = 1) -> DataFrame:
    """Month archive URLs per site, no future months: (base, year, month, shape, page, url).

    ``shapes`` are URL forms; ``month_pages`` > 1 adds the further pages of a month.
    """
    last = min(end_year, today.year)
    if start_year > last:
        years = F.array().cast("array<int>")
    else:
        years = F.sequence(F.lit(start_year), F.lit(last))
    months = sites.select("base", F.explode(years).alias("year")).withColumn(
        "month", F.explode(F.sequence(F.lit(1), F.lit(12)))
    ).where((F.col("year") < today.year) | (F.col("month") <= today.month))

    def url(shape: str) -> Column:
        parts = {
            "base": F.col("base"), "y": F.col("year").cast("string"), "m": F.col("month").cast("string"),
            "m2": F.lpad(F.col("month").cast("string"), 2, "0"),
        }
        pieces = [p for chunk in shape.split("{") for p in chunk.split("}")]
        return F.concat(*[parts.get(p, F.lit(p)) for p in pieces])

    shaped = months.select(
        "*", F.posexplode(F.array(*[url(s) for s in shapes])).alias("shape", "url")
    ).withColumn("page", F.explode(F.sequence(F.lit(1), F.lit(month_pages))))
    page = F.col("page")
    return shaped.withColumn(
        "url", F.when(page == 1, F.col("url")).otherwise(
            F.concat("url", F.lit("page/"), page.cast("string"), F.lit("/"))
        )
    ).select("base", "year", "month", "shape", "page", "url")


def _templated(sites: DataFrame, terms: Column, templates: Sequence[str]) -> DataFrame:
    """base x term x template, expanded inside each row."""
    rows = sites.select("base", F.explode(terms).alias("term"))
    forms = []
    for t in templates:
        head, tail = t.split("{term}")
        forms.append(F.concat(F.col("base"), F.lit(head.removeprefix("{base}")), "term", F.lit(tail)))
    return rows.select(F.explode(F.array(*forms)).alias("url"))


def search_seeds(sites: DataFrame, *, terms: Sequence[str] = tuple(fv.SEARCH_TERMS),
                 templates: Sequence[str] = tuple(fv.SEARCH_TEMPLATES)) -> DataFrame:
    """Search URLs for every term."""
    return _templated(sites, F.array(*[F.lit(t) for t in terms]), templates).distinct()


def well_known_urls(sites: DataFrame, *, paths: Sequence[str] = tuple(fv.WELL_KNOWN_PATHS)) -> DataFrame:
    return sites.select(F.explode(F.array(*[F.concat("base", F.lit(p)) for p in paths])).alias("url")).distinct()


def listing_url_candidates(sites: DataFrame, links: DataFrame, *, slugs: Sequence[str] = tuple(fv.COMMON_CATEGORY_SLUGS),
                           templates: Sequence[str] = tuple(fv.CATEGORY_TEMPLATES)) -> DataFrame:
    """Category, tag and author URLs seen on pages plus common category URLs: (kind, url)."""
    common = _templated(sites, F.array(*[F.lit(s) for s in slugs]), templates).withColumn("kind", F.lit("category"))
    seen = links.where(F.col("kind").isNotNull()).select("kind", "url")
    return seen.unionByName(common).distinct()


# --- sets, resume, lookups -------------------------------------------------------------
def union_links(*links: DataFrame) -> DataFrame:
    """Union of link tables as a set of URLs."""
    out = links[0].select("url")
    for more in links[1:]:
        out = out.unionByName(more.select("url"))
    return out.distinct()


def remaining(links: DataFrame, progress: DataFrame, *, keys: Sequence[str] = ("batch_no", "url")) -> DataFrame:
    """Links that the progress ledger does not hold yet."""
    return links.join(progress.select(*keys).distinct(), list(keys), "left_anti")


def advance_progress(progress: DataFrame, done: DataFrame, *, keys: Sequence[str] = ("batch_no", "url")) -> DataFrame:
    """Ledger after a run; failed URLs count as processed too."""
    return progress.select(*keys).unionByName(done.select(*keys)).distinct()


def next_frontier(candidates: DataFrame, visited: DataFrame, queued: DataFrame) -> DataFrame:
    """Candidates that are neither visited nor queued, as a set."""
    return (
        candidates.select("url").distinct()
        .join(visited.select("url").distinct(), "url", "left_anti")
        .join(queued.select("url").distinct(), "url", "left_anti")
    )


def lookup(df: DataFrame, rules: DataFrame, *, column: str, key: str = "term") -> DataFrame:
    """Rows joined with the one rule whose key equals the column; others drop out.

    Rule keys are unique, so no row is multiplied.
    """
    return df.join(rules, df[column] == rules[key])


def lookup_contains(df: DataFrame, rules: Sequence[tuple[str, str]], *, column: str, out: str = "value") -> DataFrame:
    """First rule (in order) whose term occurs in the column, NULL without one.

    The rules are a small fixed list, so they go into the expression; a
    contains-join would compare every row with every rule through a cross join.
    """
    value = F.coalesce(
        *[F.when(F.contains(F.col(column), F.lit(t)), F.lit(v)) for t, v in rules]
    )
    return let(df, **{out: value})


