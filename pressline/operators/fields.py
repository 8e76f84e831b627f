"""Page fields: each is an ordered list of selectors and one value rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressline import fixed_values as fv
from pressline.functions import categories as C
from pressline.functions import dates as D
from pressline.functions import urls as U
from pressline.functions.text import (
    WS, WS_CHARS, WS_RUN, any_of, blank_to_null, col, contains_any, count_contained,
    let, sql_text, strip,
)
from pressline.operators.nodes import (
    SPACED_TEXT, TEXT, TEXT_OR_NULL, Selector, attr, cascade, descendants,
    find_all, find_firsts, first, first_element, has_class_like, sel, sql_attr,
    sql_content_or_text, sql_or_null, text_of, text_or_null,
)
from pressline.params import Blacklist, Rules, Site


def meta(prop: str, kind: str = "property") -> Selector:
    return sel("meta", attr=kind, value=prop)


# --- title ----------------------------------------------------------------------
TITLE_BASIC = Selector(tags=("h1", "h2"), cls_like=("entry-title", "td-post-title", "tdb-title-text"))
TITLE_CASCADE = [
    *[sel("h1", c) for c in (
        "entry-title", "post-title", "td-post-title", "tdb-title-text",
        "single-post-title", "article-title",
    )],
    sel("h1", within=sel("article")),
    sel("h1", within=sel(cls="post-header")),
    sel("h1", within=Selector(id="main")),
    sel("h1"),
]


def title_basic() -> Column:
    """Marked heading, else ``og:title`` before the bar; NULL if blank."""
    heading = first(TITLE_BASIC, TEXT)
    shared = strip(first(meta("og:title"), f"substring_index(coalesce({sql_attr('content')}, ''), '|', 1)"))
    return blank_to_null(F.coalesce(heading, shared))


def title_cascade(url: Column | str = "url") -> Column:
    """Headings, ``og:title``, ``<title>`` before bar or dash, last URL part."""
    def cut(n: Column) -> Column:
        t = text_of(n)
        bar, dash = F.lit("|"), F.lit("-")
        return (
            F.when(F.contains(t, bar), strip(F.substring_index(t, "|", 1)))
            .when(F.contains(t, dash), strip(F.substring_index(t, "-", 1)))
            .otherwise(t)
        )

    slug = F.regexp_extract(F.regexp_replace(col(url), "/+$", ""), "[^/]*$", 0)
    return F.coalesce(
        cascade(TITLE_CASCADE, TEXT_OR_NULL),
        strip(first(meta("og:title"), sql_or_null(sql_attr("content")))),
        first(sel("title"), cut),
        C.title_case(F.translate(slug, "-_", "  ")),
    )


# --- date -----------------------------------------------------------------------
DATE_BASIC = Selector(tags=("time", "span", "div"), cls_like=("entry-date", "td-post-date", "meta-date"))
DATE_CASCADE = [
    sel("time", attr="datetime"), sel("time", "entry-date"), sel("time", "published"),
    sel("span", "entry-date"), sel("span", "post-date"), sel("span", "td-post-date"),
    sel(cls="meta-date"), sel(cls="post-date"), sel(cls="published"),
    meta("article:published_time"), meta("datePublished", "itemprop"),
]


# Rules of several steps come in two parts: their marks, read off the nodes, and
# the rest, which needs only the marks.  A plan reads the marks of all rules first
# and goes on with rows that no longer carry the nodes.
def date_marks_basic() -> dict[str, Column]:
    published = f"substring_index(coalesce({sql_attr('content')}, ''), '+', 1)"
    return {
        "date_raw": first(DATE_BASIC, TEXT),
        "_published": first(meta("article:published_time"), published),
    }


def finish_date_basic(marked: DataFrame) -> DataFrame:
    parsed = D.parse_date_basic(marked, "date_raw", date="_read", text="_text")
    value = F.when(F.col("date_raw").isNull(), D.iso_date("_published")).otherwise(F.col("_read"))
    return (
        let(parsed, date_value=value)
        .withColumn("date", F.coalesce("_text", D.display_date(F.col("date_value"))))
        .drop("_published", "_read", "_text")
    )


def with_date_basic(dom: DataFrame) -> DataFrame:
    """Add ``date_raw``, ``date`` (text) and ``date_value`` (DATE).

    Text of the dated element (itself if unreadable), else the meta tag's ISO
    date before the offset.
    """
    return finish_date_basic(let(dom, **date_marks_basic()))


def date_cascade_raw() -> Column:
    """Text of the first dated element: ``datetime``, ``content`` or text."""
    attrs = ", ".join(sql_or_null(sql_attr(name)) for name in ("datetime", "content"))
    return cascade(DATE_CASCADE, f"coalesce({attrs}, {TEXT_OR_NULL})")


def finish_date_cascade(marked: DataFrame, *, url: str = "url") -> DataFrame:
    parsed = D.parse_date_iso_first(marked, "date_raw", date="_value", text="_text")
    out = parsed.withColumn("date", F.coalesce("_text", D.date_in_url(url)))
    return out.withColumn(
        "date_value", F.coalesce("_value", D.date_of_display(D.date_in_url(url)))
    ).drop("_value", "_text")


def with_date_cascade(dom: DataFrame, *, url: str = "url") -> DataFrame:
    """Add ``date_raw``, ``date`` (text) and ``date_value`` (DATE).

    First dated element, else the date path of the page's URL.
    """
    return finish_date_cascade(let(dom, date_raw=date_cascade_raw()), url=url)


# --- author ---------------------------------------------------------------------
AUTHOR_CLASS = Selector(tags=("span", "div", "a"), cls_like=("author",), fold=True)
AUTHOR_FOOTER = Selector(tags=("footer", "div"), cls_like=("footer", "meta"), fold=True)
AUTHOR_CASCADE = [
    meta("author", "name"), meta("article:author"), sel(cls="author-name"),
    sel(cls="post-author"), sel(cls="entry-author"), sel("span", "author"),
    sel("a", attr="rel", value="author"), sel(cls="author", within=sel(cls="byline")),
    sel(cls="author", within=sel(cls="post-meta")),
]
_SEP = rf"(?::|{WS})"


def without_byline(name: Column) -> Column:
    return F.regexp_replace(name, f"(?iu){fv.BYLINE_PREFIX}{_SEP}+", "")


def author_basic(site: Site) -> Column:
    """Meta tag, author class, ``rel=author``, byline in a footer, else the site."""
    def named(name: Column) -> Column:
        low = F.lower(name)
        own = (low == site.domain) | F.contains(low, F.lit("by" + site.name))
        return F.when((name != "") & ~own, name)

    def byline(footer: Column) -> Column:
        texts = F.transform(
            F.filter(descendants(footer), lambda n: n["tag"].isin("span", "div", "p")),
            text_of,
        )
        with_mark = F.filter(texts, lambda t: t.rlike(f"(?iu){fv.BYLINE_IN_TEXT}{_SEP}"))
        return F.get(with_mark, F.lit(0))

    in_footer = strip(F.regexp_extract(first(AUTHOR_FOOTER, byline), f"(?iu){fv.BYLINE_IN_TEXT}{_SEP}+(.+)", 2))
    return F.coalesce(
        named(strip(first(meta("author", "name"), sql_or_null(sql_attr("content"))))),
        named(strip(without_byline(first(AUTHOR_CLASS, TEXT)))),
        named(first(sel("a", attr="rel", token="author"), TEXT)),
        named(in_footer),
        F.lit(site.domain),
    )


def author_cascade(site: Site) -> Column:
    """First author element; texts lose their byline mark and must not name the site."""
    content = sql_or_null(sql_attr("content"))
    byline = sql_text(f"(?iu){fv.BYLINE_PREFIX}{_SEP}+")
    own = ", ".join(sql_text(x) for x in ("", site.domain, site.name))
    name = f"get(filter(array(regexp_replace({TEXT}, {byline}, '')), v -> lower(v) not in ({own})), 0)"
    value = f"if({content} is not null, btrim({content}, {sql_text(WS_CHARS)}), {name})"
    return F.coalesce(cascade(AUTHOR_CASCADE, value), F.lit(site.domain))


# --- category -------------------------------------------------------------------
BREADCRUMBS = Selector(tags=("div",), cls_like=("breadcrumbs",), fold=True)
CATEGORY_CLASS = Selector(
    tags=("span", "a", "div"), cls_like=("category", "cat", "rubrika", "kategorija"), fold=True
)
CATEGORY_CASCADE = [
    meta("article:section"), sel(cls="category-name"), sel(cls="post-category"),
    sel(cls="entry-category"), sel("span", "category"),
    sel("a", attr="rel", value="category"), sel(cls="category", within=sel(cls="post-meta")),
    sel("a", nth=2, within=sel(cls="breadcrumbs")),
]


def category_on_page() -> Column:
    """Second breadcrumb, section meta tag, or a short text in a category element."""
    def second_link(n: Column) -> Column:
        return F.get(F.filter(descendants(n), lambda a: a["tag"] == "a"), F.lit(1))

    crumb = F.get(
        F.transform(
            F.filter(F.transform(find_firsts(BREADCRUMBS), second_link), lambda a: a.isNotNull()),
            text_or_null,
        ),
        F.lit(0),
    )
    texts = F.transform(find_all(CATEGORY_CLASS), text_of)
    short = F.get(F.filter(texts, lambda t: (t != "") & (F.length(t) < 30)), F.lit(0))
    return F.coalesce(crumb, first(meta("article:section"), sql_or_null(sql_attr("content"))), short)


def category_raw(on_page: Column, title: Column, rules: Rules, url: Column | str = "url") -> Column:
    """Category before standardising: page, URL, slug, then title keywords."""
    return F.coalesce(
        on_page, category_named_by_url(url, rules),
        C.category_from_slug(url, rules.site, rules.categories),
        C.category_from_title(title, rules.categories),
    )


def category_named_by_url(url: Column | str, rules: Rules) -> Column:
    cats = rules.categories
    return F.nullif(C.category_from_url(url, cats), F.lit(cats.default))


def with_category_basic(df: DataFrame, rules: Rules, *, on_page: str = "category_on_page",
                        title: str = "title", url: str = "url") -> DataFrame:
    """Add ``category``; one named by the URL is taken as it is, others are standardised."""
    cats = rules.categories
    raw = let(
        df,
        _direct=F.when(F.col(on_page).isNull(), category_named_by_url(url, rules)),
        category_raw=category_raw(F.col(on_page), F.col(title), rules, url),
    )
    done = C.standardize_category(raw, cats, url=url, out="_standard")
    return done.withColumn(
        "category",
        F.coalesce("_direct", F.when(F.col("category_raw").isNotNull(), F.col("_standard")), F.lit(cats.default)),
    ).drop("_direct", "_standard")


def category_cascade(rules: Rules, url: Column | str = "url") -> Column:
    return F.coalesce(
        cascade(CATEGORY_CASCADE, sql_content_or_text()),
        C.category_from_url_strict(url, rules.categories),
        F.lit(rules.categories.default),
    )


# --- subtitle -------------------------------------------------------------------
SUBTITLE_DIRECT = [
    sel(tag, cls) for cls, tags in (
        ("td-post-sub-title", "div p"), ("jeg_post_subtitle", "div p"),
        ("excerpt", "div p"), ("sapo", "div p"), ("subtitle", "h2 div p"),
        ("lead", "div p"), ("summary", "div p"),
    ) for tag in tags.split()
]
SUBTITLE_META = [meta("og:description"), meta("description", "name"), meta("twitter:description", "name")]
SUBTITLE_AREAS = [
    sel("div", "td-post-content"), sel("div", "tdb-block-inner"), sel("div", "entry-content"),
    sel("div", "content-inner"), sel("div", "td-post-text-content"),
    sel("div", "td-post-content", within=sel("article")),
    sel("div", "jeg_post_content"), sel("div", "post-content"),
]
SUBTITLE_INTRO = Selector(tags=("p",), cls_like=("intro", "lead", "summary", "excerpt", "subtitle"), fold=True)
SUBTITLE_CASCADE = [
    *[sel(cls=c) for c in (
        "post-subtitle", "entry-subtitle", "article-subtitle", "td-post-sub-title",
        "jeg_post_subtitle", "excerpt", "lead", "sapo",
    )],
    sel("h2", "subtitle"), meta("og:description"), meta("description", "name"),
]


def valid_subtitle(text: Column | str, bl: Blacklist) -> Column:
    t = col(text)
    size = F.length(t)
    return F.coalesce(
        (size >= 10) & (size <= 250)
        & ~contains_any(t, bl.subtitles)
        & ~F.endswith(t, F.lit("...")) & ~F.endswith(t, F.lit("…"))
        & ~t.rlike("(?U)" + "|".join(fv.SUBTITLE_REJECTS)),
        F.lit(False),
    )


def _candidate(text: Column, score: int, source: str) -> Column:
    return F.struct(text.alias("text"), F.lit(score).alias("score"), F.lit(source).alias("source"))


def _only(ok: Column, candidate: Column) -> Column:
    """One-element array, empty where the condition does not hold."""
    return F.filter(F.array(candidate), lambda _: F.coalesce(ok, F.lit(False)))


def _paragraph_candidates(area: Column, bl: Blacklist) -> Column:
    """First paragraph of an area, the second only where the first is unfit."""
    two = F.slice(F.filter(descendants(area), lambda n: n["tag"] == "p"), 1, 2)

    def fit(t: Column) -> Column:
        return valid_subtitle(t, bl) & F.length(t).between(40, 200)

    def offered(t: Column, sentence: tuple[int, str], whole: tuple[int, str]) -> Column:
        head = F.regexp_extract(t, r"^[^.!?]*", 0)
        return F.when(
            F.length(t) > 100, _only(F.length(head) >= 40, _candidate(strip(head), *sentence))
        ).otherwise(F.array(_candidate(t, *whole)))

    def choose(pair: Column) -> Column:
        p1, p2 = F.get(pair, F.lit(0)), F.get(pair, F.lit(1))
        return (
            F.when(F.coalesce(fit(p1), F.lit(False)), offered(p1, (6, "first_para_sentence"), (5, "first_para")))
            .when(F.coalesce(fit(p2), F.lit(False)), offered(p2, (4, "second_para_sentence"), (3, "second_para")))
            .otherwise(F.filter(F.array(_candidate(F.lit(""), 0, "")), lambda _: F.lit(False)))
        )

    return F.flatten(F.transform(F.array(F.transform(two, text_of)), choose))


def subtitle_candidates(bl: Blacklist) -> Column:
    """Array of struct(text, score, source) in the order they are found."""
    def texts_of(nodes: Column, score: int, source: str, value=text_of, fits=None) -> Column:
        ok = fits or (lambda t: valid_subtitle(t, bl))
        found = F.filter(F.transform(nodes, value), lambda t: F.coalesce(ok(t), F.lit(False)))
        return F.transform(found, lambda t: _candidate(t, score, source))

    def of_strong(area: Column) -> Column:
        strong = F.slice(F.filter(descendants(area), lambda n: n["tag"].isin("strong", "b")), 1, 2)
        fits = lambda t: valid_subtitle(t, bl) & F.length(t).between(40, 200)
        return texts_of(strong, 5, "strong", fits=fits)

    return F.concat(
        texts_of(find_all(*SUBTITLE_DIRECT), 10, "direct"),
        texts_of(find_firsts(*SUBTITLE_META), 8, "meta", lambda n: strip(attr(n, "content"))),
        F.flatten(F.transform(find_firsts(*SUBTITLE_AREAS), lambda a: _paragraph_candidates(a, bl))),
        texts_of(find_firsts(SUBTITLE_INTRO), 7, "intro"),
        # strong elements count only in the last area of the list
        F.flatten(F.transform(find_firsts(SUBTITLE_AREAS[-1]), of_strong)),
    )


def best_candidate(candidates: Column | str) -> Column:
    """Highest score, then closest to 100 characters, then first found."""
    ranked = F.transform(
        col(candidates),
        lambda c, i: F.struct(
            (-c["score"]).alias("a"), F.abs(F.length(c["text"]) - 100).alias("b"), i.alias("c"), c["text"].alias("text")
        ),
    )
    return F.array_min(ranked)["text"]


def best_subtitle(df: DataFrame, *, candidates: str = "candidates", out: str = "subtitle") -> DataFrame:
    """Add the best candidate: trailing dots dropped, a punctuation mark at the end."""
    step = let(df, _best=strip(F.regexp_replace(best_candidate(candidates), "[.…]+$", "")))
    t = F.col("_best")
    return step.withColumn(
        out, F.when((t == "") | t.rlike("[.!?]$"), t).otherwise(F.concat(t, F.lit(".")))
    ).drop("_best")


def subtitle_cascade() -> Column:
    """First subtitle element with 21 to 299 characters."""
    content = sql_or_null(sql_attr("content"))
    shown = f"coalesce(btrim({content}, {sql_text(WS_CHARS)}), {TEXT})"
    return cascade(SUBTITLE_CASCADE, f"get(filter(array({shown}), v -> length(v) > 20 and length(v) < 300), 0)")


# --- body -----------------------------------------------------------------------
BODY_BASIC = [
    *[sel("div", c) for c in (
        "td-post-content", "tdb-block-inner", "jeg_post_content", "entry-content",
        "td-post-text-content", "content-inner",
    )],
    sel("div", "td-post-content", within=sel("article")),
    *[sel("div", c) for c in ("post-content", "article-content", "td_block_wrap", "content-area", "main-content")],
]
BODY_CASCADE = [
    *[sel("div", c) for c in ("td-post-content", "entry-content", "post-content", "article-content", "content-inner")],
    sel(cls="content", within=sel("article")), sel(cls="post-body"), sel(cls="article-body"),
    Selector(id="article-content"), sel("div", attr="itemprop", value="articleBody"),
]
BODY_MAIN = [sel("article"), Selector(id="main"), Selector(id="content"), sel(cls="main-content"), sel(cls="content-area")]


def _body_text(n: Column) -> Column:
    """Text of one block of the basic body, NULL where the block is left out."""
    inside = descendants(n)
    embeds = F.exists(
        inside,
        lambda d: d["tag"].isin("script", "iframe")
        | ((d["tag"] == "blockquote") & F.array_contains(d["classes"], "twitter-tweet")),
    )
    pictures = F.exists(inside, lambda d: d["tag"].isin("img", "iframe", "embed"))
    keep = ~embeds & ~has_class_like(n, fv.BODY_SKIP_CLASSES)

    def text_rule(t: Column) -> Column:
        ok = (F.length(t) > 15) & ~contains_any(F.lower(t), fv.BODY_SKIP_TERMS)
        return F.when(ok & ~(pictures & (F.length(t) < 30)), t)

    return F.when(keep, F.get(F.transform(F.array(text_of(n)), text_rule), F.lit(0)))


def body_basic(container: Column | str) -> Column:
    """Blocks of the container joined by blanks; nested blocks repeat their text."""
    blocks = F.filter(
        descendants(col(container)), lambda n: n["tag"].isin("p", "div", "h3", "h4", "ul", "ol")
    )
    return F.array_join(F.filter(F.transform(blocks, _body_text), lambda t: t.isNotNull()), " ")


def body_fallback() -> Column:
    """All paragraphs outside footers, sidebars, comments, widgets, breadcrumbs."""
    unwanted = F.filter(F.col("nodes"), lambda n: has_class_like(n, fv.FALLBACK_SKIP_CLASSES))

    def outside(bad: Column) -> Column:
        kept = F.filter(
            F.col("nodes"),
            lambda p: (p["tag"] == "p")
            & ~F.exists(bad, lambda b: (b["id"] < p["id"]) & (p["id"] <= b["last"])),
        )
        texts = F.transform(kept, text_of)
        return F.array_join(F.filter(texts, lambda t: F.length(t) > 20), " ")

    return F.get(F.transform(F.array(unwanted), outside), F.lit(0))


def body_in(container: str) -> Column:
    """Basic body of a known container, the fallback without one; NULL if blank."""
    known = F.col(container).isNotNull()
    return blank_to_null(F.when(known, body_basic(container)).otherwise(body_fallback()))


def body_of(dom: DataFrame) -> DataFrame:
    """Add ``content``: the basic body, the fallback where no container is known."""
    found = let(dom, container=first_element(BODY_BASIC))
    return found.withColumn("content", body_in("container")).drop("container")


def body_cascade() -> Column:
    """Paragraph-like text of the first container that has any."""
    blocks = "filter(slice(nodes, n.id + 2, n.last - n.id), d -> d.tag in ('p', 'h2', 'h3', 'h4', 'blockquote', 'ul', 'ol'))"
    texts = f"transform({blocks}, d -> {TEXT.replace('n.', 'd.')})"
    skip = sql_text(any_of(fv.CASCADE_SKIP_TERMS))
    kept = f"filter({texts}, t -> t <> '' and not rlike(lower(t), {skip}))"
    return cascade(BODY_CASCADE, sql_or_null(f"array_join({kept}, ' ')"))


def stop_phrases(site: Site) -> Sequence[str]:
    return [p.format(name=site.name.capitalize()) for p in fv.STOP_PHRASES]


def body_alternative(site: Site) -> Column:
    """All text of the main area up to the first stop phrase, if longer than 100."""
    text = F.regexp_replace(cascade(BODY_MAIN, SPACED_TEXT), WS_RUN, " ")
    for phrase in stop_phrases(site):
        text = F.substring_index(text, phrase, 1)
    return F.get(F.filter(F.array(text), lambda t: F.length(t) > 100), F.lit(0))


def body(site: Site) -> Column:
    """Cascade body, else the alternative."""
    return F.coalesce(body_cascade(), body_alternative(site))


def no_content(content: Column | str) -> Column:
    return F.when(col(content).isNull(), "No content extracted")


def with_body_and_error(dom: DataFrame, site: Site) -> DataFrame:
    """Add ``content`` (main rule, else the alternative) and ``error``."""
    return let(dom, content=body(site)).withColumn("error", no_content("content"))


# --- whole page -----------------------------------------------------------------
def metadata_marks() -> dict[str, Column]:
    """``meta_entries``: key and value of every meta tag that has a key."""
    entries = F.transform(
        find_all(sel("meta")),
        lambda n: F.struct(
            F.coalesce(blank_to_null(attr(n, "property")), blank_to_null(attr(n, "name"))).alias("k"),
            F.coalesce(attr(n, "content"), F.lit("")).alias("v"),
        ),
    )
    return {"meta_entries": F.filter(entries, lambda e: e["k"].isNotNull())}


def finish_metadata(marked: DataFrame) -> DataFrame:
    keys = F.array_distinct(F.transform("meta_entries", lambda e: e["k"]))
    last = lambda k: F.element_at(F.filter("meta_entries", lambda e: e["k"] == k), -1)["v"]
    return (
        marked.withColumn("metadata", F.map_from_arrays(keys, F.transform(keys, last)))
        .withColumn("json_ld", F.when(F.try_parse_json("json_ld").isNotNull(), F.col("json_ld")))
        .drop("meta_entries")
    )


def with_metadata(dom: DataFrame) -> DataFrame:
    """Add ``metadata`` (the last value of a key wins); blank bad ``json_ld``."""
    return finish_metadata(let(dom, **metadata_marks()))


def html_marks() -> dict[str, Column]:
    return {
        "_lang": F.lower(first(sel("html"), sql_or_null(sql_attr("lang")))),
        "_title": F.lower(first(sel("title"), TEXT)),
        "_classes": first(sel("body"), "array_join(n.classes, ' ')"),
    }


def finish_html_reason(marked: DataFrame, bl: Blacklist, *, out: str = "html_reason") -> DataFrame:
    bad_title = contains_any("_title", bl.html_title_b)
    if bl.html_title_a:
        bad_title = (count_contained("_title", bl.html_title_a) >= 2) | bad_title
    reason = (
        F.when(~F.col("_lang").isin(*bl.allowed_langs), "lang")
        .when(bad_title, "title")
        .when(contains_any("_classes", U.slugs(bl.terms)), "class")
    )
    return let(marked, **{out: reason}).drop("_lang", "_title", "_classes")


def with_html_reason(dom: DataFrame, bl: Blacklist, *, out: str = "html_reason") -> DataFrame:
    """Add why the page's own markup calls it foreign: 'lang', 'title', 'class' or NULL.

    The language test is exact, so a regional tag such as ``xx-YY`` is foreign
    unless it is listed.
    """
    return finish_html_reason(let(dom, **html_marks()), bl, out=out)


def foreign_by_html(dom: DataFrame, bl: Blacklist) -> DataFrame:
    return with_html_reason(dom, bl).withColumn("html_foreign", F.col("html_reason").isNotNull())
