"""Pages: nodes, selectors, fields, whole articles."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressline import fixed_values as fv
from pressline.functions import categories as C
from pressline.functions import dates as D
from pressline.functions import urls as U
from pressline.functions.text import let
from pressline.operators import fields as P
from pressline.operators import links, nodes, stats
from pressline.operators.dedup import filter_rollup, first_rows
from pressline.operators.language import language_verdict
from pressline.params import Blacklist, Categories, Rules
from pressline.plans.articles import extract_rows, scrape_rows
from pressline.sources.dom import node_table, parse_pages, register_page_nodes
from registry.common import (
    LEX, RULES, SITE, WS_SQL, articles, lit, query, sql_any, sql_count, sql_first_rule,
    sql_list, sql_strip, table, text_table, with_articles,
)
from registry.language import sample_cte, verdict_cte
from registry.links import blacklist_sql, dom, pages
from registry.press import ADVERT, PRESS_SQL, SCRIPTED, SHARE, press_pages

CATS = Categories()
DEFAULT = lit(fv.DEFAULT_CATEGORY)


def press(spark, sf):
    return parse_pages(press_pages(spark, sf))


def with_press(sql: str, *ctes: str) -> str:
    return "WITH " + ", ".join((f"p AS ({PRESS_SQL})", *ctes)) + "\n" + sql


# --- nodes and selectors --------------------------------------------------------------
# in the fixture no tag occurs inside a script or a comment
@query("c1_node_counts", """
SELECT page_id, lower(tag) AS tag, count(*) AS n FROM
  (SELECT page_id, unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM pages) GROUP BY ALL""")
def c1(spark, sf):
    return node_table(dom(spark, sf)).groupBy("page_id", "tag").agg(F.count("*").alias("n"))


@query("c1_nodes_in_sql", """
SELECT page_id, lower(tag) AS tag, count(*) AS n FROM
  (SELECT page_id, unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM pages) GROUP BY ALL""")
def c1_sql(spark, sf):
    """The same nodes by a table function in SQL."""
    register_page_nodes(spark)
    pages(spark, sf).createOrReplaceTempView("stored_pages")
    return spark.sql("SELECT page_id, tag, count(*) AS n FROM page_nodes(TABLE(SELECT page_id, url, html FROM stored_pages)) GROUP BY page_id, tag")


def sql_unescape(x: str) -> str:
    """Entities of the fixture; HTML reads these names without a semicolon too."""
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        x = f"regexp_replace({x}, '&{name};?', '{char}', 'g')"
    return x


_H1 = sql_strip(sql_unescape("regexp_extract(html, '<h1>(.*?)</h1>', 1)"))


@query("c1_node_text", f"SELECT page_id, {_H1} AS h1, regexp_extract(html, '<html lang=\"([a-z]*)\"', 1) AS lang, len(regexp_extract_all(html, '<li>')) AS items FROM pages")
def c1_text(spark, sf):
    t = node_table(dom(spark, sf))
    return t.groupBy("page_id").agg(
        F.max(F.when(F.col("tag") == "h1", F.col("text"))).alias("h1"),
        F.max(F.when(F.col("tag") == "html", F.col("attrs")["lang"])).alias("lang"),
        F.count_if((F.col("tag") == "li") & (F.col("last_id") == F.col("node_id") + 1)).alias("items"),
    )


@query("c2_first_match", f"SELECT page_id, url, {_H1} AS value FROM pages")
def c2(spark, sf):
    cascade = [nodes.sel("h1", "entry-title"), nodes.sel("h1", within=nodes.sel(cls="ad")), nodes.sel("h1", within=nodes.sel("article"))]
    return nodes.first_match(dom(spark, sf), cascade)


@query("w5_first_k", """
WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)[1:2]) AS t, generate_subscripts(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)[1:2], 1) AS rank FROM pages)
SELECT page_id, rank, replace(t, '&amp;', '&') AS text FROM a""")
def w5(spark, sf):
    return nodes.first_k(dom(spark, sf), ["a"], 2)


@query("w5_first_k_rows", """
WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)[1:2]) AS t, generate_subscripts(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)[1:2], 1) AS rank FROM pages)
SELECT page_id, rank, replace(t, '&amp;', '&') AS text FROM a""")
def w5_rows(spark, sf):
    return nodes.first_k_rows(node_table(dom(spark, sf)), ["a"], 2)


# --- links of listing pages -------------------------------------------------------------
NO_TERMS = Blacklist(title_indicator_min=10**6, title_starters=("the the",), terms=("of the",))
HREF = "'https://news.example/2024/' || doc_id || '.html'"
WANTED = f"""lang IN ('fr', 'de') AND NOT (shown_title <> '' AND (starts_with(lower(shown_title), 'the the') OR contains(lower(shown_title), 'of the')))"""


@query("b4_heading_links", with_press(f"SELECT doc_id AS page_id, page_url, {HREF} AS url FROM p WHERE {WANTED}"))
def b4(spark, sf):
    return links.heading_links(press(spark, sf), site=SITE, bl=NO_TERMS)


@query("b5_content_links", with_press(f"SELECT doc_id AS page_id, page_url, {HREF} AS url FROM p WHERE {WANTED}"))
def b5(spark, sf):
    return links.content_links(press(spark, sf), segments=["2024/"], site=SITE, bl=NO_TERMS)


@query("b18_pagination_links", with_press("""
SELECT doc_id AS page_id, page_url, unnest(['https://news.example/page/2/', page_url || '?p=3']) AS url FROM p
WHERE true""").replace("SELECT doc_id AS page_id", "SELECT * FROM (SELECT doc_id AS page_id") + ") WHERE url NOT IN (SELECT page_url || '?p=3' FROM p WHERE lang = 'de')")
def b18(spark, sf):
    derived = press_pages(spark, sf)
    seen = derived.where(F.contains("html", F.lit('<html lang="de">'))).select(F.concat("url", F.lit("?p=3")).alias("url"))
    return links.pagination_links(parse_pages(derived), seen).select("page_id", "page_url", "url")


# --- title ------------------------------------------------------------------------------
_CUT = sql_strip("split_part(title || ' | Site', '|', 1)")
TITLE3 = f"nullif(CASE WHEN lang IN ('fr', 'de') THEN shown_title WHEN lang = 'en' THEN {_CUT} END, '')"


@query("c3_title_basic", with_press(f"SELECT doc_id AS page_id, {TITLE3} AS title FROM p"))
def c3(spark, sf):
    return press(spark, sf).select("page_id", P.title_basic().alias("title"))


@query("c4_title_cascade", f"SELECT page_id, {_H1} AS title FROM pages")
def c4(spark, sf):
    return dom(spark, sf).select("page_id", P.title_cascade("url").alias("title"))


# without a heading the shared title counts as it stands, then what the page's own title has before its bar
TITLE4 = f"CASE WHEN lang = 'en' AND shown_title = '' THEN '| Site' WHEN lang = 'es' OR shown_title = '' THEN {_CUT} ELSE shown_title END"


@query("c4_title_cascade_press", with_press(f"SELECT doc_id AS page_id, {TITLE4} AS title FROM p"))
def c4_press(spark, sf):
    return press(spark, sf).select("page_id", P.title_cascade("url").alias("title"))


_LAST_PART = "regexp_extract(regexp_replace(url, '/+$', ''), '[^/]*$')"


@query("c4_title_slug", f"""SELECT page_id, array_to_string(list_transform(string_split(translate({_LAST_PART}, '-_', '  '), ''),
  lambda x, i: CASE WHEN i = 1 OR NOT regexp_matches(translate({_LAST_PART}, '-_', '  ')[i - 1], '[A-Za-z]') THEN upper(x) ELSE lower(x) END), '') AS title FROM pages""")
def c4_slug(spark, sf):
    """Pages that have lost their headings and their title: the last part of the URL names them."""
    bare = pages(spark, sf).withColumn("html", F.regexp_replace("html", "<(/?)(h1|title)>", "<$1h5>"))
    return parse_pages(bare).select("page_id", P.title_cascade("url").alias("title"))


# --- date -------------------------------------------------------------------------------
DATE5 = "CASE lang WHEN 'fr' THEN CASE WHEN s % 4 = 3 THEN 'nedavno' ELSE strftime(day, '%d.%m.%Y') END WHEN 'es' THEN NULL ELSE strftime(day, '%d.%m.%Y') END"


@query("c5_date_basic", with_press(f"SELECT doc_id AS page_id, {DATE5} AS date, CASE WHEN {DATE5} <> 'nedavno' THEN day END AS date_value FROM p"))
def c5(spark, sf):
    return P.with_date_basic(press(spark, sf)).select("page_id", "date", "date_value")


# the cascade reads "dd.MM.yyyy." as it stands: it is none of its formats
DATE6 = """CASE lang WHEN 'fr' THEN CASE s % 4 WHEN 3 THEN 'nedavno' WHEN 1 THEN strftime(day, '%d.%m.%Y.') ELSE strftime(day, '%d.%m.%Y') END
  WHEN 'es' THEN CASE WHEN s >= 10 THEN strftime(day, '%d.%m.%Y') END ELSE strftime(day, '%d.%m.%Y') END"""


@query("c6_date_cascade", with_press(f"SELECT doc_id AS page_id, {DATE6} AS date, CASE WHEN len({DATE6}) = 10 THEN day END AS date_value FROM p"))
def c6(spark, sf):
    return P.with_date_cascade(press(spark, sf)).select("page_id", "date", "date_value")


_BASIC_FORMS = ["%d/%m/%Y", "%d.%m.%Y", "%d.%m.%Y.", "%d %B, %Y", "%d %b %Y", "%B %d, %Y", "%Y-%m-%d", "%d - %m - %y", "@ %Y", "soon"]
_ISO_FORMS = ["%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S+02:00", "%Y-%m-%d", "%d.%m.%Y", "%d/%m/%Y", "%B %d, %Y", "%d %B %Y", "@ %Y", "soon"]
_JAVA = {"%d": "dd", "%m": "MM", "%Y": "yyyy", "%y": "yy", "%B": "MMMM", "%b": "MMM", "%H": "HH", "%M": "mm", "%S": "ss"}


def _java(fmt: str) -> str:
    out, i = "", 0
    while i < len(fmt):
        if fmt[i] == "%":
            out += _JAVA[fmt[i : i + 2]]
            i += 2
        else:
            out += "'" + fmt[i] + "'" if fmt[i].isalpha() else fmt[i]
            i += 1
    return out


def _rendered_ts(spark, sf, forms):
    """Every event time written in every form; '@' is the day and month name."""
    e = text_table(spark, sf, "events", "event_id", "ts")
    named = F.concat(F.dayofmonth("ts").cast("string"), F.lit(". "), F.array(*[F.lit(n) for n, _ in fv.MONTHS_BASIC])[F.month("ts") - 1], F.lit(" "), F.year("ts").cast("string"))
    text = [named if f.startswith("@") else F.lit(f) if "%" not in f else F.date_format("ts", _java(f)) for f in forms]
    return e.select("event_id", F.posexplode(F.array(*text)).alias("form", "raw"))


def _ts_sql(forms, raw_kept):
    """The day itself in every readable form, the text as it stands otherwise."""
    n = len(forms)
    return f"""SELECT event_id, form::INTEGER AS form, CASE WHEN form = {n - 1} THEN NULL ELSE ts::DATE END AS date,
  CASE WHEN form = {n - 1} THEN 'soon' ELSE strftime(ts, '%d.%m.%Y') END AS date_text FROM events, range({n}) r(form)"""


@query("c7_parse_date_basic", _ts_sql(_BASIC_FORMS, True))
def c7(spark, sf):
    return D.parse_date_basic(_rendered_ts(spark, sf, _BASIC_FORMS), "raw").select("event_id", "form", "date", "date_text")


@query("c8_parse_date_iso_first", _ts_sql(_ISO_FORMS, True))
def c8(spark, sf):
    return D.parse_date_iso_first(_rendered_ts(spark, sf, _ISO_FORMS), "raw").select("event_id", "form", "date", "date_text")


# --- author -----------------------------------------------------------------------------
@query("c9_author_basic", with_press("SELECT doc_id AS page_id, writer AS author FROM p"))
def c9(spark, sf):
    return press(spark, sf).select("page_id", P.author_basic(SITE).alias("author"))


# a rel of several words is not equal to "author", and footers are not searched
@query("c10_author_cascade", with_press("SELECT doc_id AS page_id, CASE WHEN lang IN ('en', 'fr') THEN writer ELSE 'news.example' END AS author FROM p"))
def c10(spark, sf):
    return press(spark, sf).select("page_id", P.author_cascade(SITE).alias("author"))


# --- category ---------------------------------------------------------------------------
def sql_by_url(u: str) -> str:
    segs = sql_first_rule(f"lower({u})", [([f"/{seg}/"], v) for seg, v in fv.URL_CATEGORIES])
    return f"coalesce({segs}, {sql_first_rule(f'lower({u})', fv.URL_KEYWORDS)}, {DEFAULT})"


def sql_similar(x: str) -> str:
    return f"coalesce({sql_first_rule(f'lower({x})', fv.STEM_CATEGORIES)}, {DEFAULT})"


def sql_standard(raw: str, url: str) -> str:
    """The full category standardising as one expression."""
    std = sql_list(fv.STANDARD_CATEGORIES)
    # the part rule is a lookup of the first part with a result
    part = f"CASE WHEN list_contains({std}, q) THEN q ELSE nullif({sql_similar('q')}, {DEFAULT}) END"
    parts = f"list_transform(string_split_regex({raw}, ',|\\si\\s'), lambda z: trim(z))"
    multi = f"CASE WHEN contains({raw}, ',') OR contains({raw}, ' i ') THEN list_filter(list_transform({parts}, lambda q: {part}), lambda m: m IS NOT NULL)[1] END"
    keys, values = sql_list(k for k, _ in fv.NAME_CATEGORIES), sql_list(v for _, v in fv.NAME_CATEGORIES)
    low = f"trim(lower({raw}))"
    named = f"({values})[list_position({keys}, {low})]"
    inside = sql_first_rule(low, [([k], v) for k, v in fv.NAME_CATEGORIES])
    return f"""CASE WHEN {raw} IS NULL OR {raw} = '' THEN {sql_by_url(url)} WHEN list_contains({std}, {raw}) THEN {raw}
  ELSE coalesce({multi}, {named}, {inside}, {sql_by_url(url)}) END"""


_SEGMENT = "url || CASE page_id % 5 WHEN 0 THEN '/sport/x' WHEN 1 THEN '/vjera/' WHEN 2 THEN '/izbori-2024' WHEN 3 THEN '/kultura/' ELSE '' END"


def segment_urls(spark, sf):
    """Page URLs with category segments and keywords appended."""
    m = F.col("page_id") % 5
    tail = F.when(m == 0, "/sport/x").when(m == 1, "/vjera/").when(m == 2, "/izbori-2024").when(m == 3, "/kultura/").otherwise("")
    return table(spark, sf, "pages").select("page_id", F.concat("url", tail).alias("u"))


@query("c12_category_from_url", f"SELECT page_id, {sql_by_url('u')} AS category FROM (SELECT page_id, {_SEGMENT} AS u FROM pages)")
def c12(spark, sf):
    return segment_urls(spark, sf).select("page_id", C.category_from_url("u", CATS).alias("category"))


@query("c13_category_from_url_strict", "SELECT page_id, " + sql_first_rule("lower(u)", [([f"/{seg}/"], v) for seg, v in fv.URL_CATEGORIES_STRICT]) + f" AS category FROM (SELECT page_id, {_SEGMENT} AS u FROM pages)")
def c13(spark, sf):
    return segment_urls(spark, sf).select("page_id", C.category_from_url_strict("u", CATS).alias("category"))


# names written from the part table: standard, multi-value, mapped, contained, unknown
_NAMES_SQL = """SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Sport' WHEN 'SMALL' THEN p_name || ', nogomet' WHEN 'MEDIUM' THEN p_name || ' i politika'
  WHEN 'LARGE' THEN 'Vijesti ' WHEN 'PROMO' THEN 'moja kultura ' || p_brand ELSE p_name END AS raw, 'https://news.example/' || lower(p_type) || '/' AS url FROM part"""


def written_names(spark, sf):
    t, name = F.col("p_type"), F.col("p_name")
    raw = (
        F.when(t == "ECONOMY", "Sport").when(t == "SMALL", F.concat(name, F.lit(", nogomet")))
        .when(t == "MEDIUM", F.concat(name, F.lit(" i politika"))).when(t == "LARGE", "Vijesti ")
        .when(t == "PROMO", F.concat(F.lit("moja kultura "), "p_brand")).otherwise(name)
    )
    url = F.concat(F.lit("https://news.example/"), F.lower("p_type"), F.lit("/"))
    return table(spark, sf, "part").select("p_partkey", raw.alias("raw"), url.alias("url"))


@query("c14_standardize_category", f"SELECT p_partkey, raw, {sql_standard('raw', 'url')} AS category FROM ({_NAMES_SQL})")
def c14(spark, sf):
    return C.standardize_category(written_names(spark, sf), CATS, raw="raw").select("p_partkey", "raw", "category")


@query("c15_similar_category", f"SELECT p_partkey, {sql_similar('raw')} AS category, {sql_similar('p_name')} AS by_name FROM ({_NAMES_SQL}) JOIN part USING (p_partkey)")
def c15(spark, sf):
    names = written_names(spark, sf).join(table(spark, sf, "part").select("p_partkey", "p_name"), "p_partkey")
    return names.select("p_partkey", C.similar_category("raw", CATS).alias("category"), C.similar_category("p_name", CATS).alias("by_name"))


@query("c16_category_from_title", with_articles(f"SELECT doc_id, {sql_first_rule('lower(title)', fv.TITLE_CATEGORIES)} AS category FROM a"))
def c16(spark, sf):
    return articles(spark, sf).select("doc_id", C.category_from_title("title", CATS).alias("category"))


# what a page says about its category; "td-Breadcrumbs" also contains "cat"-free text only
_ON_PAGE = "CASE WHEN lang IN ('en', 'fr', 'de') THEN section END"
_BY_URL = f"nullif({sql_by_url('page_url')}, {DEFAULT})"
_SLUG = "regexp_extract(page_url, 'news\\.example/(?:category/)?([^/]+)/', 1)"
_NAMED = "CASE WHEN starts_with(" + _SLUG + ", 'post-') THEN 'Post ' || doc_id ELSE " + _SLUG + " END"
RAW11 = f"coalesce({_ON_PAGE}, {_BY_URL}, {_NAMED})"


@query("c11_category_raw", with_press(f"SELECT doc_id AS page_id, {_ON_PAGE} AS on_page, {RAW11} AS raw FROM p"))
def c11(spark, sf):
    found = let(press(spark, sf), on_page=P.category_on_page(), title=P.title_basic())
    return found.select("page_id", "on_page", P.category_raw(F.col("on_page"), F.col("title"), RULES).alias("raw"))


CATEGORY_SQL = f"CASE WHEN {_ON_PAGE} IS NULL AND {_BY_URL} IS NOT NULL THEN {_BY_URL} ELSE {sql_standard('raw', 'page_url')} END"


@query("c11_category_basic", with_press(f"SELECT doc_id AS page_id, {CATEGORY_SQL} AS category FROM (SELECT *, {RAW11} AS raw FROM p)"))
def c11_basic(spark, sf):
    found = let(press(spark, sf), category_on_page=P.category_on_page(), title=P.title_basic())
    return P.with_category_basic(found, RULES).select("page_id", "category")


@query("c17_category_cascade", with_press(f"SELECT doc_id AS page_id, CASE WHEN lang IN ('en', 'de') THEN section ELSE {DEFAULT} END AS category FROM p"))
def c17(spark, sf):
    # "td-Breadcrumbs" is not the class "breadcrumbs", so French pages fall through
    return press(spark, sf).select("page_id", P.category_cascade(RULES).alias("category"))


# --- subtitle ---------------------------------------------------------------------------
def sql_valid(x: str) -> str:
    rejects = " OR ".join(f"regexp_matches({x}, {lit(r)})" for r in fv.SUBTITLE_REJECTS)
    return f"(len({x}) BETWEEN 10 AND 250 AND NOT {sql_any(x, fv.BLACKLISTED_SUBTITLES)} AND NOT ends_with({x}, '...') AND NOT ends_with({x}, '…') AND NOT ({rejects}))"


@query("c18_valid_subtitle", with_articles(f"SELECT doc_id, {sql_valid('title')} AS valid FROM a"))
def c18(spark, sf):
    return articles(spark, sf).select("doc_id", P.valid_subtitle("title", RULES.blacklist).alias("valid"))


def _fit(x):
    return f"({sql_valid(x)} AND len({x}) BETWEEN 40 AND 200)"


_HEAD = lambda x: f"regexp_extract({x}, '^[^.!?]*')"
CANDIDATES_CTE = f"""
g AS (SELECT *, {sql_strip('subtitle')} AS sub, CASE WHEN lang = 'es' THEN [] ELSE
  list_transform(list_concat(string_split(content, chr(10)), [{lit(SHARE)}, {lit(SCRIPTED)}, {lit(ADVERT)}]), lambda x: {sql_strip('x')}) END AS ps FROM p),
g2 AS (SELECT *, ps[1] AS p1, ps[2] AS p2 FROM g),
areas AS (SELECT *, unnest(CASE lang WHEN 'es' THEN [] WHEN 'en' THEN [12] ELSE [10, 15] END) AS area FROM g2),
cand AS (
  SELECT doc_id, lead AS text, 10 AS score, 'direct' AS source, 1 AS ord FROM g2 WHERE lang = 'de' AND {sql_valid('lead')}
  -- only the first description tag counts, and "old" is too short
  UNION ALL SELECT doc_id, CASE WHEN len(p1) > 100 THEN {sql_strip(_HEAD('p1'))} ELSE p1 END, CASE WHEN len(p1) > 100 THEN 6 ELSE 5 END,
    CASE WHEN len(p1) > 100 THEN 'first_para_sentence' ELSE 'first_para' END, area FROM areas
    WHERE {_fit('p1')} AND (len(p1) <= 100 OR len({_HEAD('p1')}) >= 40)
  UNION ALL SELECT doc_id, CASE WHEN len(p2) > 100 THEN {sql_strip(_HEAD('p2'))} ELSE p2 END, CASE WHEN len(p2) > 100 THEN 4 ELSE 3 END,
    CASE WHEN len(p2) > 100 THEN 'second_para_sentence' ELSE 'second_para' END, area FROM areas
    WHERE NOT coalesce({_fit('p1')}, false) AND {_fit('p2')} AND (len(p2) <= 100 OR len({_HEAD('p2')}) >= 40)
  UNION ALL SELECT doc_id, lead, 7, 'intro', 20 FROM g2 WHERE lang = 'en' AND {sql_valid('lead')})"""
BEST_CTE = """
best AS (SELECT doc_id, rtrim(text, '.…') AS t0 FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, abs(len(text) - 100), ord) AS rn FROM cand) WHERE rn = 1),
sub AS (SELECT doc_id, CASE WHEN trim(t0) = '' OR regexp_matches(trim(t0), '[.!?]$') THEN trim(t0) ELSE trim(t0) || '.' END AS best_subtitle FROM best)"""


@query("c19_subtitle_candidates", with_press("SELECT doc_id AS page_id, text, score, source FROM cand", CANDIDATES_CTE))
def c19(spark, sf):
    return press(spark, sf).select("page_id", F.inline(P.subtitle_candidates(RULES.blacklist)))


@query("c20_best_subtitle", with_press("SELECT doc_id AS page_id, best_subtitle AS subtitle FROM p LEFT JOIN sub USING (doc_id)", CANDIDATES_CTE, BEST_CTE))
def c20(spark, sf):
    found = let(press(spark, sf), candidates=P.subtitle_candidates(RULES.blacklist))
    return P.best_subtitle(found).select("page_id", "subtitle")


# the same pages with a description that counts, and for English a marked text in the last kind of area
STRONG = "An emphasised beginning of some forty and more characters"
STRONG_CTE = CANDIDATES_CTE.replace("list_concat(string_split(content, chr(10)),", f"list_concat(CASE WHEN lang = 'en' THEN [{lit(STRONG)}] ELSE [] END, string_split(content, chr(10)),") + f""",
cand2 AS (SELECT doc_id, text, score, source FROM cand
  UNION ALL SELECT doc_id, sub, 8, 'meta' FROM g2 WHERE {sql_valid('sub')} UNION ALL SELECT doc_id, {lit(STRONG)}, 5, 'strong' FROM g2 WHERE lang = 'en')"""


def strong_pages(spark, sf):
    html = F.replace("html", F.lit('<meta property="og:description" content="old">'), F.lit(""))
    marked = F.replace(html, F.lit('<div class="entry-content">'), F.lit(f'<div class="post-content"><p><b>{STRONG}</b></p>'))
    return press_pages(spark, sf).withColumn("html", marked)


SUB21 = "CASE WHEN lang = 'de' AND len(lead) > 20 AND len(lead) < 300 THEN lead END"


@query("c21_subtitle_cascade", with_press(f"SELECT doc_id AS page_id, {SUB21} AS subtitle FROM p"))
def c21(spark, sf):
    return press(spark, sf).select("page_id", P.subtitle_cascade().alias("subtitle"))


# --- body -------------------------------------------------------------------------------
_LINES = f"list_transform(string_split(content, chr(10)), lambda x: {sql_strip('x')})"
_BASIC = f"array_to_string(list_filter({_LINES}, lambda x: len(x) > 15 AND NOT {sql_any('lower(x)', fv.BODY_SKIP_TERMS)}), ' ')"
_NOISE = sql_list([SHARE, SCRIPTED, ADVERT])
# paragraphs before the text: an intro, or a subtitle
_BEFORE = "CASE WHEN lang IN ('en', 'de') THEN [lead] ELSE [] END"
_FALLBACK = f"array_to_string(list_filter(list_concat({_BEFORE}, {_LINES}, {_NOISE}), lambda x: len(x) > 20), ' ')"
BODY_SQL = f"nullif(CASE WHEN lang = 'es' THEN {_FALLBACK} ELSE {_BASIC} END, '')"


@query("c22_body_basic", with_press(f"SELECT doc_id AS page_id, md5(CASE WHEN lang <> 'es' THEN nullif({_BASIC}, '') END) AS digest FROM p"))
def c22(spark, sf):
    """The rule of known containers on every page; a page without one has no such body."""
    found = let(press(spark, sf), box=P.first_element(P.BODY_BASIC))
    text = F.when(F.col("box").isNotNull(), F.nullif(P.body_basic("box"), F.lit("")))
    return found.select("page_id", F.md5(text).alias("digest"))


@query("c23_body_fallback", with_press(f"SELECT doc_id AS page_id, md5({_FALLBACK}) AS digest FROM p"))
def c23(spark, sf):
    """The rule of all paragraphs on every page, known container or not."""
    return press(spark, sf).select("page_id", F.md5(P.body_fallback()).alias("digest"))


@query("c23_body_either", with_press(f"SELECT doc_id AS page_id, md5({BODY_SQL}) AS digest FROM p"))
def c23_either(spark, sf):
    return P.body_of(press(spark, sf)).select("page_id", F.md5("content").alias("digest"))


# pages: a paragraph ends at its end tag, at the next paragraph or with its parent
_PARAGRAPHS = f"""
q AS (SELECT page_id, unnest(string_split(regexp_extract(html, '(?s)<article>(.*)$', 1), '<p>')[2:]) AS chunk,
  generate_subscripts(string_split(regexp_extract(html, '(?s)<article>(.*)$', 1), '<p>')[2:], 1) AS i FROM pages),
t AS (SELECT page_id, i, array_to_string(list_transform(string_split_regex(regexp_replace(chunk, '(?s)(</p>|</article>|<footer>).*$', ''), '<!--.*?-->|</?[a-z][^>]*>'),
  lambda x: {sql_strip(sql_unescape('x'))}), '') AS txt FROM q),
b AS (SELECT page_id, string_agg(txt, ' ' ORDER BY i) FILTER (len(txt) > 20) AS body FROM t GROUP BY page_id)"""


@query("c23_body_fallback_pages", f"WITH {_PARAGRAPHS} SELECT page_id, md5(body) AS digest, len(body) AS n FROM b RIGHT JOIN pages USING (page_id)")
def c23_pages(spark, sf):
    return P.body_of(dom(spark, sf)).select("page_id", F.md5("content").alias("digest"), F.length("content").cast("bigint").alias("n"))


_CASCADE = f"nullif(array_to_string(list_filter(list_concat({_LINES}, {sql_list([SHARE, SCRIPTED])}), lambda x: x <> '' AND NOT {sql_any('lower(x)', fv.CASCADE_SKIP_TERMS)}), ' '), '')"


@query("c24_body_cascade", with_press(f"SELECT doc_id AS page_id, CASE WHEN lang <> 'es' THEN md5({_CASCADE}) END AS digest FROM p"))
def c24(spark, sf):
    return press(spark, sf).select("page_id", F.md5(P.body_cascade()).alias("digest"))


def _alternative_sql() -> str:
    inner = "regexp_replace(regexp_extract(html, '(?s)<article>(.*)$', 1), '(?s)(</article>|<footer>).*$', '')"
    pieces = f"list_filter(list_transform(string_split_regex({inner}, '<!--.*?-->|</?[a-z][^>]*>'), lambda x: {sql_strip(sql_unescape('x'))}), lambda x: x <> '')"
    text = f"regexp_replace(array_to_string({pieces}, ' '), {WS_SQL}, ' ', 'g')"
    for phrase in P.stop_phrases(SITE):
        text = f"split_part({text}, {lit(phrase)}, 1)"
    return f"SELECT page_id, url, CASE WHEN len(x) > 100 THEN x END AS body FROM (SELECT page_id, url, {text} AS x FROM pages)"


@query("c25_body_alternative", f"SELECT page_id, md5(body) AS digest, len(body) AS n FROM ({_alternative_sql()})")
def c25(spark, sf):
    t = let(dom(spark, sf), body=P.body_alternative(SITE))
    return t.select("page_id", F.md5("body").alias("digest"), F.length("body").cast("bigint").alias("n"))


# --- metadata and whole-page tests --------------------------------------------------------
@query("c26_page_metadata", with_press(f"""
SELECT doc_id AS page_id, CASE WHEN lang = 'en' THEN 5 ELSE 1 END::BIGINT AS n_keys, subtitle AS description,
  CASE WHEN lang = 'en' THEN title || ' | Site' END AS og_title, CASE WHEN lang = 'de' THEN '{{"id": ' || doc_id || '}}' END AS json_ld FROM p"""))
def c26(spark, sf):
    m = F.col("metadata")
    return P.with_metadata(press(spark, sf)).select(
        "page_id", F.size(m).cast("bigint").alias("n_keys"), F.try_element_at(m, F.lit("og:description")).alias("description"),
        F.try_element_at(m, F.lit("og:title")).alias("og_title"), "json_ld",
    )


def HTML_TERMS_SQL(bl: Blacklist) -> str:
    return f"""CASE WHEN NOT list_contains({sql_list(bl.allowed_langs)}, lang) THEN 'lang' WHEN {sql_count(_LOW, bl.html_title_a)} >= 2 OR {sql_any(_LOW, bl.html_title_b)} THEN 'title'
  WHEN {sql_any("'single post-' || source", U.slugs(bl.terms))} THEN 'class' END"""


_HTML_BL = Blacklist(allowed_langs=("fr", "de"), terms=("post src1",))
_LOW = "lower(title || ' | Site')"
HTML_SQL = f"""CASE WHEN lang NOT IN ('fr', 'de') THEN 'lang' WHEN {sql_count(_LOW, fv.HTML_TITLE_TERMS_A)} >= 2 OR {sql_any(_LOW, fv.HTML_TITLE_TERMS_B)} THEN 'title'
  WHEN contains('single post-' || source, 'post-src1') THEN 'class' END"""


@query("c27_foreign_by_html", with_press(f"SELECT doc_id AS page_id, {HTML_SQL} AS html_reason, {HTML_SQL} IS NOT NULL AS html_foreign FROM p"))
def c27(spark, sf):
    return P.foreign_by_html(press(spark, sf), _HTML_BL).select("page_id", "html_reason", "html_foreign")


@query("c27_foreign_by_lang", "SELECT page_id, regexp_extract(html, '<html lang=\"([^\"]*)\"', 1) NOT IN ('fr', 'es') AS html_foreign FROM pages")
def c27_pages(spark, sf):
    bl = Blacklist(allowed_langs=("fr", "es"), html_title_a=(), html_title_b=(), terms=())
    return P.foreign_by_html(dom(spark, sf), bl).select("page_id", "html_foreign")


@query("c28_title_reject", with_articles(f"SELECT doc_id, {sql_any('lower(title)', fv.TITLE_REJECTS)} AS hit FROM a"))
def c28(spark, sf):
    return articles(spark, sf).select("doc_id", U.title_reject("title", RULES.blacklist).alias("hit"))


@query("c29_body_and_error", f"""SELECT page_id, md5(body) AS digest, CASE WHEN body IS NULL THEN 'No content extracted' END AS error FROM ({_alternative_sql()})""")
def c29(spark, sf):
    return P.with_body_and_error(dom(spark, sf), SITE).select("page_id", F.md5("content").alias("digest"), "error")


# --- assembly -----------------------------------------------------------------------------
def scrape_cte(rules: Rules, pages_sql: str = PRESS_SQL) -> str:
    """CTEs up to ``z``: every derived page with its reject reason."""
    bl, lex = rules.blacklist, rules.lexicon
    html = f"{sql_count(_LOW, bl.html_title_a)} >= 2 OR {sql_any(_LOW, bl.html_title_b)} OR NOT list_contains({sql_list(bl.allowed_langs)}, lang)"
    return ", ".join((
        f"p AS ({pages_sql})", CANDIDATES_CTE, BEST_CTE,
        f"f AS (SELECT doc_id, {TITLE3} AS title3, {BODY_SQL} AS body, ({html}) AS html_bad FROM p)",
        verdict_cte("SELECT doc_id, coalesce(title3, 'N/A') AS title, coalesce(body, '') AS content, title3, html_bad FROM f", lex), sample_cte(lex),
        f"""z AS (SELECT v.*, CASE WHEN {blacklist_sql('page_url', "''", bl)} IS NOT NULL THEN 'url_blacklist'
  WHEN html_bad THEN 'html_foreign' WHEN {blacklist_sql('page_url', "coalesce(title3, '')", bl)} IS NOT NULL THEN 'title_blacklist'
  WHEN title3 IS NOT NULL AND {sql_any('lower(title3)', [t.lower() for t in bl.title_rejects])} THEN 'title_reject'
  WHEN v.content = '' THEN 'empty_body' WHEN {sql_count('lower(v.content)', lex.terms_b)} > {lex.max_substrings} THEN 'indicator_terms'
  WHEN foreign_reason IS NOT NULL THEN 'language' WHEN mid THEN 'mid_sample' END AS reject_reason
  FROM v JOIN (SELECT doc_id, page_url FROM p) USING (doc_id) LEFT JOIN sj USING (doc_id))""",
    ))


SCRAPE_CTE = scrape_cte(RULES)


# a page with a blacklisted URL is not parsed: only its URL names a category
_UNPARSED = f"CASE WHEN {_BY_URL} IS NOT NULL THEN {_BY_URL} ELSE {sql_standard(f'coalesce({_BY_URL}, {_NAMED})', 'page_url')} END"


@query("c30_scrape_rows", f"""WITH {SCRAPE_CTE}
SELECT doc_id AS page_id, page_url AS url, CASE WHEN parsed THEN title3 END AS title, CASE WHEN parsed THEN {DATE5} END AS date,
  CASE WHEN parsed THEN writer ELSE 'news.example' END AS author, CASE WHEN parsed THEN {CATEGORY_SQL} ELSE {_UNPARSED} END AS category,
  CASE WHEN parsed THEN best_subtitle END AS subtitle, CASE WHEN parsed THEN md5(nullif(z.content, '')) END AS digest, reject_reason
FROM (SELECT *, {RAW11} AS raw FROM p) JOIN (SELECT doc_id, title3, content, reject_reason, reject_reason IS DISTINCT FROM 'url_blacklist' AS parsed FROM z) z USING (doc_id)
  LEFT JOIN sub USING (doc_id)""")
def c30(spark, sf):
    rows = scrape_rows(press_pages(spark, sf), rules=RULES)
    return rows.select("page_id", "url", "title", "date", "author", "category", "subtitle", F.md5("content").alias("digest"), "reject_reason")


@query("c30_reject_counts", f"WITH {SCRAPE_CTE} SELECT reject_reason, count(*) AS n FROM z GROUP BY ALL")
def c30_counts(spark, sf):
    return scrape_rows(press_pages(spark, sf), rules=RULES, columns=("reject_reason",)).groupBy("reject_reason").agg(F.count("*").alias("n"))


@query("c31_extract_rows", f"""
SELECT page_id, url, title, date, 'news.example' AS author, {DEFAULT} AS category, NULL::VARCHAR AS subtitle, digest, error FROM (
  SELECT page_id, url, md5(body) AS digest, CASE WHEN body IS NULL THEN 'No content extracted' END AS error FROM ({_alternative_sql()}))
JOIN (SELECT page_id, {_H1} AS title, NULL::VARCHAR AS date FROM pages) USING (page_id)""")
def c31(spark, sf):
    rows = extract_rows(pages(spark, sf), rules=RULES)
    return rows.select("page_id", "url", "title", "date", "author", "category", "subtitle", F.md5("content").alias("digest"), "error")


@query("c31_extract_press", with_press(f"""
SELECT doc_id AS page_id, {TITLE4} AS title, {DATE6} AS date,
  CASE WHEN lang IN ('en', 'fr') THEN writer ELSE 'news.example' END AS author,
  CASE WHEN lang IN ('en', 'de') THEN section ELSE {DEFAULT} END AS category, {SUB21} AS subtitle FROM p"""))
def c31_press(spark, sf):
    return extract_rows(press_pages(spark, sf), rules=RULES, columns=("page_id", "title", "date", "author", "category", "subtitle"))


# --- statistics over pages ----------------------------------------------------------------
@query("g13_extraction_stats", f"""SELECT count(*) AS total_attempted, count(body) AS successful_scrapes, count(*) - count(body) AS failed_scrapes,
  count(*) - count(body) AS empty_content FROM ({_alternative_sql()})""")
def g13(spark, sf):
    return stats.extraction_stats(extract_rows(pages(spark, sf), rules=RULES, columns=("content", "error")))


@query("g14_batch_tallies", f"""WITH {SCRAPE_CTE}
SELECT batch_no, count(*) AS processed, count(*) FILTER (reject_reason IS NULL) AS successful, count(reject_reason) AS skipped
FROM z JOIN (SELECT doc_id, batch_no FROM p) USING (doc_id) GROUP BY batch_no""")
def g14(spark, sf):
    batch = articles(spark, sf).select(F.col("doc_id").alias("page_id"), "batch_no")
    return stats.batch_tallies(scrape_rows(press_pages(spark, sf), rules=RULES, columns=("page_id", "reject_reason")).join(batch, "page_id"))


# --- flagship -----------------------------------------------------------------------------
@query("flagship_page_archive", f"""WITH b AS ({_alternative_sql()}),
{verdict_cte(f"SELECT page_id AS doc_id, pages.url, {_H1} AS title, coalesce(body, '') AS content, regexp_extract(pages.url, '^https?://[^/?#]*/([a-z]+)', 1) AS lang, regexp_extract(pages.url, '^https?://[^/]*([^?#]*)', 1) AS path FROM pages JOIN b USING (page_id)")},
k AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY lang, doc_id) AS rn FROM v)
SELECT CASE WHEN grouping(lang, f) = 0 THEN 'file' WHEN grouping(lang, f) = 1 THEN 'dir' ELSE 'all' END AS level, lang AS batch_dir, f AS file,
  count(*) AS total_processed, count(*) FILTER (foreign_reason IS NULL) AS local_articles, count(*) FILTER (foreign_reason IS NOT NULL) AS foreign_articles,
  CASE WHEN grouping(lang, f) = 3 THEN count(DISTINCT lang) END AS batch_dirs_processed
FROM (SELECT *, regexp_extract(path, '[^/]*/?$') AS f FROM k WHERE rn = 1) GROUP BY ROLLUP (lang, f)""")
def flagship(spark, sf):
    """Pages -> extracted articles -> language -> first seen by path -> counts."""
    rows = extract_rows(pages(spark, sf), rules=RULES, columns=("page_id", "url", "title", "content"))
    path = F.regexp_extract("url", "^https?://[^/]*([^?#]*)", 1)
    keyed = rows.select(
        "page_id", "title", "content", path.alias("path"),
        F.regexp_extract("url", "^https?://[^/?#]*/([a-z]+)", 1).alias("batch_dir"),
    ).withColumn("file", F.regexp_extract("path", "[^/]*/?$", 0))
    judged = language_verdict(keyed, lex=LEX).select("page_id", "path", "batch_dir", "file", "is_foreign")
    return filter_rollup(first_rows(judged, key="path", order=("batch_dir", "page_id")))


