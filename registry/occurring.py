"""Rules again with terms that occur in the given tables, so that every branch is taken.

The default terms are those of one news portal; few of them occur in the invented texts.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from pressline.functions import language as L
from pressline.functions import urls as U
from pressline.functions.text import let
from pressline.operators import dedup, fields, links, records
from pressline.operators import language as OP
from pressline.params import Blacklist, Lexicon, Rules
from pressline.plans.articles import scrape_rows
from pressline.sources.dom import parse_pages
from registry.common import ARTICLES_SQL, ALL_LANGS, SITE, articles, query, sql_any, sql_count, table, with_articles
from registry.language import verdict_cte
from registry.links import blacklist_sql
from registry.pages import HREF, HTML_TERMS_SQL, NO_TERMS, STRONG_CTE, WANTED, strong_pages, scrape_cte, with_press
from registry.press import press_pages
from registry.records import FIRST_SQL, raw_sql

# one of each kind: whole words, parts of words, words across a blank
LEX = Lexicon(
    title_keywords=("de de", "heitung"), phrases_b=("and, the", "ndtionan thshwh"), phrases_a=("de dans", "der die", "los la"), max_substrings=5)
BL = Blacklist(
    urls=("https://news.example/post-17/",), terms=("the anea", "post 2", "is the"), title_starters=("and the",), title_indicator_min=2,
    title_rejects=("eau", "the the"), lang_paths=("/2024/05/to-", "/post-3"), html_title_a=("hat", "ing", "ou"), html_title_b=("keit", "attion to"),
    allowed_langs=ALL_LANGS)
RULES = Rules(site=SITE, lexicon=LEX, blacklist=BL)


@query("e1_title_keyword_occurring", with_articles(f"SELECT doc_id, {sql_any('lower(title)', LEX.title_keywords)} AS hit FROM a"))
def e1(spark, sf):
    return articles(spark, sf).select("doc_id", L.title_keyword("title", LEX).alias("hit"))


@query("e10_body_terms_occurring", with_articles(f"""SELECT doc_id, {sql_any('lower(content)', LEX.phrases_b)} AS e2, {sql_any('lower(content)', LEX.phrases)} AS e6,
  {sql_count('lower(content)', LEX.terms_b)} > 5 AS e10 FROM a"""))
def e10(spark, sf):
    found = let(articles(spark, sf), t=L.body_terms(F.lower("content"), LEX))
    hits = {"e2": L.strong_phrase("t.phrases_b"), "e6": L.strong_phrase("t.phrases"), "e10": F.col("t.terms_b") > LEX.max_substrings}
    return found.select("doc_id", *[c.alias(name) for name, c in hits.items()])


@query("e8_reasons_occurring", f"WITH {verdict_cte(ARTICLES_SQL, LEX)} SELECT doc_id, foreign_reason FROM v")
def e8(spark, sf):
    return OP.language_verdict(articles(spark, sf), lex=LEX).select("doc_id", "foreign_reason")


@query("b12_reasons_occurring", with_articles(f"""SELECT doc_id, CASE WHEN url = 'https://news.example/2024/05/in-in-oredble-ea/' THEN 'url' ELSE
  {blacklist_sql('url', 'title', BL)} END AS reason FROM a WHERE url IS NOT NULL"""))
def b12(spark, sf):
    bl = replace(BL, urls=("https://news.example/2024/05/in-in-oredble-ea/",))
    judged = U.with_blacklist_reason(articles(spark, sf).where(F.col("url").isNotNull()), bl, title="title", out="reason")
    return judged.select("doc_id", "reason")


@query("b10_url_term_occurring", f"SELECT page_id, {sql_any('lower(url)', ['-fr', 'm.th'])} AS term, {sql_any('lower(url)', ['/fr/', '/de/'])} AS lang FROM pages")
def b10(spark, sf):
    bl = replace(BL, terms=(" fr", "m.th"), lang_paths=("/fr/", "/de/"))
    return table(spark, sf, "pages").select("page_id", U.url_has_term("url", bl).alias("term"), U.url_lang_path("url", bl).alias("lang"))


@query("b5_content_links_main", with_press(f"SELECT doc_id AS page_id, page_url, {HREF} AS url FROM p WHERE {WANTED}"))
def b5_main(spark, sf):
    """The area of category pages: the same links, in a main content of their own."""
    boxed = F.replace("html", F.lit('<article class="td-module-1">'), F.lit('<div class="x" id="tdi-main-content-2">'))
    dom = parse_pages(press_pages(spark, sf).withColumn("html", boxed))
    return links.content_links(dom, area="main", segments=["2024/"], site=SITE, bl=NO_TERMS)


@query("c27_title_occurring", with_press(f"SELECT doc_id AS page_id, {HTML_TERMS_SQL(BL)} AS html_reason FROM p"))
def c27(spark, sf):
    return fields.with_html_reason(parse_pages(press_pages(spark, sf)), BL).select("page_id", "html_reason")


@query("c30_reasons_occurring", f"WITH {scrape_cte(RULES)} SELECT doc_id AS page_id, reject_reason FROM z")
def c30(spark, sf):
    return scrape_rows(press_pages(spark, sf), rules=RULES, columns=("page_id", "reject_reason"))


@query("c30_reasons_without_html", f"""WITH {scrape_cte(RULES)} SELECT doc_id AS page_id,
  CASE WHEN reject_reason = 'url_blacklist' THEN reject_reason ELSE 'no_page' END AS reject_reason FROM z""")
def c30_empty(spark, sf):
    """Pages that came back empty: only the URL can speak against them first."""
    blank = press_pages(spark, sf).withColumn("html", F.when(F.col("page_id") % 2 == 0, "").cast("string"))
    return scrape_rows(blank, rules=RULES, columns=("page_id", "reject_reason"))


@query("c19_meta_and_strong", with_press("SELECT doc_id AS page_id, text, score, source FROM cand2", STRONG_CTE))
def c19(spark, sf):
    return parse_pages(strong_pages(spark, sf)).select("page_id", F.inline(fields.subtitle_candidates(Blacklist())))


@query("d1_unknown_titles", with_articles(f"SELECT doc_id, md5({raw_sql(title='CASE WHEN doc_id % 7 = 0 THEN NULL ELSE title END')}) AS digest FROM a WHERE title <> '' OR doc_id % 7 = 0"))
def d1(spark, sf):
    titled = articles(spark, sf).withColumn("title", F.when(F.col("doc_id") % 7 != 0, F.col("title")))
    return records.render_records(titled, site=SITE).where("raw is not null").select("doc_id", F.md5("raw").alias("digest"))


@query("g1_rows_without_key", f"WITH a AS (SELECT * REPLACE (CASE WHEN doc_id % 10 > 2 THEN url END AS url) FROM ({ARTICLES_SQL})), {FIRST_SQL} SELECT doc_id, url FROM d")
def g1(spark, sf):
    keyed = articles(spark, sf).withColumn("url", F.when(F.col("doc_id") % 10 > 2, F.col("url")))
    return dedup.dedup_first_seen(keyed).select("doc_id", "url")
