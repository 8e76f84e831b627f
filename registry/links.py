"""Links and URLs: extraction, filters, seeds, resume, reachability."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from pressline import fixed_values as fv
from pressline.functions import urls as U
from pressline.operators import batches, graph, links
from pressline.params import Blacklist
from pressline.plans.links import link_run, read_batches
from pressline.session import new_path
from pressline.sources import readers, sinks
from pressline.sources.dom import parse_pages
from registry.common import (
    ARTICLES_SQL, BL, PAGES_SITE, articles, lit, query, sql_any, sql_count,
    sql_list, sql_starts, table, text_table, with_articles,
)

TODAY = date(2024, 5, 17)


def pages(spark, sf):
    return text_table(spark, sf, "pages", "page_id", "url", "html")


def dom(spark, sf):
    return parse_pages(pages(spark, sf))


# page anchors, their hrefs being root-relative in the fixture
ANCHORS_SQL = """
h AS (SELECT page_id, url AS page_url, regexp_extract(url, '^https?://[^/?#]*') AS origin,
  unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages),
l AS (SELECT DISTINCT page_id, page_url, origin || replace(replace(href, '&quot;', '"'), '&amp;', '&') AS url FROM h)"""


@query("b1_extract_links", f"WITH {ANCHORS_SQL} SELECT page_id, page_url, url FROM l")
def b1(spark, sf):
    return links.extract_links(dom(spark, sf)).select("page_id", "page_url", "url")


@query("b1_url_join", """
WITH h AS (SELECT page_id, regexp_extract(url, '^https?://[^/?#]*') AS o, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS p,
  regexp_extract(url, '^[^#]*') AS nofrag, regexp_extract(url, '^(https?):', 1) AS s FROM pages),
d AS (SELECT *, regexp_extract(p, '^.*/') AS dir FROM h)
SELECT page_id, o || dir || 'a' AS rel, o || '/a' AS root, s || '://other.example/a' AS net,
  o || p || '?q=1' AS query, nofrag || '#f' AS frag,
  o || CASE WHEN dir = '/' THEN '/' ELSE regexp_replace(dir, '[^/]*/$', '') END || 'a' AS up
FROM d""")
def b1_join(spark, sf):
    p = table(spark, sf, "pages")
    forms = {"rel": "a", "root": "/a", "net": "//other.example/a", "query": "?q=1", "frag": "#f", "up": "../a"}
    return p.select("page_id", *[U.url_join("url", F.lit(h)).alias(n) for n, h in forms.items()])


_KIND = """CASE WHEN contains(u, '/category/') THEN 'category' WHEN contains(u, '/tag/') THEN 'tag' WHEN contains(u, '/author/') THEN 'author' END"""
# page URLs with their language segment spelled as a listing kind
_KIND_URLS = "SELECT page_id, replace(replace(replace(url, '/en/', '/category/'), '/fr/', '/tag/'), '/de/', '/author/') AS u FROM pages"


def kind_urls(spark, sf):
    u = F.col("url")
    for a, b in (("/en/", "/category/"), ("/fr/", "/tag/"), ("/de/", "/author/")):
        u = F.replace(u, F.lit(a), F.lit(b))
    return table(spark, sf, "pages").select("page_id", u.alias("u"))


@query("b2_link_kind", f"SELECT page_id, u, {_KIND} AS kind FROM ({_KIND_URLS})")
def b2(spark, sf):
    return kind_urls(spark, sf).withColumn("kind", U.link_kind("u"))


def _article_sql(u: str, domain: str) -> str:
    inc = " OR ".join(f"regexp_matches({u}, {lit(p)})" for p in fv.ARTICLE_INCLUDES)
    exc = " OR ".join(f"regexp_matches({u}, {lit(p)})" for p in fv.ARTICLE_EXCLUDES)
    slug = f"(contains({u}, {lit(domain)}) AND ends_with({u}, '/') AND len({u}) - len(replace({u}, '/', '')) >= 4)"
    return f"(({inc} OR {slug}) AND NOT ({exc}))"


@query("b3_is_article_url", f"""
SELECT page_id, {_article_sql('url', PAGES_SITE.domain)} AS is_article, {_article_sql('u', PAGES_SITE.domain)} AS kind_is_article
FROM pages JOIN ({_KIND_URLS}) USING (page_id)""")
def b3(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url").join(kind_urls(spark, sf), "page_id")
    return p.select(
        "page_id", U.is_article_url("url", PAGES_SITE).alias("is_article"),
        U.is_article_url("u", PAGES_SITE).alias("kind_is_article"),
    )


@query("b6_drop_blacklisted_urls", "SELECT page_id, url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE contains(url, 'spam'))")
def b6(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    return links.drop_blacklisted_urls(p, p.where(F.contains("url", F.lit("spam")))).select("page_id", "url")


@query("b7_title_starts_foreign", with_articles(f"SELECT doc_id, {sql_starts('lower(title)', BL.title_starters)} AS hit FROM a"))
def b7(spark, sf):
    return articles(spark, sf).select("doc_id", U.title_starts_foreign("title", BL).alias("hit"))


@query("b8_title_indicator_count", with_articles(f"SELECT doc_id, {sql_count('lower(title)', BL.title_indicators)} AS n FROM a"))
def b8(spark, sf):
    return articles(spark, sf).select("doc_id", U.title_indicator_count("title", BL).alias("n"))


@query("b9_title_has_term", with_articles(f"SELECT doc_id, {sql_any('lower(title)', BL.terms)} AS hit FROM a"))
def b9(spark, sf):
    return articles(spark, sf).select("doc_id", U.title_has_term("title", BL).alias("hit"))


# "the or" etc. occur in the fixture's slugs, so the slugged terms really match
TERMS = Blacklist(terms=("the the", "of the", "la la", "der er"))


@query("b10_url_has_term", with_articles(f"SELECT doc_id, {sql_any('lower(url)', U.slugs(TERMS.terms))} AS hit FROM a WHERE url IS NOT NULL"))
def b10(spark, sf):
    return articles(spark, sf).where(F.col("url").isNotNull()).select("doc_id", U.url_has_term("url", TERMS).alias("hit"))


@query("b11_url_lang_path", f"SELECT page_id, {sql_any('lower(url)', BL.lang_paths)} AS hit FROM pages")
def b11(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.url_lang_path("url", BL).alias("hit"))


def blacklist_sql(url: str, title: str, bl: Blacklist) -> str:
    return f"""CASE WHEN {title} <> '' AND {sql_starts(f'lower({title})', bl.title_starters)} THEN 'title_start'
  WHEN {title} <> '' AND {sql_count(f'lower({title})', bl.title_indicators)} >= {bl.title_indicator_min} THEN 'title_indicators'
  WHEN {title} <> '' AND {sql_any(f'lower({title})', bl.terms)} THEN 'title_term'
  WHEN {sql_any(f'lower({url})', U.slugs(bl.terms))} THEN 'url_term'
  WHEN {sql_any(f'lower({url})', bl.lang_paths)} THEN 'url_lang' END"""


@query("b12_blacklist_reason", with_articles(f"SELECT doc_id, {blacklist_sql('url', 'title', TERMS)} AS blacklist_reason FROM a WHERE url IS NOT NULL"))
def b12(spark, sf):
    judged = U.with_blacklist_reason(articles(spark, sf).where(F.col("url").isNotNull()), TERMS, title="title")
    return judged.select("doc_id", "blacklist_reason")


@query("b13_filter_links", f"""
SELECT page_id, u AS url FROM ({_KIND_URLS}) WHERE NOT contains(u, '/author/') AND NOT contains(u, '/tag/')
  AND contains(u, {lit(PAGES_SITE.domain)}) AND NOT {sql_any('lower(u)', U.slugs(BL.terms))}
  AND NOT {sql_any('lower(u)', BL.lang_paths)} AND NOT {sql_any('lower(u)', BL.url_patterns)}""")
def b13(spark, sf):
    return links.filter_links(kind_urls(spark, sf).withColumnRenamed("u", "url"), site=PAGES_SITE)


_LISTING_SQL = """(SELECT DISTINCT n_name AS category, 'https://news.example/category/' || lower(n_name) || '/' AS url
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0)"""


def listing(spark, sf):
    """Listings of the nations that have a supplier in credit."""
    s = table(spark, sf, "supplier").where("s_acctbal > 0").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    url = F.concat(F.lit("https://news.example/category/"), F.lower("n_name"), F.lit("/"))
    return s.select(F.col("n_name").alias("category"), url.alias("url")).distinct()


@query("b14_category_seeds", f"SELECT category, url, true AS known FROM {_LISTING_SQL} UNION ALL SELECT n_name, NULL, false FROM nation WHERE n_name NOT IN (SELECT category FROM {_LISTING_SQL})")
def b14(spark, sf):
    names = table(spark, sf, "nation").select(F.col("n_name").alias("category"))
    known = links.category_seeds(names, listing(spark, sf)).withColumn("known", F.lit(True))
    unknown = links.unknown_categories(names, listing(spark, sf))
    return known.unionByName(
        unknown.select("category", F.lit(None).cast("string").alias("url"), F.lit(False).alias("known"))
    )


@query("b15_page_seeds", f"""
SELECT category, page, CASE WHEN page = 1 THEN url ELSE url || 'page/' || page || '/' END AS url
FROM {_LISTING_SQL}, range(1, 41) r(page)""")
def b15(spark, sf):
    return links.page_seeds(listing(spark, sf), max_pages=40).withColumn("page", F.col("page").cast("bigint"))


_SITES = "(SELECT DISTINCT regexp_extract(url, '^https?://[^/?#]*') AS base FROM pages)"


def sites(spark, sf):
    return table(spark, sf, "pages").select(F.regexp_extract("url", "^https?://[^/?#]*", 0).alias("base")).distinct()


@query("b16_archive_seeds", f"""
WITH m AS (SELECT base, y, m, lpad(m::VARCHAR, 2, '0') AS mm FROM {_SITES}, range(2022, 2025) t(y), range(1, 13) u(m)
  WHERE y < 2024 OR m <= 5),
s AS (SELECT base, y, m, unnest([0, 1, 2, 3]) AS shape, unnest([base || '/' || y || '/' || mm || '/', base || '/archive/' || y || '/' || mm || '/',
  base || '/archives/' || y || '/' || mm || '/', base || '/' || y || '/' || m || '/']) AS url FROM m)
SELECT base, y::INTEGER AS year, m::INTEGER AS month, shape::INTEGER AS shape, page::INTEGER AS page,
  CASE WHEN page = 1 THEN url ELSE url || 'page/' || page || '/' END AS url FROM s, range(1, 4) p(page)""")
def b16(spark, sf):
    return links.archive_seeds(
        sites(spark, sf), start_year=2022, end_year=2026, today=TODAY, shapes=fv.ARCHIVE_SHAPES, month_pages=3
    )


def _forms(templates, terms):
    parts = []
    for t in templates:
        head, tail = t.removeprefix("{base}").split("{term}")
        parts.append(f"SELECT base || {lit(head)} || term || {lit(tail)} AS url FROM {_SITES}, (SELECT unnest({sql_list(terms)}) AS term)")
    return " UNION ".join(parts)


@query("b17_search_seeds", _forms(fv.SEARCH_TEMPLATES, fv.SEARCH_TERMS))
def b17_search(spark, sf):
    return links.search_seeds(sites(spark, sf))


@query("b17_listing_url_candidates", f"""
SELECT DISTINCT kind, u AS url FROM (SELECT u, {_KIND} AS kind FROM ({_KIND_URLS})) WHERE kind IS NOT NULL
UNION SELECT 'category', url FROM ({_forms(fv.CATEGORY_TEMPLATES, fv.COMMON_CATEGORY_SLUGS)})""")
def b17_listings(spark, sf):
    seen = kind_urls(spark, sf).select(F.col("u").alias("url"), U.link_kind("u").alias("kind"))
    return links.listing_url_candidates(sites(spark, sf), seen)


@query("b17_well_known_urls", f"SELECT base || unnest({sql_list(fv.WELL_KNOWN_PATHS)}) AS url FROM {_SITES}")
def b17_known(spark, sf):
    return links.well_known_urls(sites(spark, sf))


@query("b19_article_page_links", f"""
WITH {ANCHORS_SQL}, q AS (SELECT page_id, page_url, url || '/7/' AS url FROM l)
SELECT page_id, page_url, url FROM q WHERE {_article_sql('url', PAGES_SITE.domain)}""")
def b19(spark, sf):
    # the fixture has no paged links: its anchors get a page number appended
    p = table(spark, sf, "pages")
    paged = p.withColumn("html", F.regexp_replace("html", r'<a href="([^"]*)"', '<a href="$1/7/"'))
    return links.article_page_links(parse_pages(paged), site=PAGES_SITE)


# --- resume and set operations -------------------------------------------------------
_LINKS = "SELECT 'o' || o_orderkey AS url, CAST(o_custkey % 50 AS INTEGER) AS batch_no FROM orders"
_DONE = "SELECT DISTINCT 'o' || l_orderkey AS url, CAST(o_custkey % 50 AS INTEGER) AS batch_no FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'"


def link_columns(orders):
    """Orders as links: the key is the URL, the customer decides the batch."""
    return orders.select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("url"), (F.col("o_custkey") % 50).cast("int").alias("batch_no")
    )


def order_links(spark, sf):
    return link_columns(table(spark, sf, "orders"))


def done_links(spark, sf):
    returned = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("url")
    )
    return order_links(spark, sf).join(returned, "url", "left_semi").select("batch_no", "url")


@query("j1_remaining", f"SELECT l.batch_no, l.url FROM ({_LINKS}) l ANTI JOIN ({_DONE}) d USING (batch_no, url)")
def j1(spark, sf):
    return links.remaining(order_links(spark, sf), done_links(spark, sf)).select("batch_no", "url")


@query("j2_advance_progress", f"SELECT batch_no, url FROM ({_DONE}) UNION SELECT batch_no, url FROM ({_LINKS}) JOIN orders ON url = 'o' || o_orderkey WHERE o_orderstatus = 'F'")
def j2(spark, sf):
    filled = table(spark, sf, "orders").where("o_orderstatus = 'F'")
    return links.advance_progress(done_links(spark, sf), link_columns(filled))


@query("j3_union_links", f"WITH {ANCHORS_SQL} SELECT url FROM pages UNION SELECT url FROM l UNION SELECT base FROM {_SITES}")
def j3(spark, sf):
    return links.union_links(
        table(spark, sf, "pages"), links.extract_links(dom(spark, sf)), sites(spark, sf).withColumnRenamed("base", "url")
    )


_EDGES = "(SELECT DISTINCT 'p' || l_partkey AS src, 'p' || l_suppkey AS dst FROM lineitem WHERE l_partkey <> l_suppkey)"


def edges(spark, sf):
    node = lambda c: F.concat(F.lit("p"), F.col(c).cast("string"))
    return table(spark, sf, "lineitem").select(node("l_partkey").alias("src"), node("l_suppkey").alias("dst"))


@query("j4_next_frontier", f"""
SELECT DISTINCT dst AS url FROM {_EDGES} WHERE dst NOT IN (SELECT 'p' || p_partkey FROM part WHERE p_size > 40)
  AND dst NOT IN (SELECT 'p' || p_partkey FROM part WHERE p_size < 5)""")
def j4(spark, sf):
    part = table(spark, sf, "part").withColumn("url", F.concat(F.lit("p"), F.col("p_partkey").cast("string")))
    return links.next_frontier(
        edges(spark, sf).select(F.col("dst").alias("url")), part.where("p_size > 40"), part.where("p_size < 5")
    )


@query("j5_reachable", f"""
WITH RECURSIVE e AS (SELECT * FROM {_EDGES}), r(url, depth) AS (
  SELECT 'p' || p_partkey, CASE WHEN p_size = 50 THEN 0 ELSE 1 END FROM part WHERE p_size IN (49, 50)
  UNION SELECT dst, depth + 1 FROM r JOIN e ON src = url WHERE depth < 3)
SELECT url, min(depth)::BIGINT AS depth FROM r GROUP BY url""")
def j5(spark, sf):
    seeds = table(spark, sf, "part").where("p_size in (49, 50)").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("url"),
        F.when(F.col("p_size") == 50, 0).otherwise(1).alias("depth"),
    )
    return graph.reachable(edges(spark, sf), seeds, max_depth=3)


_FETCHED = "(SELECT 'p' || p_partkey AS url FROM part WHERE p_partkey % 3 <> 0)"


@query("j5_reachable_capped", f"""
WITH RECURSIVE e AS (SELECT * FROM {_EDGES}), f AS {_FETCHED}, r(url, depth) AS (
  SELECT 'p' || p_partkey, CASE WHEN p_size = 50 THEN 0 ELSE 1 END FROM part WHERE p_size IN (49, 50) AND 'p' || p_partkey IN (SELECT url FROM f)
  UNION SELECT dst, depth + 1 FROM r JOIN e ON src = r.url WHERE depth < 4 AND dst IN (SELECT url FROM f)),
d AS (SELECT url, min(depth)::BIGINT AS depth FROM r GROUP BY url)
SELECT url, depth FROM (SELECT *, row_number() OVER (ORDER BY depth, url) AS n, count(*) OVER () AS total FROM d) WHERE n <= 60""")
def j5_capped(spark, sf):
    """Only pages that have content, and the first 60 of them."""
    node = F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("url")
    part = table(spark, sf, "part")
    seeds = part.where("p_size in (49, 50)").select(node, F.when(F.col("p_size") == 50, 0).otherwise(1).alias("depth"))
    return graph.reachable(edges(spark, sf), seeds, max_depth=4, cap=60, fetched=part.where("p_partkey % 3 <> 0").select(node))


@query("j6_lookup_equi", """SELECT doc_id, item_id FROM documents JOIN (SELECT split_part(text, ' ', 1) AS term, min(item_id) AS item_id FROM benchmark GROUP BY 1)
ON split_part(documents.text, ' ', 1) = term""")
def j6(spark, sf):
    # one rule per first word: a lookup table has unique keys
    rules = table(spark, sf, "benchmark").groupBy(F.substring_index("text", " ", 1).alias("term")).agg(F.min("item_id").alias("item_id"))
    docs = table(spark, sf, "documents").select("doc_id", F.substring_index("text", " ", 1).alias("first"))
    return links.lookup(docs, rules, column="first").select("doc_id", "item_id")


_RULES = (("tion", "tion"), ("eux", "eux"), ("ung", "ung"), ("os", "os"))


@query("j6_lookup_contains", "SELECT doc_id, CASE " + " ".join(f"WHEN contains(lower(text), {lit(t)}) THEN {lit(v)}" for t, v in _RULES) + " END AS value FROM documents")
def j6_contains(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.lower("text").alias("low"))
    return links.lookup_contains(docs, _RULES, column="low").select("doc_id", "value")


# --- link files -------------------------------------------------------------------------


def article_urls(spark, sf):
    return articles(spark, sf).where(F.col("url").isNotNull()).select("batch_no", "url")


def link_files(spark, found, size=100):
    """One row per file of ``size`` links: (batch_no, links)."""
    return batches.assign_batches(found, size=size).groupBy("batch_no").agg(F.collect_list("url").alias("links"))


@query("a1_read_links", f"""
WITH a AS ({ARTICLES_SQL}), u AS (SELECT DISTINCT url FROM a WHERE url IS NOT NULL)
SELECT ((row_number() OVER (ORDER BY url) - 1) // 100 + 1)::INTEGER AS batch_no, url FROM u""")
def a1(spark, sf):
    # one JSON array per batch file, as a collector leaves them
    path = new_path(spark, "links")
    files = link_files(spark, article_urls(spark, sf)).select("batch_no", F.to_json("links").alias("value"))
    files.repartition("batch_no").write.partitionBy("batch_no").text(path)
    read = readers.read_links(spark, path)
    return read.select(F.regexp_extract("file", r"batch_no=(\d+)", 1).cast("int").alias("batch_no"), "url")


@query("a1_read_links_split", with_articles("SELECT DISTINCT url FROM a WHERE url IS NOT NULL"))
def a1_split(spark, sf):
    # a link list of any size: one JSON row for each link, so that a file splits
    path = new_path(spark, "links")
    sinks.write_links(article_urls(spark, sf).select("url").distinct(), path)
    return readers.read_link_rows(spark, path).select("url")


@query("a2_read_link_result", f"""
WITH a AS ({ARTICLES_SQL}), u AS (SELECT DISTINCT url FROM a WHERE url IS NOT NULL),
b AS (SELECT url, (row_number() OVER (ORDER BY url) - 1) // 100 + 1 AS n FROM u)
SELECT url, NULL AS reason FROM u UNION ALL SELECT DISTINCT 'f' || n, '404' FROM b""")
def a2(spark, sf):
    path = new_path(spark, "result")
    result = F.struct(
        "links",
        F.create_map(F.concat(F.lit("f"), F.col("batch_no").cast("string")), F.lit("404")).alias("failed_urls"),
        F.lit("2024-05-17T00:00:00").alias("timestamp"),
    )
    files = link_files(spark, article_urls(spark, sf)).select("batch_no", F.to_json(result, {"pretty": "true"}).alias("value"))
    files.repartition("batch_no").write.partitionBy("batch_no").text(path)
    found, failed, _ = readers.read_link_result(spark, path)
    return found.withColumn("reason", F.lit(None).cast("string")).unionByName(failed)


@query("a7_read_pages", "SELECT page_id, url, md5(html) AS digest FROM pages")
def a7(spark, sf):
    return readers.read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url", F.md5("html").alias("digest"))


@query("a8_read_sitemap", "SELECT DISTINCT url FROM pages")
def a8(spark, sf):
    path = new_path(spark, "sitemap")
    entry = lambda u: F.concat(F.lit("<url><loc>"), F.replace(u, F.lit("&"), F.lit("&amp;")), F.lit("</loc></url>"))
    files = link_files(spark, table(spark, sf, "pages")).select(
        "batch_no",
        F.concat(F.lit("<urlset>"), F.array_join(F.transform("links", entry), "\n"), F.lit("</urlset>")).alias("value"),
    )
    files.repartition("batch_no").write.partitionBy("batch_no").text(path)
    return readers.read_sitemap(spark, path)


@query("a9_parse_robots", """SELECT DISTINCT regexp_extract(url, '^https?://[^/?#]*') || regexp_extract(url, '^https?://[^/?#]*(/[^?#]*)', 1) AS url
FROM pages WHERE contains(url, '/en/') OR contains(url, '/fr/')""")
def a9(spark, sf):
    base = F.regexp_extract("url", "^https?://[^/?#]*", 0)
    path = F.regexp_extract("url", "^https?://[^/?#]*(/[^?#]*)", 1)
    rule = F.when(F.contains("url", F.lit("/en/")), F.concat(F.lit("Disallow: "), path)).when(
        F.contains("url", F.lit("/fr/")), F.concat(F.lit("Allow:"), path)
    ).otherwise(F.concat(F.lit("# "), path))
    text = F.concat(F.lit("User-agent: *\nDisallow:\nAllow: /\n"), rule, F.lit("\n"))
    return readers.parse_robots(table(spark, sf, "pages").select(base.alias("base"), text.alias("value")))


@query("a14_link_sinks", f"""
WITH a AS ({ARTICLES_SQL}), u AS (SELECT DISTINCT url FROM a WHERE url IS NOT NULL),
b AS (SELECT url, ((row_number() OVER (ORDER BY url) - 1) // 100 + 1)::INTEGER AS batch_no FROM u)
SELECT 'links' AS kind, NULL AS batch_no, url FROM u UNION ALL SELECT 'batch', batch_no, url FROM b UNION ALL SELECT 'done', batch_no, url FROM b""")
def a14(spark, sf):
    found = article_urls(spark, sf)
    assigned = batches.assign_batches(found, size=100)
    paths = {k: new_path(spark, k) for k in ("links", "batch", "done")}
    sinks.write_links(links.union_links(found), paths["links"])
    sinks.write_batches(assigned, paths["batch"])
    sinks.write_batches(assigned, paths["batch"])  # a second run replaces the first
    sinks.write_progress(assigned.where("batch_no <= 3"), paths["done"])
    sinks.write_progress(assigned.where("batch_no > 3"), paths["done"])
    schema = "batch_no int, url string"
    rows = [spark.read.schema(schema).json(paths[k]).select(F.lit(k).alias("kind"), "batch_no", "url") for k in ("batch", "done")]
    rows.append(readers.read_link_rows(spark, paths["links"]).select(F.lit("links").alias("kind"), F.lit(None).cast("int").alias("batch_no"), "url"))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])




_RUN_LINKS = f"""WITH {ANCHORS_SQL}, f AS (SELECT url FROM pages UNION SELECT url FROM l),
k AS (SELECT url FROM f WHERE NOT contains(url, '/author/') AND NOT contains(url, '/tag/') AND contains(url, {lit(PAGES_SITE.domain)})
  AND NOT {sql_any('lower(url)', U.slugs(BL.terms))} AND NOT {sql_any('lower(url)', BL.lang_paths)} AND NOT {sql_any('lower(url)', BL.url_patterns)}),
b AS (SELECT url, ((row_number() OVER (ORDER BY url) - 1) // 40 + 1)::INTEGER AS batch_no FROM k)"""


@query("plan_link_run", _RUN_LINKS + """
SELECT batch_no, count(*) AS n_links, count(*) FILTER (NOT (batch_no = 2 OR batch_no % 3 = 0 AND url LIKE '%7')) AS to_do,
  (SELECT count(*) FROM b) AS total_links, (SELECT max(batch_no) FROM b)::BIGINT AS total_batches FROM b GROUP BY batch_no""")
def plan_link_run(spark, sf):
    """Links of the given pages to batches, index and what is left to do, read back by the index."""
    out, ledger = new_path(spark, "link-run"), new_path(spark, "ledger")
    found = [table(spark, sf, "pages").select("url"), links.extract_links(dom(spark, sf)).select("url")]
    link_run(found, out, site=PAGES_SITE, bl=BL, size=40)
    batches = read_batches(spark, f"{out}/link_batches")
    sinks.write_progress(batches.where("batch_no = 2 or batch_no % 3 = 0 and url like '%7'"), ledger)
    counts = link_run(found, out, site=PAGES_SITE, bl=BL, size=40, progress=ledger)
    _, files = readers.read_batch_index(spark, f"{out}/link_batches")
    to_do = read_batches(spark, f"{out}/to_do").groupBy("batch_no").agg(F.count("*").alias("to_do"))
    return files.join(to_do, "batch_no", "left").select(
        "batch_no", "n_links", F.coalesce("to_do", F.lit(0)).alias("to_do"), *[F.lit(counts[k]).cast("bigint").alias(k) for k in ("total_links", "total_batches")])
