"""Batches, run statistics, page sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressline.functions import urls as U
from pressline.operators import batches, links, stats
from registry.common import ARTICLES_SQL, PAGES_SITE, articles, query, table
from registry.links import ANCHORS_SQL, _KIND, _article_sql, dom, order_links

SIZE = 400
BATCHED_SQL = f"SELECT ((row_number() OVER (ORDER BY url) - 1) // {SIZE} + 1)::INTEGER AS batch_no, url FROM (SELECT 'o' || o_orderkey AS url FROM orders)"


def batched(spark, sf):
    return batches.assign_batches(order_links(spark, sf), size=SIZE)


@query("g8_assign_batches", BATCHED_SQL)
def g8(spark, sf):
    return batched(spark, sf)


@query("g9_batch_index", f"SELECT count(*) AS total_links, {SIZE}::BIGINT AS batch_size, count(DISTINCT batch_no) AS total_batches FROM ({BATCHED_SQL})")
def g9(spark, sf):
    return batches.batch_index(batched(spark, sf), size=SIZE)


@query("g9_batch_list", f"SELECT batch_no, 'links_batch_' || batch_no || '.json' AS file, count(*) AS n_links FROM ({BATCHED_SQL}) GROUP BY batch_no")
def g9_list(spark, sf):
    return batches.batch_list(batched(spark, sf))


@query("g10_batch_status", f"""
WITH a AS ({ARTICLES_SQL}), f AS (SELECT batch_no, count(DISTINCT file) AS n FROM a WHERE title <> '' GROUP BY 1),
u AS (SELECT batch_no, count(DISTINCT url) AS n FROM a WHERE url IS NOT NULL GROUP BY 1)
SELECT batch_no, coalesce(f.n, 0) AS output_files, coalesce(u.n, 0) AS processed_urls FROM f FULL JOIN u USING (batch_no)""")
def g10(spark, sf):
    a = articles(spark, sf)
    return batches.batch_status(a.where("title <> ''"), a.where("url is not null").select("batch_no", "url"))


_RESULTS = "SELECT user_id AS batch_no, NOT bool_or(event_type = 'error' AND value > 60) AS success FROM events GROUP BY 1"


def results(spark, sf):
    e = table(spark, sf, "events").select(
        F.col("user_id").alias("batch_no"), ((F.col("event_type") == "error") & (F.col("value") > 60)).alias("failed")
    )
    return batches.batch_results(e)


@query("g11_failed_batches", f"SELECT batch_no FROM ({_RESULTS}) WHERE NOT success")
def g11(spark, sf):
    return batches.failed_batches(results(spark, sf))


@query("g11_success_counts", f"SELECT count(*) FILTER (success) AS successes, count(*) FILTER (NOT success) AS failures, count(*) AS total_batches FROM ({_RESULTS})")
def g11_counts(spark, sf):
    return batches.batch_success_counts(results(spark, sf))


_OUTCOME = "CASE WHEN contains(url, '?') THEN 'failed' WHEN contains(url, '#') THEN 'gone' ELSE 'ok' END"
_SEEN = f"""{ANCHORS_SQL}, s AS (SELECT url AS page_url, url FROM pages UNION ALL SELECT page_url, url FROM l),
y AS (SELECT u AS url, {_KIND} AS kind, {_article_sql('u', PAGES_SITE.domain)} AS is_article FROM
  (SELECT replace(replace(url, '/en/', '/category/'), '/fr/', '/tag/') AS u FROM s))"""


@query("g12_collector_stats", f"""WITH {_SEEN}
SELECT (SELECT count(*) FROM pages WHERE {_OUTCOME} = 'ok') AS pages_visited, count(*) FILTER (is_article) AS links_found,
  count(DISTINCT url) FILTER (is_article) AS unique_links, count(DISTINCT url) FILTER (kind = 'category') AS categories,
  count(DISTINCT url) FILTER (kind = 'tag') AS tags, count(DISTINCT url) FILTER (kind = 'author') AS authors,
  (SELECT count(*) FROM pages WHERE {_OUTCOME} = 'failed') AS errors, (SELECT count(*) FROM pages WHERE {_OUTCOME} <> 'ok') AS failed_urls FROM y""")
def g12(spark, sf):
    pages = table(spark, sf, "pages")
    found = pages.select(F.col("url").alias("page_url"), "url").unionByName(
        links.extract_links(dom(spark, sf)).select("page_url", "url")
    )
    u = F.replace(F.replace("url", F.lit("/en/"), F.lit("/category/")), F.lit("/fr/"), F.lit("/tag/"))
    seen = found.select("page_url", u.alias("url")).select(
        "page_url", "url", U.link_kind("url").alias("kind"), U.is_article_url("url", PAGES_SITE).alias("is_article")
    )
    outcome = F.when(F.contains("url", F.lit("?")), "failed").when(F.contains("url", F.lit("#")), "gone").otherwise("ok")
    return stats.collector_stats(seen, pages.select("url", outcome.alias("outcome")))


# events as failed extractions: the error text is "<type>: <detail>"
@query("g13_error_histogram", "SELECT event_type AS error_type, count(*) AS n FROM events WHERE value > 20 GROUP BY 1")
def g13_errors(spark, sf):
    e = table(spark, sf, "events")
    error = F.when(F.col("value") > 20, F.concat("event_type", F.lit(": at "), F.col("event_id").cast("string")))
    return stats.error_histogram(e.select(error.alias("error")))


_ATTEMPTS = """SELECT user_id || '/' || strftime(ts, '%Y-%m-%d') AS url, event_id, CASE event_type WHEN 'view' THEN 200 WHEN 'signup' THEN 404 WHEN 'error' THEN 500 WHEN 'click' THEN 503 ELSE 403 END AS status FROM events"""


def attempts(spark, sf):
    """An attempt log: a user's events of a day are the attempts for one URL."""
    e = table(spark, sf, "events")
    t = F.col("event_type")
    status = F.when(t == "view", 200).when(t == "signup", 404).when(t == "error", 500).when(t == "click", 503).otherwise(403)
    url = F.concat(F.col("user_id").cast("string"), F.lit("/"), F.date_format("ts", "yyyy-MM-dd"))
    number = F.expr("row_number() over (partition by user_id, date_format(ts, 'yyyy-MM-dd') order by event_id)")
    return e.select(url.alias("url"), number.alias("attempt"), status.alias("status"))


@query("g15_fetch_outcome", f"""
WITH n AS (SELECT url, status, row_number() OVER (PARTITION BY url ORDER BY event_id) AS attempt FROM ({_ATTEMPTS})),
d AS (SELECT *, min(attempt) FILTER (status IN (200, 404)) OVER (PARTITION BY url) AS stop FROM n WHERE attempt <= 3)
SELECT url, CASE WHEN any_value(stop) IS NULL THEN 'failed' WHEN max(status) FILTER (attempt = stop) = 200 THEN 'ok' ELSE 'gone' END AS outcome,
  coalesce(any_value(stop), max(attempt)) AS attempts FROM d GROUP BY url""")
def g15(spark, sf):
    return stats.fetch_outcome(attempts(spark, sf), max_attempts=3)


@query("g17_run_summary", """
SELECT strftime(min(ts), '%Y-%m-%dT%H:%M:%S') AS start_time, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS end_time,
  floor(epoch(max(ts)) - epoch(min(ts)))::DOUBLE AS duration_seconds, count(*) FILTER (event_type = 'view') AS total_links_found,
  count(*) FILTER (event_type = 'purchase') AS articles_scraped, 'Complete' AS status FROM events""")
def g17(spark, sf):
    t = F.col("event_type")
    return stats.run_summary(
        table(spark, sf, "events"), links=F.count_if(t == "view"), articles=F.count_if(t == "purchase")
    )


# the days on which a user does anything are the pages of a listing, the user's clicks and views the links on them; days without are missing
_PAGES_CTE = """
span AS (SELECT min(ts)::DATE AS d0 FROM events),
lp AS (SELECT user_id AS listing, date_diff('day', d0, ts::DATE) + 1 AS page, count(*) FILTER (event_type IN ('click', 'view')) AS n_links FROM events, span GROUP BY ALL)"""


def listing_pages(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"), "event_type")
    first = e.select(F.min("day")).scalar()
    return e.groupBy(F.col("user_id").alias("listing"), (F.datediff("day", first) + 1).cast("bigint").alias("page")).agg(
        F.count_if(F.col("event_type").isin("click", "view")).alias("n_links"))


def _walk(k, max_page, first=False):
    return f"""WITH {_PAGES_CTE},
w AS (SELECT *, sum((n_links > 0)::INTEGER) OVER (PARTITION BY listing ORDER BY page) AS island, min(page) OVER (PARTITION BY listing) AS first_page FROM lp WHERE page <= {max_page}),
r AS (SELECT *, row_number() OVER (PARTITION BY listing, island ORDER BY page) - (island > 0)::INTEGER AS run FROM w),
c AS (SELECT listing, min(page) FILTER ((n_links = 0 AND run >= {k}) {'OR (page = first_page AND n_links = 0)' if first else ''}) AS cut FROM r GROUP BY listing)
SELECT listing, page, n_links FROM w JOIN c USING (listing) WHERE cut IS NULL OR page <= cut"""


@query("w1_pages_until_empty", _walk(2, 300))
def w1(spark, sf):
    return stats.pages_until_empty(listing_pages(spark, sf), k=2, max_page=300)


@query("w1_pages_until_third_empty", _walk(3, 10**6))
def w1_third(spark, sf):
    return stats.pages_until_empty(listing_pages(spark, sf), k=3)


@query("w1_month_pages", _walk(2, 20, first=True))
def w1_month(spark, sf):
    return stats.pages_until_empty(listing_pages(spark, sf), k=2, max_page=20, first_must_have_links=True)


_VISITS = "SELECT strftime(ts, '%Y-%m-%d') AS page, user_id AS url FROM events"


@query("w2_new_links_per_page", f"""
WITH v AS ({_VISITS}), f AS (SELECT url, min(page) AS page FROM v GROUP BY url)
SELECT p.page, count(f.url) AS new_links FROM (SELECT DISTINCT page FROM v) p LEFT JOIN f USING (page) GROUP BY p.page""")
def w2(spark, sf):
    e = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("page"), F.col("user_id").alias("url"))
    return stats.new_links_per_page(e)


def _picked(condition):
    return f"SELECT batch_no, url FROM ({BATCHED_SQL}) WHERE {condition}"


@query("w4_select_batches", "SELECT 'range' AS spec, * FROM (" + _picked("batch_no BETWEEN 2 AND 3") + ") UNION ALL SELECT 'list', * FROM ("
       + _picked("batch_no IN (1, 9, 99999)") + ") UNION ALL SELECT 'one', * FROM (" + _picked("batch_no = 4") + ")")
def w4(spark, sf):
    b = batched(spark, sf)
    out = None
    for name, spec in (("range", "2-3"), ("list", "1,9,99999"), ("one", "4")):
        rows = batches.select_batches(b, spec).select(F.lit(name).alias("spec"), "batch_no", "url")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("w6_quick_sample", _picked("batch_no <= 50 // 20 + 1"))
def w6(spark, sf):
    return batches.quick_sample(batched(spark, sf), n_links=50, link_size=20)


@query("w7_progress_marks", "SELECT event_id, done FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS done FROM events) WHERE done % 20 = 0")
def w7(spark, sf):
    return stats.progress_marks(table(spark, sf, "events"), key="event_id", every=20)


