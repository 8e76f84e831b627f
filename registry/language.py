"""Language rules, text cleaning and their counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressline.functions import language as L
from pressline.functions.text import clean_text, let
from pressline.operators import dedup
from pressline.operators import language as OP
from pressline.operators.records import render_records
from pressline.params import Lexicon
from registry.common import (
    ARTICLES_SQL, LEX, SITE, STRIP_SQL, articles, lit, query, sql_any, sql_count,
    sql_list, sql_words, with_articles, table,
)

LEX_SQL = sql_list(LEX.terms)
_MASK = f"list_transform({sql_words('lower(content)')}, lambda x: CASE WHEN list_contains({LEX_SQL}, trim(x, {STRIP_SQL})) THEN 1 ELSE 0 END)"
_HAS_BODY = "(content <> '' AND content <> 'N/A')"
_TITLE_WORDS = sql_words("lower(title)")
_TITLE_HITS = f"len(list_filter({_TITLE_WORDS}, lambda w: list_contains({LEX_SQL}, w)))"

# tokens, hits and longest run per article; the run by gaps and islands
def verdict_cte(articles_sql: str, lex: Lexicon = LEX) -> str:
    """CTEs ``a`` .. ``v``: the verdict of every article of a relation; the lexicons differ in titles' keywords and phrases only."""
    return f"""
a AS ({articles_sql}),
m AS (SELECT doc_id, {_MASK} AS mask FROM a),
u AS (SELECT doc_id, unnest(mask) AS hit, generate_subscripts(mask, 1) AS i FROM m),
h AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM u WHERE hit = 1),
r AS (SELECT doc_id, max(n) AS max_run FROM (SELECT doc_id, island, count(*) AS n FROM h GROUP BY ALL) GROUP BY doc_id),
t AS (
  SELECT a.*, len(mask) AS n_words, coalesce(list_sum(mask), 0)::BIGINT AS n_hits, coalesce(max_run, 0) AS max_run,
    {_TITLE_HITS} AS title_hits, len({_TITLE_WORDS}) AS title_words
  FROM a JOIN m USING (doc_id) LEFT JOIN r USING (doc_id)
),
v AS (
  SELECT *, CASE
    WHEN NOT {_HAS_BODY} THEN NULL
    WHEN {sql_any('lower(title)', lex.title_keywords)} THEN 'title_keyword'
    WHEN {sql_any('lower(content)', lex.phrases_b)} THEN 'strong_phrase'
    WHEN title <> '' AND (title_hits >= 2 OR (title_hits > 0 AND title_words < 5)) THEN 'title_tokens'
    WHEN n_hits * 100 > 8 * n_words THEN 'token_share'
    WHEN n_hits >= 15 THEN 'token_hits'
    WHEN {sql_any('lower(content)', lex.phrases)} THEN 'phrase_ab'
    WHEN max_run >= 3 THEN 'consecutive' END AS foreign_reason
  FROM t
)"""


VERDICT_CTE = verdict_cte(ARTICLES_SQL)


@query("e0_has_body", with_articles(f"SELECT doc_id, {_HAS_BODY} AS has_body FROM a"))
def e0(spark, sf):
    return articles(spark, sf).select("doc_id", L.has_body("content").alias("has_body"))


@query("e1_title_keyword", with_articles(f"SELECT doc_id, {sql_any('lower(title)', LEX.title_keywords)} AS hit FROM a"))
def e1(spark, sf):
    return articles(spark, sf).select("doc_id", L.title_keyword("title", LEX).alias("hit"))


@query("e2_strong_phrase", with_articles(f"SELECT doc_id, {sql_any('lower(content)', LEX.phrases_b)} AS hit FROM a"))
def e2(spark, sf):
    low = let(articles(spark, sf), low=F.lower("content"))
    return let(low, t=L.body_terms("low", LEX)).select("doc_id", L.strong_phrase("t.phrases_b").alias("hit"))


@query("e3_title_tokens_hit", with_articles(
    f"SELECT doc_id, (title <> '' AND ({_TITLE_HITS} >= 2 OR ({_TITLE_HITS} > 0 AND len({_TITLE_WORDS}) < 5))) AS hit FROM a"))
def e3(spark, sf):
    return articles(spark, sf).select("doc_id", L.title_tokens_hit("title", LEX).alias("hit"))


@query("e4_token_share", f"WITH {VERDICT_CTE} SELECT doc_id, n_words, n_hits, n_hits * 100 > 8 * n_words AS over_share FROM v")
def e4(spark, sf):
    return OP.with_tokens(articles(spark, sf), lex=LEX).select(
        "doc_id", L.mask_words("hit_mask").alias("n_words"), L.mask_hits("hit_mask").alias("n_hits"),
        L.over_share("hit_mask", LEX).alias("over_share"),
    )


@query("e5_token_hits", f"WITH {VERDICT_CTE} SELECT doc_id, n_hits >= 15 AS hit FROM v")
def e5(spark, sf):
    return OP.with_tokens(articles(spark, sf), lex=LEX).select(
        "doc_id", (L.mask_hits("hit_mask") >= LEX.min_hits).alias("hit")
    )


@query("e6_strong_phrase_ab", with_articles(f"SELECT doc_id, {sql_any('lower(content)', LEX.phrases)} AS hit FROM a"))
def e6(spark, sf):
    low = let(articles(spark, sf), low=F.lower("content"))
    return let(low, t=L.body_terms("low", LEX)).select("doc_id", L.strong_phrase("t.phrases").alias("hit"))


@query("e7_max_run", f"WITH {VERDICT_CTE} SELECT doc_id, max_run, max_run >= 3 AS hit FROM v")
def e7(spark, sf):
    run = L.mask_max_run("hit_mask")
    return OP.with_tokens(articles(spark, sf), lex=LEX).select(
        "doc_id", run.alias("max_run"), L.mask_has_run("hit_mask", LEX.min_run).alias("hit")
    )


@query("e7_max_run_islands", f"WITH {VERDICT_CTE} SELECT doc_id, max_run FROM v")
def e7_islands(spark, sf):
    return OP.max_run_islands(articles(spark, sf), "doc_id", lex=LEX)


@query("e8_language_verdict", f"""WITH {VERDICT_CTE}
SELECT doc_id, foreign_reason, foreign_reason IS NOT NULL AS is_foreign, n_words, n_hits, max_run FROM v""")
def e8(spark, sf):
    return OP.language_verdict(articles(spark, sf), lex=LEX, metrics=True).select(
        "doc_id", "foreign_reason", "is_foreign", "n_words", "n_hits", "max_run"
    )


@query("e8_verdict_by_lang", f"""WITH {VERDICT_CTE}
SELECT lang, foreign_reason IS NOT NULL AS is_foreign, count(*) AS n FROM v GROUP BY ALL""")
def e8_by_lang(spark, sf):
    return OP.language_verdict(articles(spark, sf), lex=LEX).groupBy("lang", "is_foreign").agg(F.count("*").alias("n"))


# the sample rule: words n div 2 + 1 .. + 50 of bodies over 100 words, no title
def sample_cte(lex: Lexicon = LEX) -> str:
    return f"""
s AS (SELECT doc_id, w[len(w) // 2 + 1 : len(w) // 2 + 50] AS w FROM
  (SELECT doc_id, {sql_words('content')} AS w FROM a) WHERE len(w) > 100),
sm AS (SELECT doc_id, array_to_string(w, ' ') AS txt, list_transform(w, lambda x: CASE WHEN list_contains({LEX_SQL}, trim(lower(x), {STRIP_SQL})) THEN 1 ELSE 0 END) AS mask FROM s),
sj AS (SELECT doc_id, ({sql_any('lower(txt)', lex.phrases)} OR list_sum(mask) * 100 > 8 * len(mask)
  OR list_sum(mask) >= 15 OR contains(array_to_string(mask, ''), '111')) AS mid FROM sm)"""


SAMPLE_CTE = sample_cte()


@query("e9_mid_sample", f"WITH a AS ({ARTICLES_SQL}), {SAMPLE_CTE} SELECT doc_id, coalesce(mid, false) AS mid_foreign FROM a LEFT JOIN sj USING (doc_id)")
def e9(spark, sf):
    return OP.mid_sample_verdict(articles(spark, sf), lex=LEX).select("doc_id", "mid_foreign")


@query("e10_indicator_substrings", with_articles(
    f"SELECT doc_id, {sql_count('lower(content)', LEX.terms_b)} AS n, {sql_count('lower(content)', LEX.terms_b)} > 20 AS hit FROM a"))
def e10(spark, sf):
    n = let(let(articles(spark, sf), low=F.lower("content")), n=L.body_terms("low", LEX)["terms_b"])
    return n.select("doc_id", "n", (F.col("n") > LEX.max_substrings).alias("hit"))


@query("e11_local_only", f"WITH {VERDICT_CTE} SELECT doc_id, lang FROM v WHERE foreign_reason IS NULL")
def e11(spark, sf):
    # titles and bodies survive the trip through record text only up to outer
    # white space, which no rule looks at; a blank title is written as an unknown one
    titled = articles(spark, sf).withColumns({"url": F.lit("u"), "title": F.nullif("title", F.lit(""))})
    whole = render_records(titled, site=SITE).select("doc_id", "lang", "raw")
    return OP.local_only(whole, lex=LEX).select("doc_id", "lang")


@query("e12_split_sides", f"""WITH {VERDICT_CTE}
SELECT CASE WHEN foreign_reason IS NULL THEN 'local' ELSE 'foreign' END AS lang_side, batch_no, count(*) AS n FROM v GROUP BY ALL""")
def e12(spark, sf):
    judged = OP.split_sides(OP.language_verdict(articles(spark, sf), lex=LEX))
    return judged.groupBy("lang_side", "batch_no").agg(F.count("*").alias("n"))


_CLEAN = r"regexp_replace(regexp_replace(text, '\n{3,}', chr(10) || chr(10), 'g'), " + lit(
    r"[\t\n\x0b\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+([.,;:!?])"
) + r", '\1', 'g')"


@query("d5_clean_text", f"SELECT doc_id, md5({_CLEAN}) AS digest, length({_CLEAN}) AS n FROM documents")
def d5(spark, sf):
    t = let(table(spark, sf, "documents").select("doc_id", "text"), cleaned=clean_text("text"))
    return t.select("doc_id", F.md5("cleaned").alias("digest"), F.length("cleaned").cast("bigint").alias("n"))


_DIRS = "'articles_batch_' || CAST(batch_no AS VARCHAR)"


@query("g7_filter_rollup", f"""WITH {VERDICT_CTE},
g AS (SELECT {_DIRS} AS batch_dir, file, foreign_reason IS NOT NULL AS f FROM v)
SELECT CASE WHEN grouping(batch_dir, file) = 0 THEN 'file' WHEN grouping(batch_dir, file) = 1 THEN 'dir' ELSE 'all' END AS level,
  batch_dir, file, count(*) AS total_processed, count(*) FILTER (NOT f) AS local_articles, count(*) FILTER (f) AS foreign_articles,
  CASE WHEN grouping(batch_dir, file) = 3 THEN count(DISTINCT batch_dir) END AS batch_dirs_processed
FROM g GROUP BY ROLLUP (batch_dir, file)""")
def g7(spark, sf):
    judged = OP.language_verdict(articles(spark, sf), lex=LEX).withColumn(
        "batch_dir", F.concat(F.lit("articles_batch_"), F.col("batch_no").cast("string"))
    )
    return dedup.filter_rollup(judged)


@query("g7_filter_summary", f"""WITH {VERDICT_CTE}
SELECT count(*) AS total_processed, count(*) FILTER (foreign_reason IS NULL) AS local_articles,
  count(*) FILTER (foreign_reason IS NOT NULL) AS foreign_articles, count(DISTINCT batch_no) AS batch_dirs_processed FROM v""")
def g7_summary(spark, sf):
    return dedup.filter_summary(OP.language_verdict(articles(spark, sf), lex=LEX), directory="batch_no")


