"""Record text, archives on disk, de-duplication and its summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from pressline import fixed_values as fv
from pressline.operators import batches, dedup, records
from pressline.operators.language import language_verdict, split_sides
from pressline.params import Blacklist
from pressline.plans.archive import build_archive
from pressline.plans.articles import combine
from pressline.session import new_path
from pressline.sources import readers, sinks
from registry.common import (
    ARTICLES_SQL, LEX, SITE, articles, lit, query, sql_any, sql_list, sql_strip, with_articles,
)
from registry.language import VERDICT_CTE

# phrases that really occur in the fixture's subtitles
SUBTITLES = Blacklist(subtitles=("The the", "Ing ", "Un "))
_MASKED = f"CASE WHEN NOT {sql_any('subtitle', SUBTITLES.subtitles)} THEN subtitle END"


def raw_sql(subtitle: str = "subtitle", title: str = "title") -> str:
    values = {
        "source": lit(SITE.domain), "overline": lit(fv.MISSING), "subtitle": f"coalesce({subtitle}, 'N/A')",
        "url": "coalesce(url, 'N/A')", "title": f"coalesce({title}, 'N/A')",
    }
    lines = " || chr(10) || ".join(f"{lit(key + ': ')} || {values.get(f, f)}" for f, key in fv.RECORD_KEYS)
    return f"'<***>' || chr(10) || {lines} || chr(10) || chr(10) || content || chr(10) || chr(10)"


RAW_SQL = f"CASE WHEN title <> '' AND content <> 'N/A' THEN {raw_sql()} END"


def rendered(spark, sf):
    return records.render_records(articles(spark, sf), site=SITE)


@query("d1_render_records", with_articles(f"SELECT doc_id, md5({RAW_SQL}) AS digest FROM a"))
def d1(spark, sf):
    return rendered(spark, sf).select("doc_id", F.md5("raw").alias("digest"))


@query("d1_render_extracted", with_articles(
    f"SELECT doc_id, md5(CASE WHEN content <> '' THEN {raw_sql()} END) AS digest FROM a"))
def d1_extracted(spark, sf):
    failed = articles(spark, sf).withColumn("error", F.when(F.col("content") == "", "No content extracted"))
    return records.render_records(failed, site=SITE, extracted=True).select("doc_id", F.md5("raw").alias("digest"))


@query("d2_mask_subtitle", with_articles(f"SELECT doc_id, {_MASKED} AS subtitle FROM a"))
def d2(spark, sf):
    return articles(spark, sf).select("doc_id", records.mask_subtitle("subtitle", SUBTITLES).alias("subtitle"))


def _value(x: str) -> str:
    return f"CASE WHEN {x} <> '' THEN {sql_strip(x)} END"


@query("d3_parse_records", with_articles(f"""
SELECT doc_id, {_value('title')} AS title, {_value('subtitle')} AS subtitle, category, date, author, url,
  CASE WHEN {sql_strip('content')} <> '' THEN md5({sql_strip('content')}) END AS content_digest
FROM a WHERE title <> ''"""))
def d3(spark, sf):
    whole = rendered(spark, sf).where(F.col("raw").isNotNull()).select("doc_id", "raw")
    body = F.when(F.col("content") != "", F.md5("content"))
    return records.parse_records(whole).select(
        "doc_id", "title", "subtitle", "category", "date", "author", "url", body.alias("content_digest")
    )


_COMPAT = r"'(?s)AUTOR\(I\): .+\n\n(.+)'"


@query("d3_parse_records_compat", f"""
WITH a AS ({ARTICLES_SQL}), r AS (SELECT doc_id, {RAW_SQL} AS raw FROM a WHERE title <> '')
SELECT doc_id, NULL::VARCHAR AS title,
  CASE WHEN regexp_matches(raw, {_COMPAT}) THEN md5({sql_strip(f"regexp_extract(raw, {_COMPAT}, 1)")}) END AS content_digest
FROM r""")
def d3_compat(spark, sf):
    whole = rendered(spark, sf).where(F.col("raw").isNotNull()).select("doc_id", "raw")
    return records.parse_records(whole, compat=True).select("doc_id", "title", F.md5("content").alias("content_digest"))


@query("d4_record_url", with_articles("SELECT doc_id, coalesce(url, 'N/A') AS url FROM a WHERE title <> ''"))
def d4(spark, sf):
    whole = rendered(spark, sf).where(F.col("raw").isNotNull())
    return whole.select("doc_id", records.record_url("raw").alias("url"))


def written_archive(spark, sf):
    """The articles as archive files: one folder per batch, as a run leaves them."""
    path = new_path(spark, "archive")
    sinks.write_articles(rendered(spark, sf), path)
    return path


def _read_back(spark, path):
    """Records of a written archive; the folder names the batch."""
    return readers.read_articles(spark, path, glob="*.txt")


_LINES = f"SELECT batch_no, md5({sql_strip('raw')}) AS digest FROM (SELECT batch_no, {RAW_SQL} AS raw FROM a) WHERE raw IS NOT NULL"


@query("a3_a10_archive_round_trip", with_articles(_LINES))
def archive_round_trip(spark, sf):
    read = _read_back(spark, written_archive(spark, sf))
    return read.select("batch_no", F.md5(records.strip("raw")).alias("digest"))


@query("a3_archive_read_whole", with_articles(_LINES))
def archive_read_whole(spark, sf):
    read = readers.read_articles_whole(spark, written_archive(spark, sf), glob="*.txt")
    return read.select("batch_no", F.md5(records.strip("raw")).alias("digest"))


@query("a4_with_marker", with_articles("SELECT doc_id, md5('<***>' || title) AS digest FROM a"))
def a4(spark, sf):
    marked = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<***>"), "title")).otherwise(F.col("title"))
    return articles(spark, sf).select("doc_id", F.md5(records.with_marker(marked)).alias("digest"))


@query("a5_file_discovery", with_articles("SELECT batch_no, count(*) AS n FROM a WHERE title <> '' GROUP BY 1"))
def a5(spark, sf):
    # files of another suffix in the same folders are not archive files
    path = written_archive(spark, sf)
    links = articles(spark, sf).where(F.col("url").isNotNull()).select("batch_no", "url")
    links.write.mode("append").partitionBy("batch_no").json(path)
    return _read_back(spark, path).groupBy("batch_no").agg(F.count("*").alias("n"))


@query("a6_batch_no", with_articles("SELECT file, batch_no, 1 AS fallback FROM a"))
def a6(spark, sf):
    df = articles(spark, sf).drop("batch_no")
    found = batches.with_batch_no(df, default=0)
    return found.select("file", "batch_no", batches.batch_no_of("lang", 1).alias("fallback"))


@query("a11_write_split", f"""WITH {VERDICT_CTE}
SELECT CASE WHEN foreign_reason IS NULL THEN 'local' ELSE 'foreign' END AS lang_side, batch_no, count(*) AS n
FROM v WHERE title <> '' GROUP BY ALL""")
def a11(spark, sf):
    path = new_path(spark, "split")
    sides = split_sides(language_verdict(rendered(spark, sf).where(F.col("raw").isNotNull()), lex=LEX))
    sinks.write_split(sides, path)
    read = readers.read_articles(spark, path, glob="*.txt")
    return read.groupBy(
        F.regexp_extract("file", r"lang_side=(\w+)", 1).alias("lang_side"),
        "batch_no",
    ).agg(F.count("*").alias("n"))


FIRST_SQL = """
k AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY batch_no, file, pos) AS rn FROM a),
d AS (SELECT * FROM k WHERE url IS NULL OR rn = 1)"""


@query("a12_write_archive", f"""WITH a AS ({ARTICLES_SQL}), {FIRST_SQL}
SELECT (row_number() OVER (ORDER BY batch_no, file, pos))::BIGINT AS ord, md5({sql_strip('raw')}) AS digest
FROM (SELECT *, {RAW_SQL} AS raw FROM d) WHERE raw IS NOT NULL""")
def a12(spark, sf):
    path = new_path(spark, "combined")
    first = dedup.dedup_first_seen(rendered(spark, sf)).where(F.col("raw").isNotNull())
    sinks.write_archive(first, path, order=dedup.ORDER, compression="gzip")
    read = readers.read_articles(spark, path, glob="*.txt.gz")
    keyed = read.select(F.struct("file", "block", "pos").alias("key"), "raw")
    ordered = batches.global_index(keyed, "key")
    return ordered.select((F.col("idx") + 1).alias("ord"), F.md5(records.strip("raw")).alias("digest"))


@query("a13_write_summary", f"""WITH a AS ({ARTICLES_SQL}), {FIRST_SQL}
SELECT (SELECT count(DISTINCT file) FROM a) AS input_files, (SELECT count(*) FROM a) AS total_articles,
  (SELECT count(*) FROM d) AS unique_articles, (SELECT count(*) FROM a) - (SELECT count(*) FROM d) AS duplicate_articles,
  'all.txt' AS output_file""")
def a13(spark, sf):
    path = new_path(spark, "summary")
    summary = dedup.combine_summary(dedup.combine_totals(articles(spark, sf)), "all.txt", F.current_timestamp())
    sinks.write_summary(summary, path)
    schema = "timestamp string, input_files bigint, total_articles bigint, unique_articles bigint, duplicate_articles bigint, output_file string"
    return spark.read.schema(schema).json(path).drop("timestamp")


@query("g1_dedup_first_seen", f"WITH a AS ({ARTICLES_SQL}), {FIRST_SQL} SELECT doc_id, batch_no, file, url, md5(content) AS digest FROM d")
def g1(spark, sf):
    return dedup.dedup_first_seen(articles(spark, sf)).select("doc_id", "batch_no", "file", "url", F.md5("content").alias("digest"))


@query("g2_dedup_disabled", with_articles("SELECT doc_id, url FROM a"))
def g2(spark, sf):
    return dedup.dedup_first_seen(articles(spark, sf), enabled=False).select("doc_id", "url")


@query("g3_batch_dup_counts", f"""WITH a AS ({ARTICLES_SQL}), {FIRST_SQL}
SELECT batch_no, count(*) FILTER (url IS NULL OR rn = 1) AS added, count(*) FILTER (url IS NOT NULL AND rn > 1) AS duplicates
FROM k GROUP BY batch_no""")
def g3(spark, sf):
    return dedup.batch_dup_counts(articles(spark, sf))


@query("g4_combine_totals", f"""WITH a AS ({ARTICLES_SQL}), {FIRST_SQL}
SELECT (SELECT count(DISTINCT file) FROM a) AS input_files, count(*) AS total_articles,
  count(*) FILTER (url IS NULL OR rn = 1) AS unique_articles, count(*) FILTER (url IS NOT NULL AND rn > 1) AS duplicate_articles FROM k""")
def g4(spark, sf):
    return dedup.combine_totals(articles(spark, sf))


@query("g5_success_rate", f"""WITH a AS ({ARTICLES_SQL}), {FIRST_SQL}
SELECT batch_no, round(100.0 * count(*) FILTER (url IS NULL OR rn = 1) / count(*), 2)::DOUBLE AS success_rate FROM k GROUP BY batch_no""")
def g5(spark, sf):
    counts = dedup.batch_dup_counts(articles(spark, sf))
    return counts.select(
        "batch_no", dedup.success_rate(F.col("added"), F.col("added") + F.col("duplicates")).alias("success_rate")
    )


@query("g6_report_rows", f"""WITH a AS ({ARTICLES_SQL}), {FIRST_SQL},
t AS (SELECT (SELECT count(DISTINCT file) FROM a) AS f, count(*) AS n, count(*) FILTER (url IS NULL OR rn = 1) AS u FROM k),
l AS (SELECT *, unnest({sql_list(fv.REPORT_LINES)}) AS line, generate_subscripts({sql_list(fv.REPORT_LINES)}, 1) - 1 AS i FROM t)
SELECT i::INTEGER AS line_no, CASE i WHEN 0 THEN replace(line, '{{NAME}}', 'ARCHIVE') WHEN 1 THEN replace(line, '%s', '2024-05-17 08:30:00')
  WHEN 4 THEN replace(line, '%d', f::VARCHAR) WHEN 5 THEN replace(line, '%d', n::VARCHAR) WHEN 6 THEN replace(line, '%d', u::VARCHAR)
  WHEN 7 THEN replace(line, '%d', (n - u)::VARCHAR) WHEN 10 THEN replace(line, '%s', 'all.txt') WHEN 13 THEN replace(line, '%d / %d', u || ' / ' || n)
  WHEN 14 THEN replace(line, '%.2f%%', printf('%.2f', round(100.0 * u / n, 2)) || '%') ELSE replace(line, '{{name}}', 'Archive') END AS line FROM l""")
def g6(spark, sf):
    summary = dedup.combine_summary(dedup.combine_totals(articles(spark, sf)), "all.txt", F.current_timestamp())
    return dedup.report_rows(summary, name="Archive", generated=F.to_timestamp(F.lit("2024-05-17 08:30:00")))


@query("g16_marker_count", with_articles(f"SELECT count(*) AS markers FROM a WHERE title <> ''"))
def g16(spark, sf):
    # counted on the files themselves, not on parsed records
    text = spark.read.option("recursiveFileLookup", True).text(written_archive(spark, sf))
    return records.marker_count(text, text="value")


@query("w3_order_batches", with_articles(
    "SELECT (row_number() OVER (ORDER BY batch_no, file))::BIGINT AS ord, batch_no, file FROM (SELECT DISTINCT batch_no, file FROM a)"))
def w3(spark, sf):
    files = readers.list_files(articles(spark, sf))
    ordered = batches.order_batches(files.withColumn("key", F.struct("batch_no", "file")))
    return batches.global_index(ordered, "key").select((F.col("idx") + 1).alias("ord"), "batch_no", "file")


@query("plan_combine_archive", f"""WITH {VERDICT_CTE}, {FIRST_SQL.replace('FROM a)', "FROM v WHERE foreign_reason IS NULL AND title <> '')")}
SELECT doc_id, url FROM d""")
def plan_combine(spark, sf):
    whole = rendered(spark, sf).where(F.col("raw").isNotNull()).select("doc_id", "batch_no", "file", "pos", "raw")
    return combine(whole).select("doc_id", "url")


_LOCAL = FIRST_SQL.replace("FROM a)", "FROM v WHERE foreign_reason IS NULL AND title <> '')")


@query("plan_build_archive", f"""WITH {VERDICT_CTE}, {_LOCAL},
w AS (SELECT * FROM v WHERE title <> ''),
n AS (SELECT (SELECT count(*) FROM w) AS every, (SELECT count(*) FROM k) AS loc, (SELECT count(*) FROM d) AS uniq, (SELECT count(DISTINCT file) FROM k) AS files,
  (SELECT count(DISTINCT batch_no) FROM w) AS dirs)
SELECT 'record' AS part, lpad((row_number() OVER (ORDER BY batch_no, file, pos))::VARCHAR, 9, '0') AS key, md5({sql_strip('raw')}) AS value FROM (SELECT *, {RAW_SQL} AS raw FROM d)
UNION ALL SELECT 'side', lang_side || ' ' || batch_no, count(*)::VARCHAR FROM (SELECT batch_no, CASE WHEN foreign_reason IS NULL THEN 'local' ELSE 'foreign' END AS lang_side FROM w) GROUP BY ALL
UNION ALL SELECT 'file', batch_no || ' ' || file, count(*) FILTER (foreign_reason IS NULL) || ' ' || count(foreign_reason) FROM w GROUP BY batch_no, file
UNION ALL SELECT 'summary', unnest(['input_files', 'total_articles', 'unique_articles', 'duplicate_articles']), unnest([files, loc, uniq, loc - uniq])::VARCHAR FROM n
UNION ALL SELECT 'filter', unnest(['total_processed', 'local_articles', 'foreign_articles', 'batch_dirs_processed']), unnest([every, loc, every - loc, dirs])::VARCHAR FROM n
UNION ALL SELECT 'report', '13', '- Articles successfully processed: ' || uniq || ' / ' || loc FROM n
UNION ALL SELECT 'counts', 'markers', every || ' ' || uniq FROM n""")
def plan_build(spark, sf):
    """A whole run over the records of ``documents``, read back from what it has written."""
    out = new_path(spark, "archive")
    whole = rendered(spark, sf).where(F.col("raw").isNotNull()).select("batch_no", "file", "pos", "raw")
    counts = build_archive(whole, out, name="Archive", compression="gzip", timestamp=F.to_timestamp(F.lit("2024-05-17 08:30:00")))

    def rows(df, part, key, value):
        return df.select(F.lit(part).alias("part"), key.alias("key"), value.cast("string").alias("value"))

    def fields(path, part, *names):
        one = spark.read.schema(", ".join(f"{n} bigint" for n in names)).json(f"{out}/{path}")
        return rows(one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("k"), F.col(n).alias("v")) for n in names]))), part, F.col("k"), F.col("v"))

    read = readers.read_articles(spark, f"{out}/archive", glob="*.txt.gz").select(F.struct("file", "block", "pos").alias("key"), "raw")
    record = rows(batches.global_index(read, "key"), "record", F.lpad((F.col("idx") + 1).cast("string"), 9, "0"), F.md5(records.strip("raw")))
    sides = readers.read_articles(spark, f"{out}/sides", glob="*.txt").withColumn("side", F.regexp_extract("file", r"lang_side=(\w+)", 1))
    sides = sides.groupBy(F.concat_ws(" ", "side", "batch_no").alias("k")).agg(F.count("*").alias("v"))
    files = spark.read.schema("level string, batch_no int, file string, local_articles bigint, foreign_articles bigint").json(f"{out}/filter_counts").where("level = 'file'")
    line = spark.read.text(f"{out}/report").where("value like '- Articles successfully%'")
    markers = spark.range(1).select(F.lit(f"{counts['markers']} {counts['archive_markers']}").alias("v"))
    parts = [
        record, rows(sides, "side", F.col("k"), F.col("v")), rows(files, "file", F.concat_ws(" ", "batch_no", "file"), F.concat_ws(" ", "local_articles", "foreign_articles")),
        fields("summary", "summary", "input_files", "total_articles", "unique_articles", "duplicate_articles"),
        fields("filter_summary", "filter", "total_processed", "local_articles", "foreign_articles", "batch_dirs_processed"),
        rows(line, "report", F.lit("13"), F.col("value")), rows(markers, "counts", F.lit("markers"), F.col("v"))]
    return reduce(lambda a, b: a.unionByName(b), parts)
