"""Shared inputs of the registered queries, in Spark and in SQL.

``documents`` become article rows: the first line is the title, the rest the
body, the source its batch, and the URL a slug of the title, so copies of a
document share a URL and titles without letters have none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressline import fixed_values as fv
from pressline.params import Blacklist, Lexicon, Rules, Site

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SITE = Site(domain="news.example", name="news")
# the pages fixture lives on many hosts below these domains
PAGES_SITE = Site(domain="example.com", name="example")
ALL_LANGS = ("en", "fr", "de", "es")
RULES = Rules(site=SITE, blacklist=Blacklist(allowed_langs=ALL_LANGS))
LEX = Lexicon()
BL = Blacklist()


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its oracle."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a table."""
    return table(spark, sf_dir, name).select(*columns)


# --- SQL pieces -----------------------------------------------------------------
def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(values: Iterable[str]) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


# the library's white space, spelled out for a regex dialect without Unicode classes
WS = (
    r"[\t\n\x0b\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
WS_SQL = lit(WS + "+")
STRIP_SQL = lit(fv.TOKEN_STRIP_CHARS)


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, {lit('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def sql_words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {WS_SQL}), lambda w: w <> '')"


def sql_any(x: str, terms: Iterable[str]) -> str:
    """Any term is a substring of x."""
    return f"(len(list_filter({sql_list(terms)}, lambda k: contains({x}, k))) > 0)"


def sql_count(x: str, terms: Iterable[str]) -> str:
    return f"len(list_filter({sql_list(dict.fromkeys(terms))}, lambda k: contains({x}, k)))"


def sql_starts(x: str, terms: Iterable[str]) -> str:
    return f"(len(list_filter({sql_list(terms)}, lambda k: starts_with({x}, k))) > 0)"


def sql_first_rule(x: str, rules) -> str:
    """CASE over ordered (terms, value) rules."""
    whens = " ".join(f"WHEN {sql_any(x, terms)} THEN {lit(value)}" for terms, value in rules)
    return f"(CASE {whens} END)"


ARTICLES_SQL = """
SELECT doc_id, lang, source,
  split_part(text, chr(10), 1) AS title,
  CASE WHEN contains(text, chr(10)) THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS content,
  CAST(substr(source, 4) AS INTEGER) + 1 AS batch_no,
  'batch_' || CAST(CAST(substr(source, 4) AS INTEGER) + 1 AS VARCHAR) || '/part_' || lang || '.txt' AS file,
  doc_id AS pos,
  CASE WHEN regexp_matches(lower(split_part(text, chr(10), 1)), '[a-z]')
    THEN 'https://news.example/2024/05/' || trim(regexp_replace(lower(split_part(text, chr(10), 1)), '[^a-z]+', '-', 'g'), '-') || '/' END AS url,
  strftime(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER), '%d.%m.%Y') AS date,
  source AS author, lang AS category,
  split_part(text, chr(10), 1) AS subtitle
FROM documents
"""


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = text_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    title = F.substring_index("text", "\n", 1)
    at = F.instr("text", "\n")
    low = F.lower(title)
    slug = F.btrim(F.regexp_replace(low, "[^a-z]+", "-"), F.lit("-"))
    batch = F.substring("source", 4, 10).cast("int") + 1
    day = F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("doc_id") % 365).cast("int"))
    return d.select(
        "doc_id", "lang", "source",
        title.alias("title"),
        F.when(at > 0, F.substr("text", at + 1)).otherwise("").alias("content"),
        batch.alias("batch_no"),
        F.concat(F.lit("batch_"), batch.cast("string"), F.lit("/part_"), "lang", F.lit(".txt")).alias("file"),
        F.col("doc_id").alias("pos"),
        F.when(slug != "", F.concat(F.lit("https://news.example/2024/05/"), slug, F.lit("/"))).alias("url"),
        F.date_format(day, "dd.MM.yyyy").alias("date"),
        F.col("source").alias("author"),
        F.col("lang").alias("category"),
        title.alias("subtitle"),
    )


def with_articles(sql: str) -> str:
    return f"WITH a AS ({ARTICLES_SQL})\n{sql}"
