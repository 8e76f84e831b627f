"""The operators with production parameters on their whole tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressline.llm import bpe, decontaminate, fingerprint, hard_negatives, langid, main_text, ngram_join, pii, quality, spelling, token_counts, toxicity, url_filter
from pressline.llm.common import held_out, read
from pressline.session import new_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text")
    return decontaminate.overlaps(docs, items).select("doc_id", "item_id", "n_hits", "n_words", "first_word", "last_word")


@query("op2_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    out = bpe.encode(docs, tokenizer_path=WORD_BPE, with_text=True)
    return out.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    labels = read(spark, sf_dir, "labels", "doc_id", "quality").where(~held_out("doc_id", 3, 1))
    scored = quality.score(docs, quality.train(docs, labels))
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op4_language")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = langid.train(docs.where(~held_out("doc_id", 5, 0)))
    return langid.predict(docs, model).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")


@query("op5_fingerprint")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited(read(spark, sf_dir, "documents", "doc_id", "text"))


@query("op6_ngram_join")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "n_shingles", "component_id")


URL_RULES = (
    url_filter.Rule("allow", "org", "/"), url_filter.Rule("block", "example.org", "/es/"), url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"), url_filter.Rule("block", "com", "/de/"),
)


@query("op7_url_filter")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)


END_OF_DOCUMENT = 49407  # <|endoftext|> of the vocabulary


@query("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_counts.write_flat(read(spark, sf_dir, "documents", "doc_id", "text"), path, tokenizer_path=WORD_BPE, separator=END_OF_DOCUMENT)
    return token_counts.scan(spark, path, separator=END_OF_DOCUMENT)


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    labels = read(spark, sf_dir, "labels", "doc_id", "toxic").where(~held_out("doc_id", 5, 0))
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op10_pii")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.spans(read(spark, sf_dir, "documents", "doc_id", "text")))


OP11_SQL = """
WITH part AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM part a JOIN part b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank,
         s.other_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT * FROM ranked WHERE rank <= 3
"""


@query("op11_hard_negatives", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), anchors=F.col("vec_id") % 50 == 0)


@query("op12_main_text")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages", "page_id", "url", "html")
    return main_text.extract(pages, main_text.train(pages))


@query("op13_spelling")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents", "doc_id", "text"))
