"""Documents through the operators for training data, stage by stage.

Each stage takes what its predecessor kept, as written Parquet, and all but the last return the columns
of ``documents``.  Junk goes, one document of each group of near copies stays, documents with benchmark
passages go, personal data is masked, and what is left is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressline.llm import bpe, decontaminate, ngram_join, pii, quality
from pressline.llm.common import cut, read

#: learned labels and the sketches of near copies have no SQL form; the tests compare with plain loops
ORACLE_SQL = None

#: near copies share this percentage of their shingles of so many words
NEAR_SHINGLE = 5
NEAR_PERCENT = 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects."""
    model = quality.train(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.keep(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the lowest id."""
    return ngram_join.one_of_each(docs, shingle=NEAR_SHINGLE, percent=NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark passage."""
    found = decontaminate.overlaps(docs, read(spark, sf_dir, "benchmark", "item_id", "text")).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    found = ngram_join.few(cut(found))
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == found["_hash"]), "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    done = pii.masked(docs)
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in done.columns else done


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256)."""
    path = public_tokenizers.path("word_bpe_49k.json")
    out = bpe.encode(docs, tokenizer_path=path, with_text=True, cached_words=30_000, forgetful=True)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("BPE encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage returns is written and read again by the next."""
    docs = read(spark, sf_dir, "documents", "*")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
    return docs
