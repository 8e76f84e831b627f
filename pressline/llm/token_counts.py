"""Token counts by a scan for separators in flat token files without an index.

A flat file is nothing but token ids of two bytes, with an end-of-document id after each document.
The files are listed without their content and cut into blocks of one size; a task reads the byte range of
a block alone, from the shared file system, so a file may have any size, and looks for its separators in one
vector operation; a prefix scan over the blocks of a file (running count and running maximum of the last
separator's place) gives each block the number of its first document and where that began, so a
document that spans blocks is counted whole.

Cases: null and empty texts are documents of 0 tokens; ids after the last separator are a document that
is not closed; an empty file gives no rows; strings of special tokens in a text are plain text, so no text
can hold a separator; repeated rows are documents each; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressline.llm.bpe import encoder
from pressline.llm.common import text_rows

TOKEN_BYTES = 2
BLOCK_TOKENS = 1 << 19
FILE_ROWS = 20_000
TASK_BLOCKS = 16
MAX_TASKS = 10_000


def write_flat(df: DataFrame, path: str, *, tokenizer_path: str, separator: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Token ids of every whole text as flat files below ``path``, a separator after each text."""

    def ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(tokenizer_path, True)
        for batch in batches:
            yield pd.DataFrame({"value": [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in bpe.encode_many(list(batch["text"]))]})

    rows = text_rows(df, id_col, text_col).select("text").mapInPandas(ids, "value binary")
    # the text sink writes the bytes of a value and its line separator, nothing else
    mark = separator.to_bytes(TOKEN_BYTES, "little").decode("latin-1")
    rows.select(F.col("value").cast("string")).write.option("encoding", "ISO-8859-1").option("lineSep", mark).option(
        "maxRecordsPerFile", FILE_ROWS).text(path)


def opened(path: str) -> pa.NativeFile:
    """A file as Spark names it, by Arrow's own file systems."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":  # file:/x and file:///x
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def ranges_open(path: str) -> bool:
    """Whether Arrow reaches the store of this file; else only Spark's reader does, which takes files whole."""
    try:
        opened(path).close()
    except (OSError, pa.ArrowException):
        return False
    return True


def scan(spark: SparkSession, path: str, *, separator: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, doc_no, first_token, n_tokens, closed) of every document in the flat files below ``path``."""
    size = block_tokens * TOKEN_BYTES
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")
    last = F.floor((F.col("length") - 1) / size)
    listed = files.agg(F.sum(last + 1).alias("blocks"), F.min("path").alias("path")).first()
    by_range = listed["path"] is None or ranges_open(listed["path"])
    names = [F.element_at(F.split("path", "/"), -1).alias("file"), last.alias("last_block"), F.floor(F.col("length") / TOKEN_BYTES).cast("long").alias("file_tokens")]
    cuts = files.select("path", *names, *([] if by_range else ["content"])).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last_block"))))
    if by_range:  # a few numbers a row; a number of tasks is given, as rows so small would all be put in one
        tasks = min(MAX_TASKS, -(-(listed["blocks"] or 1) // TASK_BLOCKS))
        cuts = cuts.repartition(max(tasks, spark.sparkContext.defaultParallelism), "path", "block")
    else:
        cuts = cuts.withColumn("content", F.expr(f"substring(content, int(block * {size} + 1), {size})"))

    def read(row) -> bytes:
        if not by_range:
            return row.content
        with opened(row.path) as file:
            return file.read_at(size, row.block * size)

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for row in batch.itertuples():
                data = read(row)
                ids = np.frombuffer(data, "<u2", len(data) // TOKEN_BYTES)
                found.append(np.flatnonzero(ids == separator).astype(np.int64) + row.block * block_tokens)
            yield batch[["file", "block", "last_block", "file_tokens"]].assign(ends=found)

    blocks = cuts.mapInPandas(ends, "file string, block long, last_block long, file_tokens long, ends array<long>")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = blocks.select("*", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("docs_before"),
                             F.coalesce(F.max(F.array_max("ends")).over(before), F.lit(-1)).alias("end_before"))
    tail = F.when((F.col("block") == F.col("last_block")) & (F.coalesce(F.array_max("ends"), F.col("end_before")) < F.col("file_tokens") - 1), F.array("file_tokens"))
    every = F.concat("ends", F.coalesce(tail, F.array().cast("array<long>")))
    docs = stitched.select("file", "docs_before", "end_before", "ends", "file_tokens", every.alias("every")).select(
        "*", F.posexplode("every").alias("k", "end"))
    first = F.when(F.col("k") == 0, F.col("end_before")).otherwise(F.get("every", F.col("k") - 1)) + 1
    return docs.select("file", (F.col("docs_before") + F.col("k")).cast("long").alias("doc_no"), first.alias("first_token"),
                       (F.col("end") - first).alias("n_tokens"), (F.col("end") < F.col("file_tokens")).alias("closed"))
