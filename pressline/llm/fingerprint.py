"""Document fingerprints: Order MinHash over words; DataFrame functions only.

The k-mers of a text are its runs of ``K`` words, numbered by occurrence, so that repeats count.  They
are dealt over two halves by a hash bit.  For each of ``FUNCTIONS`` hash functions the minimal k-mer of
each half is selected, and the pair, in the order in which it stands in the text, is hashed.  Two texts
agree in such a value only if they share both k-mers in the same order, which follows edit distance:
moved passages lower the likeness, which plain MinHash doesn't see.

All k-mers of a text are reduced by a hash aggregate of minima in the task that reads the text, so one
row per text leaves the task.

Cases: words are cut at white space (``[ \\t-\\r]``); null texts are empty; texts without words have one and
the same fingerprint, texts of fewer than ``K`` words have one k-mer; equal texts have equal fingerprints;
repeated rows stay rows of their own; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressline.llm.common import text_rows

K = 3
FUNCTIONS = 16
POSITION_BITS = 24
QUANTILE_ACCURACY = 10_000


def kmers(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """A row (key, occurrence, position) for each k-mer; one row of nulls for a text without words."""
    words = F.array_remove(F.split(text, r"[ \t-\r]+"), "")
    low = (1 << POSITION_BITS) - 1
    hashed = df.select(*keep, F.transform(words, lambda w: F.xxhash64(w)).alias("h")).select(
        "*", F.greatest(F.size("h") - (K - 1), F.least(F.size("h"), F.lit(1))).alias("n"))
    # position in the low bits: sorting the longs brings equal k-mers together, in text order
    scale = F.greatest(F.lit(1), F.ceil(F.col("n") / float(1 << POSITION_BITS))).cast("int")
    packed = F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.xxhash64(*[F.get("h", i + d) for d in range(K)]).bitwiseAND(F.lit(~low)).bitwiseOR((i / scale).cast("long"))))
    ordered = hashed.select(*keep, "n", F.sort_array(packed).alias("s"))
    key = lambda i: F.shiftright(F.get("s", i), POSITION_BITS)
    starts = F.when(F.col("n") > 0, F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda i: (i == 0) | (key(i) != key(i - 1))))
    runs = ordered.select(*keep, "n", "s", starts.alias("starts")).select(*keep, "n", "s", "starts", F.posexplode_outer("starts").alias("r", "first"))
    count = F.coalesce(F.get("starts", F.col("r") + 1), F.col("n")) - F.col("first")
    each = runs.select(*keep, "s", "first", F.explode_outer(F.when(F.col("first").isNotNull(), F.sequence(F.lit(0), count - 1))).alias("occurrence"))
    return each.select(*keep, key(F.col("first")).alias("key"), "occurrence", F.get("s", F.col("first") + F.col("occurrence")).bitwiseAND(F.lit(low)).alias("position"))


def fingerprints(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """The columns to keep, which must tell the rows apart, and ``fingerprint``, an array of longs."""
    rows = kmers(df, text, *keep).withColumn("half", F.xxhash64("key", "occurrence").bitwiseAND(F.lit(1)))
    low = (1 << POSITION_BITS) - 1
    minima = []
    for j in range(FUNCTIONS):
        value = F.xxhash64(F.lit(j), "key", "occurrence").bitwiseAND(F.lit(~low)).bitwiseOR(F.col("position"))
        minima += [F.min(F.when(F.col("half") == side, value)).alias(f"m{j}_{side}") for side in (0, 1)]
    found = rows.groupBy(*keep).agg(*minima)

    def pair(j: int) -> Column:
        a, b = (F.shiftright(F.col(f"m{j}_{s}"), POSITION_BITS) for s in (0, 1))
        before = F.col(f"m{j}_0").bitwiseAND(F.lit(low)) <= F.col(f"m{j}_1").bitwiseAND(F.lit(low))
        return F.when(F.coalesce(before, F.lit(True)), F.xxhash64(F.lit(j), a, b)).otherwise(F.xxhash64(F.lit(-1 - j), b, a))

    return found.select(*keep, F.array(*[pair(j) for j in range(FUNCTIONS)]).alias("fingerprint"))


def likeness(a: str, b: str) -> Column:
    """Share of the values in which two fingerprints agree."""
    same = F.lit(0)
    for j in range(FUNCTIONS):
        same = same + (F.get(F.col(a), F.lit(j)) == F.get(F.col(b), F.lit(j))).cast("int")
    return same / float(FUNCTIONS)


def as_text(a: str) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, place, doc_id, text, next_text, ghost): each row with the text of the next lower id.

    Ids are dealt over parts at their quantiles, and a window runs in each part.  The first row of the
    next part is added to a part as its last, marked as ``ghost``; after the lowest id comes the highest.
    Only these first rows, one for each part, are moved besides.  Null ids come last; equal ids are
    ordered by the hash of their texts.
    """
    rows = text_rows(df, id_col, text_col)
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / parts for i in range(1, parts)]
    bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", shares, QUANTILE_ACCURACY).alias("q")).first()["q"] or []))
    part = F.lit(0)
    for bound in bounds:
        part = part + F.coalesce((F.col("doc_id") >= bound).cast("int"), F.lit(0))
    rows = rows.select(part.alias("part"), "doc_id", "text", F.xxhash64("text").alias("text_hash"))
    # at most one row for each part, and of fixed width
    heads = rows.groupBy("part").agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "text_hash")).alias("head"))
    order = Window.orderBy(F.desc("part"))
    heads = heads.select("head.doc_id", "head.text_hash", F.coalesce(F.lag("part").over(order), F.min("part").over(Window.partitionBy())).alias("target"))
    met = rows.select("doc_id", "text", "text_hash").alias("d").join(
        F.broadcast(heads).alias("h"), F.expr("d.doc_id <=> h.doc_id and d.text_hash = h.text_hash"))
    ghosts = met.select(F.col("target").alias("part"), "d.doc_id", "d.text", "d.text_hash", F.lit(True).alias("ghost"))
    both = rows.withColumn("ghost", F.lit(False)).unionByName(ghosts)
    run = Window.partitionBy("part").orderBy("ghost", F.desc_nulls_last("doc_id"), F.desc("text_hash"))
    return both.select("part", F.row_number().over(run).alias("place"), "doc_id", "text", F.lead("text").over(run).alias("next_text"), "ghost")


def edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The last half of each text is replaced by the beginning of the next one, in descending order of ids.
    """
    rows = with_next(df, id_col, text_col)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    head = F.substr("text", F.lit(1), n - half)
    rows = rows.select("part", "place", "doc_id", "ghost", "text", n.cast("long").alias("n_chars"),
                       F.when(~F.col("ghost"), F.concat(head, F.substr("next_text", F.lit(1), half))).alias("edited"))
    two = rows.select("part", "place", "doc_id", "ghost", "n_chars", F.when(~F.col("ghost"), F.sha2(F.col("edited").cast("binary"), 256)).alias("sha"),
                      F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("text")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")))).alias("t"))
    two = two.where("t.text is not null").select("part", "place", "doc_id", "ghost", "n_chars", "sha", "t.side", "t.text")
    found = fingerprints(two, "text", "part", "place", "doc_id", "ghost", "n_chars", "sha", "side")
    pairs = found.groupBy("part", "place", "doc_id", "ghost", "n_chars").agg(
        F.max("sha").alias("edited_sha256"), F.max(F.when(F.col("side") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("side") == 1, F.col("fingerprint"))).alias("edited_fingerprint"))
    run = Window.partitionBy("part").orderBy("place")
    out = pairs.select("*", F.lead("fingerprint").over(run).alias("next_fingerprint")).where("not ghost")
    return out.select("doc_id", "n_chars", "edited_sha256", as_text("fingerprint").alias("fingerprint"), as_text("edited_fingerprint").alias("edited_fingerprint"),
                      likeness("fingerprint", "edited_fingerprint").alias("near_edited"), likeness("fingerprint", "next_fingerprint").alias("near_next"))
