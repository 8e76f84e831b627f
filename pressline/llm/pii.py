"""Personal data: fixed patterns, and bootstrapped extraction from their contexts; DataFrame functions only.

The fixed patterns (email, ip, card, phone) give the base spans, which always stay.  They are also the
seeds.  They and every identifier-like word (at least ``MIN_ID`` characters, with a digit) are instances, and
the words before an instance, after it and its own head before the first digit are the lexical patterns in
which it occurs; a word that a base span overlaps counts as one with that span.  A pattern's score is the smoothed share of known identifiers among its instances; an instance in a
pattern of high score that enough known ones support becomes known itself, with kind ``id``, and the scores
are computed again, for ``ROUNDS`` rounds.  Patterns and instances are a graph of two sides that is scored
with joins and partial sums; only word neighbourhoods are moved, not texts.

Base patterns as regular expressions (fixed values; all are scanned from left to right, without overlap in a
kind, and matches that fail their test are dropped):

    email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip     [0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+), parts at most 255
    card   [0-9]([\\x20-]?[0-9])+, 14 to 19 digits passing Luhn
    phone  \\+[0-9][\\x20().0-9-]+[0-9], 10 to 15 digits

They are written here so that no long run costs quadratic time or a deep stack: a match may begin only
where a run begins or the last match ended, and doubled separators are replaced by a character that
breaks a match (of equal length, so that places stay).

Cases: null texts are empty and have no spans; places are code points, the end exclusive; repeated rows get
a row each; spans of two kinds may overlap and all are listed; an empty table gives no rows; extra columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressline.llm.common import cut, text_rows

KINDS = ("email", "ip", "card", "phone", "id")
MIN_ID = 6
CONTEXT_CHARS = 64
ROUNDS = 2
MIN_SCORE = 0.8
MIN_SUPPORT = 5
SMOOTHING = 2.0
BROADCAST_PATTERNS = 50_000
#: spans, of some 60 bytes each
BROADCAST_SPANS = 250_000

LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++\.[A-Za-z0-9-][A-Za-z0-9.-]*(?<!\.)"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9][0-9 -]*[0-9]"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
ID = rf"(?<!\S)(?=[^\s0-9]*+[0-9])\S{{{MIN_ID},}}+"
DOTS = r"(?<=\.)\.|\.(?=\.)"
SEPARATORS = r"(?<=[ -])[ -]|[ -](?=[ -])"
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's test."""
    n = F.length(digits)

    def part(i: Column) -> Column:
        d = F.substring(digits, i, 1).cast("int") if isinstance(i, int) else F.substr(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when((n - i) % 2 == 1, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), part), F.lit(0), lambda a, x: a + x) % 10 == 0


def passes(kind: Column, m: Column) -> Column:
    """Whether a match stands its kind's test."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    return (F.when(kind == "ip", m.rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$"))
            .when(kind == "card", F.when(n.between(14, 19), luhn(digits)).otherwise(False))
            .when(kind == "phone", n.between(10, 15)).otherwise(True))


def matches(rows: DataFrame) -> DataFrame:
    """A row (.., kind, start, end, match, before, after) for each match; one row of nulls for a text without."""
    text = F.col("text")

    def kind(name: str, pattern: str, when: Column, source: Column = text) -> Column:
        found = F.struct(F.lit(name).alias("kind"), F.split(source, pattern, -1).alias("gaps"), F.regexp_extract_all(source, F.lit(pattern), F.lit(0)).alias("found"))
        return F.when(when, found)

    digit = text.rlike("[0-9]")
    kinds = F.array(
        kind("email", EMAIL, F.contains(text, F.lit("@")), F.regexp_replace("text", DOTS, "_")),
        kind("ip", IP, text.rlike(r"[0-9]\.[0-9]")),
        kind("card", CARD, text.rlike("[0-9][0-9 -]{12}"), F.regexp_replace("text", SEPARATORS, "\t")),
        kind("phone", PHONE, F.contains(text, F.lit("+"))),
        kind("id", ID, digit),
    )
    keep = [c for c in rows.columns if c != "text"]
    by_kind = rows.select(*keep, F.explode_outer(F.when(digit | F.contains(text, F.lit("@")), kinds)).alias("k"))
    # a text without matches of a kind gives nothing for it, but each text keeps one row
    each = by_kind.select(*keep, "k.kind", "k.gaps", F.posexplode_outer("k.found").alias("at", "match"))
    gap = F.get("gaps", F.col("at"))
    moved = each.select(*keep, "kind", "at", "match", F.length(gap).alias("gap"), F.right(gap, F.lit(CONTEXT_CHARS)).alias("left"),
                        F.left(F.get("gaps", F.col("at") + 1), F.lit(CONTEXT_CHARS)).alias("right"))
    moved = moved.where("match is not null or kind is null or kind = 'id'").repartition("row")
    run = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("match")).over(run)
    word = lambda c, n: F.lower(F.regexp_replace(F.substring_index(F.trim(F.translate(c, "\n\t", "  ")), " ", n), r"[^\p{L}\p{N}=:#]", ""))
    # signs that touch a base span belong to its word, as they do in words that are candidates
    base = F.col("kind") != "id"
    left = F.when(base, F.regexp_replace("left", r"[^\s\p{L}\p{N}=:#]+$", "")).otherwise(F.col("left"))
    right = F.when(base, F.regexp_replace("right", r"^[^\s\p{L}\p{N}=:#]+", "")).otherwise(F.col("right"))
    placed = moved.select(*keep, "kind", (end - F.length("match")).alias("start"), end.alias("end"), "match", word(left, -1).alias("before"), word(right, 1).alias("after"))
    return placed.where(F.col("match").isNull() | passes(F.col("kind"), F.col("match")))


def discovered(spans: DataFrame) -> DataFrame:
    """The instances (row, start, end) that the contexts of known identifiers bring in."""
    base = F.col("kind") != "id"
    run = Window.partitionBy("row").orderBy("start", "kind")
    # base spans that begin before, or inside, an instance and reach into it make it known
    ends, starts = F.struct("end", "match"), F.struct("start", "match")
    reach = F.max(F.when(base, ends)).over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    begin = F.min(F.when(base, starts)).over(run.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    placed = spans.where("match is not null").select("*", reach.alias("reach"), begin.alias("begin"))
    under, over = F.coalesce(F.col("reach.end") > F.col("start"), F.lit(False)), F.coalesce(F.col("begin.start") < F.col("end"), F.lit(False))
    # the base span that a place stands for; written without signs, so that two kinds at one place count once
    stands_for = F.lower(F.regexp_replace(F.when(under, F.col("reach.match")).when(over, F.col("begin.match")), r"[^\p{L}\p{N}@.]", ""))
    head = F.lower(F.regexp_extract("match", r"^([^0-9]*)[0-9]", 1))
    patterns = F.array(
        F.when(F.col("before") != "", F.concat(F.lit("before "), "before")), F.when(F.col("after") != "", F.concat(F.lit("after "), "after")),
        F.when(F.length(head) > 2, F.concat(F.lit("head "), head)))
    edges = placed.select("row", "start", "end", F.lower("match").alias("instance"), (under | over).alias("seed"), stands_for.alias("of"), F.explode(F.array_compact(patterns)).alias("pattern"))
    # one row for each pattern and instance, with its places apart: the graph is smaller than the texts
    edges = cut(edges)
    graph = edges.groupBy("pattern", "instance").agg(F.max("seed").alias("known"), F.coalesce(F.min("of"), "instance").alias("of"))
    for _ in range(ROUNDS):
        scores = graph.groupBy("pattern", "of").agg(F.max("known").alias("known")).groupBy("pattern").agg(F.count_if("known").alias("good"), F.count("*").alias("all"))
        strong = cut(scores.where((F.col("good") >= MIN_SUPPORT) & (F.col("good") / (F.col("all") + SMOOTHING) >= MIN_SCORE)).select("pattern"))
        rows = strong.count()
        near = F.broadcast(strong) if rows <= BROADCAST_PATTERNS else strong
        found = cut(graph.join(near, "pattern").where("not known").select("instance").distinct())
        graph = graph.join(found.withColumn("new", F.lit(True)), "instance", "left").select(
            "pattern", "instance", "of", (F.col("known") | F.coalesce("new", F.lit(False))).alias("known"))
    known = graph.where("known").select("instance").distinct()
    return edges.where("not seed").join(known, "instance", "left_semi").select("row", "start", "end").distinct()


def spans(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, text_hash, kind, start, end) for all spans, base and discovered.

    A row of nulls stands for a text without any; ``row`` tells the rows of the input apart.
    """
    rows = text_rows(df, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"), "text")
    found = cut(matches(rows))
    more = discovered(found).withColumn("new", F.lit(True))
    out = found.join(more.select("row", "start", "end", "new"), ["row", "start", "end"], "left")
    keep = F.when((F.col("kind") != "id") | F.col("new"), F.col("kind"))
    return out.select("row", "doc_id", "text_hash", keep.alias("kind"), F.when(keep.isNotNull(), F.col("start")).alias("start"), F.when(keep.isNotNull(), F.col("end")).alias("end"))


def report(spans_of: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_id) for each row of the input."""
    number = F.lit(len(KINDS))
    for k, name in enumerate(KINDS):
        number = F.when(F.col("kind") == name, k).otherwise(number)
    one = F.struct("start", number.alias("k"), F.concat_ws(":", "kind", "start", "end").alias("text"))
    rows = spans_of.groupBy("row", "doc_id").agg(
        *[F.count_if(F.col("kind") == name).alias(f"n_{name}") for name in KINDS],
        F.array_sort(F.collect_list(F.when(F.col("kind") != "id", one))).alias("base"), F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), one))).alias("every"))
    return rows.select("doc_id", *[f"n_{k}" for k in KINDS[:4]], F.sha2(F.array_join("base.text", ",").cast("binary"), 256).alias("base_sha256"),
                       F.array_join("every.text", ",").alias("spans"), "n_id")


def masked(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input with every span in its text replaced by ``<kind>``; overlapping spans become one."""
    found = spans(df, id_col=id_col, text_col=text_col).where("kind is not null").select("doc_id", "text_hash", "kind", "start", "end").distinct()
    run = Window.partitionBy("doc_id", "text_hash").orderBy("start", F.desc("end"), "kind")
    before = F.coalesce(F.max("end").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = found.withColumn("from", before).where(F.col("end") > F.col("from"))
    lists = cuts.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("from", "start", "end", "kind"))).alias("_cuts"))
    # written first: texts are only shuffled where the spans are too many to be sent to all tasks
    lists = cut(lists.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_cuts"))
    if (lists.agg(F.sum(F.size("_cuts"))).first()[0] or 0) <= BROADCAST_SPANS:
        lists = F.broadcast(lists)
    text, cuts_of = df[text_col], lists["_cuts"]
    joined = df.join(lists, df[id_col].eqNullSafe(lists["_id"]) & (F.xxhash64(text) == lists["_hash"]), "left")
    parts = F.transform(cuts_of, lambda c: F.concat(
        F.substr(text, (c["from"] + 1).cast("int"), F.greatest(c["start"] - c["from"], F.lit(0)).cast("int")),
        F.when(c["start"] >= c["from"], F.concat(F.lit("<"), c["kind"], F.lit(">"))).otherwise("")))
    rest = F.substr(text, (F.element_at(cuts_of, -1)["end"] + 1).cast("int"))
    new = F.when(cuts_of.isNull(), text).otherwise(F.concat(F.array_join(parts, ""), rest))
    return joined.select(*[new.alias(c) if c == text_col else df[c] for c in df.columns])
