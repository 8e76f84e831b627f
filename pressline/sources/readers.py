"""Readers: link files, archives, pages, sitemaps, robots rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressline import fixed_values as fv
from pressline import schemas
from pressline.functions import urls as U
from pressline.functions.text import strip
from pressline.operators.batches import batch_no_of
from pressline.operators.records import with_marker
from pressline.session import cut, exists

ARCHIVE_GLOB = "*_batch_*.txt"


#: one row for each split of the link files; beyond that the join is left to the planner
BROADCAST_SPLITS = 1_000_000
JSON_SPACE = r"[ \t\r\n]*"


def _between_quotes(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, id, value): the pieces of JSON files between quotation marks.

    The quotation mark is the line separator, so a large file is read by many
    tasks.  ``id`` grows by one from piece to piece of a split.
    """
    pieces = spark.read.option("lineSep", '"').option("recursiveFileLookup", True).text(path)
    return pieces.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")


def _unescaped(value: Column) -> Column:
    """Content of a JSON string, NULL where its escapes are wrong."""
    return F.when(~F.contains(value, F.lit("\\")), value).otherwise(
        F.get(F.from_json(F.concat(F.lit('["'), value, F.lit('"]')), "array<string>", {"mode": "PERMISSIVE"}), F.lit(0)))


def _string_arrays(pieces: DataFrame) -> DataFrame:
    """(file, block, first, before, regular): one row for each split of the files.

    Pieces of an array of strings lie outside and inside strings in turn.  Which
    of a split's pieces are which is known once the pieces of the splits before
    it are counted (``before``); until then both readings are checked.  A file is
    ``regular`` if all its pieces fit: brackets at its ends, commas outside and
    whole JSON strings inside.
    """
    odd, value = F.col("id") % 2, F.col("value")
    no_comma = ~value.rlike(f"^{JSON_SPACE},{JSON_SPACE}$")
    no_string = value.rlike(r"[\x00-\x1f]") | value.rlike(r"(?<!\\)(?:\\\\)*\\$") | _unescaped(value).isNull()

    def bad(parity: int, test: Column) -> Column:
        return F.count_if((odd == parity) & test)

    splits = pieces.groupBy("file", "block").agg(
        F.min("id").alias("first"), F.count("*").alias("n"), F.min_by("value", "id").alias("head"), F.max_by("value", "id").alias("tail"),
        # pieces with an even id outside and the others inside, and the other way round
        (bad(0, no_comma) + bad(1, no_string)).alias("bad_even"), (bad(1, no_comma) + bad(0, no_string)).alias("bad_odd"))
    in_file = Window.partitionBy("file").orderBy("block")  # one row a split
    before = F.coalesce(F.sum("n").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = splits.withColumn("before", before)
    misfits = F.when((F.col("first") - F.col("before")) % 2 == 0, F.col("bad_even")).otherwise(F.col("bad_odd"))
    whole = Window.partitionBy("file")
    head = F.min_by("head", "block").over(whole).rlike(rf"^{JSON_SPACE}\[{JSON_SPACE}$")
    tail = F.max_by("tail", "block").over(whole).rlike(rf"^{JSON_SPACE}\]{JSON_SPACE}$")
    # the brackets are the two pieces that are no commas
    regular = head & tail & (F.sum("n").over(whole) % 2 == 1) & (F.sum(misfits).over(whole) == 2)
    return placed.select("file", "block", "first", "before", regular.alias("regular"))


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """``(file, url)`` from JSON arrays of strings; a missing or bad file is empty.

    Arrays of plain strings are read split by split, however large a file is.
    Files with anything else between the strings (numbers, nested values,
    damage) are read whole, one task a file.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], "file string, url string")
    pieces = _between_quotes(spark, path)
    splits = cut(_string_arrays(pieces))
    regular = splits.where("regular").select(F.col("file").alias("_file"), F.col("block").alias("_block"), (F.col("before") - F.col("first")).alias("_shift"))
    if splits.count() <= BROADCAST_SPLITS:
        regular = F.broadcast(regular)
    placed = pieces.join(regular, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    links = placed.where(F.pmod(F.col("id") + F.col("_shift"), F.lit(2)) == 1).select("file", _unescaped(F.col("value")).alias("url"))
    others = splits.where(~F.col("regular")).select("file").distinct()
    if others.isEmpty():
        return links
    whole = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).withColumn("file", F.col("_metadata.file_path"))
    array = F.from_json("value", "array<string>", {"mode": "PERMISSIVE"})
    return links.unionByName(whole.join(others, "file", "left_semi").select("file", F.explode(array).alias("url")))


def read_link_rows(spark: SparkSession, path: str) -> DataFrame:
    """Links as ``sinks.write_links`` leaves them: one JSON row each."""
    return spark.read.schema("url string").json(path)


def _numbered(pieces: DataFrame) -> DataFrame:
    """(file, i, value): pieces with their number in the file; even ones lie outside strings, odd ones inside."""
    splits = cut(pieces.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n")))
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a split
    shift = splits.select(
        F.col("file").alias("_file"), F.col("block").alias("_block"), (F.coalesce(F.sum("n").over(in_file), F.lit(0)) - F.col("first")).alias("_shift"))
    if splits.count() <= BROADCAST_SPLITS:
        shift = F.broadcast(shift)
    placed = pieces.join(shift, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    return placed.select("file", (F.col("id") + F.col("_shift")).alias("i"), "value")


def _sections(numbered: DataFrame) -> DataFrame:
    """(file, name, start, end): the containers directly in a file's object, by the pieces with their brackets."""
    outside = F.col("i") % 2 == 0
    opens, closes = F.col("value").rlike(rf"[\[{{]{JSON_SPACE}$"), F.col("value").rlike(rf"^{JSON_SPACE}[\]}}]")
    marks = cut(numbered.where(outside & (opens | closes)).select("file", "i", opens.alias("opens"), closes.alias("closes")))
    names = numbered.join(marks.where("opens").select("file", (F.col("i") - 1).alias("i")), ["file", "i"]).select("file", (F.col("i") + 1).alias("i"), F.col("value").alias("name"))
    in_file = Window.partitionBy("file").orderBy("i")
    depth = F.sum(F.col("opens").cast("int") - F.col("closes").cast("int")).over(in_file)
    ends = F.min(F.when(F.col("closes"), F.col("i"))).over(in_file.rowsBetween(1, Window.unboundedFollowing))
    return marks.select("*", depth.alias("depth"), ends.alias("end")).where("opens and depth = 2 and not closes").join(names, ["file", "i"]).select(
        "file", "name", F.col("i").alias("start"), "end")


def read_link_result(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links, failed URLs with their reason, and the statistics of a link result.

    The list of links and the map of failed URLs are read split by split, however
    large they are; what is left of a file is small.  A file whose list or map
    holds anything but strings is read whole, one task a file.
    """
    if not exists(spark, path):
        empty = spark.createDataFrame([], schemas.LINK_RESULT)
        return empty.select(F.explode("links").alias("url")), empty.select(F.explode("failed_urls").alias("url", "reason")), empty.select("stats.*", "timestamp")
    numbered = _numbered(_between_quotes(spark, path))
    sections = cut(_sections(numbered).where(F.col("name").isin("links", "failed_urls")).withColumnRenamed("file", "_file"))
    met = numbered.join(sections, (F.col("file") == F.col("_file")) & (F.col("i") > F.col("start")) & (F.col("i") < F.col("end"))).select(
        "file", "name", (F.col("i") - F.col("start") - 1).alias("k"), "value")
    comma, colon = (F.col("value").rlike(f"^{JSON_SPACE}{c}{JSON_SPACE}$") for c in ",:")
    inside, is_map = F.col("k") % 2 == 0, F.col("name") == "failed_urls"
    string = ~F.col("value").rlike(r"[\x00-\x1f]") & ~F.col("value").rlike(r"(?<!\\)(?:\\\\)*\\$") & _unescaped(F.col("value")).isNotNull()
    fits = F.when(inside, string).when(is_map & (F.col("k") % 4 == 1), colon).otherwise(comma)
    checked = met.groupBy("file", "name").agg(F.bool_and(fits).alias("fits"), F.max("k").alias("last"))
    # strings stand at even places, and those of a map come in pairs
    whole = F.when(is_map, F.col("last") % 4 == 2).otherwise(F.col("last") % 2 == 0)
    odd = checked.where(~(F.col("fits") & whole)).select("file")
    twice = sections.groupBy("_file", "name").agg(F.count("*").alias("n"), F.count("end").alias("ends")).where("n > 1 or ends < n").select(F.col("_file").alias("file"))
    irregular = cut(odd.unionByName(twice).distinct())
    regular = met.join(irregular, "file", "left_anti").where(inside)
    url = _unescaped(F.col("value"))
    links = regular.where(~is_map).select(url.alias("url"))
    pair = F.floor(F.col("k") / 4)
    failed = regular.where(is_map).groupBy("file", pair.alias("pair")).agg(
        F.max(F.when(F.col("k") % 4 == 0, url)).alias("url"), F.max(F.when(F.col("k") % 4 == 2, url)).alias("reason")).select("url", "reason")
    # the rest of a file: all pieces but those in a list or map that was read
    inner = sections.join(irregular.withColumnRenamed("file", "_file"), "_file", "left_anti")
    rest = numbered.join(inner, (F.col("file") == F.col("_file")) & (F.col("i") > F.col("start")) & (F.col("i") < F.col("end")), "left_anti")
    begins = inner.select(F.col("_file").alias("file"), F.col("start").alias("i"), F.lit("").alias("quote"))
    rest = rest.join(begins, ["file", "i"], "left").select("file", "i", F.concat("value", F.coalesce("quote", F.lit('"'))).alias("value"))
    text = rest.groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "value"))), lambda p: p["value"]), "").alias("value"))
    result = text.select(F.from_json(F.regexp_replace("value", '"$', ""), schemas.LINK_RESULT, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")
    links = links.unionByName(result.select(F.explode("links").alias("url")))
    failed = failed.unionByName(result.select(F.explode("failed_urls").alias("url", "reason")))
    return links, failed, result.select("stats.*", "timestamp")


def read_batch_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame] | None:
    """(totals, files) of the batch index in a folder, None where there is none that can be read.

    ``totals`` is one row, ``files`` has (batch_no, file, n_links).  The index is
    what ``sinks.write_batch_index`` leaves, or one ``batch_index.json`` with the
    totals and an array ``batches`` of paths.
    """
    if exists(spark, f"{path}/_batch_list") and exists(spark, f"{path}/_batch_index"):
        return spark.read.schema(schemas.BATCH_TOTALS).json(f"{path}/_batch_index"), spark.read.schema(schemas.BATCH_FILE).json(f"{path}/_batch_list")
    if not exists(spark, f"{path}/batch_index.json"):
        return None
    index = spark.read.schema(schemas.BATCH_INDEX).json(f"{path}/batch_index.json", multiLine=True)
    if index.where(F.col("batches").isNull()).limit(1).count() or index.isEmpty():
        return None
    files = index.select(F.explode("batches").alias("file"))
    return index.drop("batches"), files.select(batch_no_of("file").alias("batch_no"), "file", F.lit(None).cast("bigint").alias("n_links"))


def discover_batches(spark: SparkSession, path: str) -> DataFrame:
    """(batch_no, file) of the link batches in a folder: as the index has them, without a readable index as the folder has them.

    A listing gives the files ``links_batch_<n>.json`` and the folders
    ``batch_no=<n>``; it reads no content.
    """
    index = read_batch_index(spark, path)
    if index is not None:
        return index[1].select("batch_no", "file")
    if not exists(spark, path):
        return spark.createDataFrame([], "batch_no int, file string")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("path").alias("file"))
    own = F.regexp_extract("file", r"(.*/batch_no=\d+)/part-[^/]*\.json[^/]*$", 1)
    named = F.col("file").rlike(r"/links_batch_[^/]*\.json$")
    found = listed.select(F.when(named, F.col("file")).otherwise(F.nullif(own, F.lit(""))).alias("file")).where("file is not null").distinct()
    return found.select(batch_no_of("file").alias("batch_no"), "file")


def read_articles(spark: SparkSession, path: str, *, glob: str = ARCHIVE_GLOB, recursive: bool = True,
                  marker: str = fv.RECORD_MARKER, default_batch: int = 0) -> DataFrame:
    """Archive records: (batch_no, file, block, pos, raw).

    The marker is the line separator, so archive files split like any text file.
    (batch_no, file, block, pos) is the reading order: ``block`` is the start of
    the split in its file and ``pos`` grows inside a split.
    """
    chunks = (
        spark.read.option("lineSep", marker).option("pathGlobFilter", glob)
        .option("recursiveFileLookup", recursive).text(path)
    )
    return (
        chunks.select(
            batch_no_of("_metadata.file_path", default_batch).alias("batch_no"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"),
            with_marker("value").alias("raw"),
            "value",
        )
        .where(not_blank("value")).drop("value")
    )


def not_blank(c: str) -> Column:
    return strip(c) != ""


def read_articles_whole(spark: SparkSession, path: str, *, glob: str = ARCHIVE_GLOB, recursive: bool = True,
                        marker: str = fv.RECORD_MARKER, default_batch: int = 0) -> DataFrame:
    """Same rows for small files read whole; ``pos`` is the place in the file."""
    files = (
        spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", recursive)
        .text(path, wholetext=True)
    )
    chunks = files.select(
        F.col("_metadata.file_path").alias("file"),
        F.posexplode(F.split("value", rf"\Q{marker}\E")).alias("pos", "value"),
    )
    return chunks.where(not_blank("value")).select(
        batch_no_of("file", default_batch).alias("batch_no"), "file",
        F.lit(0).cast("bigint").alias("block"), F.col("pos").cast("bigint").alias("pos"),
        with_marker("value").alias("raw"),
    )


READ_ORDER = ("batch_no", "file", "block", "pos")


def list_files(df: DataFrame) -> DataFrame:
    """Distinct (batch_no, file) of a record table."""
    return df.select("batch_no", "file").distinct()


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAGES).parquet(path)


#: text that is XML as it stands, and so can be given to the XML functions
XML_TEXT = r"^[^<&]*+(?:&(?:#[0-9]{1,6}|#x[0-9a-fA-F]{1,5}|amp|lt|gt|quot|apos);[^<&]*+)*+$"


def _loc(after: Column) -> Column:
    """Address at the beginning of the text behind ``<loc>``: white space trimmed, references and CDATA resolved."""
    inner = strip(F.substring_index(after, "</loc>", 1))
    data = F.regexp_extract(inner, r"(?s)^<!\[CDATA\[(.*)\]\]>$", 1)
    decoded = F.when(F.contains(inner, F.lit("&")) & inner.rlike(XML_TEXT), F.xpath_string(F.concat(F.lit("<a>"), inner, F.lit("</a>")), F.lit("/a")))
    return strip(F.when(F.startswith(inner, F.lit("<![CDATA[")), data).otherwise(F.coalesce(decoded, inner)))


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """Every ``<loc>`` of url sets and of sitemap indexes as a URL row.

    The start tag is the line separator: one scan finds the addresses of both
    kinds, and a large file is read by many tasks.  Tags of other name spaces
    (``<image:loc>``) are other tags.
    """
    pieces = spark.read.option("lineSep", "<loc>").option("recursiveFileLookup", True).text(path)
    found = pieces.where(F.contains("value", F.lit("</loc>"))).select(_loc(F.col("value")).alias("url"))
    return found.where("url <> ''").distinct()


def sitemap_locs(texts: DataFrame, *, text: str = "value") -> DataFrame:
    """``<loc>`` values of sitemap documents held as text."""
    pieces = texts.select(F.explode(F.slice(F.split(text, "<loc>"), 2, 2**31 - 1)).alias("value"))
    found = pieces.where(F.contains("value", F.lit("</loc>"))).select(_loc(F.col("value")).alias("url"))
    return found.where("url <> ''").distinct()


def parse_robots(texts: DataFrame, *, base: str = "base", text: str = "value") -> DataFrame:
    """Allow and Disallow paths as absolute URLs; empty and ``/`` are left out."""
    lines = texts.select(base, F.explode(F.split(text, "\n")).alias("line"))
    rules = lines.where(F.col("line").rlike("^(Disallow|Allow):"))
    path = strip(F.regexp_replace("line", "^[^:]*:", ""))
    paths = rules.select(base, path.alias("path")).where((F.col("path") != "") & (F.col("path") != "/"))
    return paths.select(U.url_join(base, "path").alias("url")).distinct()


def read_robots(spark: SparkSession, path: str, *, base_url: str) -> DataFrame:
    texts = spark.read.text(path, wholetext=True).select("value", F.lit(base_url).alias("base"))
    return parse_robots(texts)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """Progress ledger; an empty one if nothing was processed yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.PROGRESS)
    return spark.read.schema(schemas.PROGRESS).json(path)
