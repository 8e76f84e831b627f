import pytest
from pyspark.sql import functions as F

from pressline.functions.text import clean_text
from pressline.operators import records
from pressline.operators.language import language_verdict
from pressline.params import Blacklist, Site
from pressline.sources import readers, sinks

SCHEMA = "url string, title string, date string, author string, category string, subtitle string, content string"


def rendered(spark, *rows, **options):
    return records.render_records(spark.createDataFrame(list(rows), SCHEMA), **options)


def test_record_layout(spark):
    raw = rendered(spark, ("https://x/1", "Naslov", "01.02.2024", "Ana", "Sport", None, "Prvi.\n\nDrugi.")).first().raw
    assert raw == (
        "<***>\nNOVINA: news.example\nDATUM: 01.02.2024\nRUBRIKA: Sport\nNADNASLOV: N/A\nNASLOV: Naslov\n"
        "PODNASLOV: N/A\nSTRANA: https://x/1\nAUTOR(I): Ana\n\nPrvi.\n\nDrugi.\n\n"
    )


def test_not_written(spark):
    rows = [("u", "", None, None, None, None, "b"), ("u", "t", None, None, None, None, "N/A"), ("u", "t", None, None, None, None, None)]
    assert [r.raw for r in rendered(spark, *rows).collect()] == [None, None, None]
    # an unknown title is not a blank one
    assert "\nNASLOV: N/A\n" in rendered(spark, ("u", None, None, None, None, None, "b")).first().raw
    failed = spark.createDataFrame([("u", "t", "b", "E: x"), ("u", "t", "b", None)], "url string, title string, content string, error string")
    full = failed.select("*", *[F.lit(None).cast("string").alias(c) for c in ("date", "author", "category", "subtitle")])
    got = records.render_records(full, extracted=True).collect()
    assert got[0].raw is None and got[1].raw.endswith("\n\nb\n\n")


def test_blacklisted_subtitle_is_masked(one):
    bl = Blacklist(subtitles=("zabranjeno",))
    assert one([records.mask_subtitle("s", bl)], s="ovo je zabranjeno ovdje") is None
    assert one([records.mask_subtitle("s", bl)], s="ovo nije") == "ovo nije"


def test_parse_default_and_compat(spark):
    df = rendered(spark, ("https://x/1", "Pravi naslov", "01.02.2024", "Ana", "Sport", "Pod", "Prvi.\n\nDrugi."))
    good = records.parse_records(df.select("raw")).first()
    assert (good.title, good.subtitle, good.category, good.date, good.author, good.url) == (
        "Pravi naslov", "Pod", "Sport", "01.02.2024", "Ana", "https://x/1")
    assert good.content == "Prvi.\n\nDrugi."
    old = records.parse_records(df.select("raw"), compat=True).first()
    assert old.title is None          # read out of "NADNASLOV: N/A"
    assert old.content == "Drugi."    # text behind the last blank line


def test_rejoined_record_has_no_body_in_compat(spark):
    df = rendered(spark, ("https://x/1", "The law", "d", "a", "c", "s", "the that this these")).withColumn("raw", F.concat("raw", F.lit("\n")))
    compat = records.parse_records(df.select("raw"), compat=True)
    assert (compat.first().content or "") == ""
    assert language_verdict(compat).first().is_foreign is False
    assert language_verdict(records.parse_records(df.select("raw"))).first().is_foreign is True


def test_render_parse_identity(spark):
    rows = [(f"https://x/{i}", f"T {i}", "d", "a", "c", "s", f"a{i}\n\nNASLOV: not a header\n\nb") for i in range(5)]
    back = records.parse_records(rendered(spark, *rows).select("raw")).orderBy("url").collect()
    assert [(r.url, r.title, r.content) for r in back] == [(r[0], r[1], r[6]) for r in rows]


def test_record_url(one):
    assert one([records.record_url("r")], r="x\nSTRANA: https://a/ \n") == "https://a/"
    assert one([records.record_url("r")], r="no url") is None


def test_marker_put_back(one):
    assert one([records.with_marker("r")], r="\nA") == "<***>\nA"
    assert one([records.with_marker("r")], r="<***>\nA") == "<***>\nA"


def test_clean_text(one):
    assert one([clean_text("t")], t="a\n\n\n\nb  , c\n\n!") == "a\n\nb, c!"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def record(i, url=None, body="b"):
    head = f"<***>\nNASLOV: T{i}\n"
    return head + (f"STRANA: {url}\n" if url else "") + f"AUTOR(I): A\n\n{body} {i}\n\n"


@pytest.fixture
def archive(tmp_path):
    for b in (2, 10):
        write(tmp_path / f"articles_batch_{b}" / "News_batch_1.txt", "".join(record(i, f"https://x/{i}") for i in range(200)))
        write(tmp_path / f"articles_batch_{b}" / "notes.md", "<***>\nnot an archive")
    write(tmp_path / "News_batch_7.txt", record(0) + "<***>\n \n" + record(1))
    return tmp_path


def test_discovery_order_and_blank_chunks(spark, archive):
    got = readers.read_articles(spark, str(archive))
    assert {(r.batch_no, r.n) for r in got.groupBy("batch_no").agg(F.count("*").alias("n")).collect()} == {(2, 200), (10, 200), (7, 2)}
    top = readers.read_articles(spark, str(archive), recursive=False)
    assert top.count() == 2


def test_split_reading_keeps_file_order(spark, archive):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        split = readers.read_articles(spark, str(archive)).where("batch_no = 2")
        assert split.select("block").distinct().count() > 5
        rows = split.orderBy(*readers.READ_ORDER).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = readers.read_articles_whole(spark, str(archive)).where("batch_no = 2").orderBy(*readers.READ_ORDER).collect()
    assert [r.raw for r in rows] == [r.raw for r in whole]
    assert len(rows) == 200 and "T199" in rows[-1].raw


def test_sinks_append_and_split(spark, tmp_path):
    df = rendered(spark, *[(f"https://x/{i}", f"T{i}", "d", "a", "c", "s", f"b{i}") for i in range(6)]).withColumn(
        "batch_no", (F.substring("title", 2, 1).cast("int") % 2) + 1)
    out = str(tmp_path / "out")
    sinks.write_articles(df, out)
    sinks.write_articles(df, out)  # a second flush adds to the batch, it replaces nothing
    assert readers.read_articles(spark, out, glob="*.txt").count() == 12
    side = df.withColumn("lang_side", F.lit("local"))
    sinks.write_split(side, str(tmp_path / "split"))
    assert [p.name for p in (tmp_path / "split").iterdir() if p.is_dir()] == ["lang_side=local"]


def test_marker_count(spark, archive):
    text = spark.read.text(str(archive / "articles_batch_2"), wholetext=True).where(F.contains("value", F.lit("T1")))
    assert records.marker_count(text, text="value").first().markers == 200


def test_site_is_a_parameter(spark):
    raw = rendered(spark, ("u", "t", "d", "a", "c", "s", "b"), site=Site(domain="list.example")).first().raw
    assert "NOVINA: list.example\n" in raw
