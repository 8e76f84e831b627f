import json

import pytest
from pyspark.sql import functions as F

from pressline.params import Rules, Site
from pressline.plans import archive
from pressline.session import exists
from pressline.sources import readers

SITE = Site(domain="news.example", name="news")
RULES = Rules(site=SITE)
TEXT = "domaci tekst o dogadaju koji se zbio jucer u gradu pred mnogo ljudi broj "


def html(k, text=TEXT):
    return f'<html lang="hr"><head><title>Naslov</title></head><body><h1 class="entry-title">Naslov vijesti broj {k}</h1><div class="entry-content"><p>{text}{k}</p></div></body></html>'


def pages(spark, *rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, batch_no int")


def lines(path):
    return [json.loads(x) for f in sorted(path.glob("part-*")) for x in f.read_text().splitlines()]


def first_pages(spark):
    return pages(
        spark, (1, "https://news.example/a/", html(1), 1), (2, "https://news.example/b/", html(2), 1), (3, "https://news.example/a/", html(3), 2),
        (4, "https://news.example/c/", html(4, "the that this these those there "), 2), (5, "https://news.example/d/", None, 2), (6, None, html(6), 10))


def texts(spark, out, folder):
    return [r.raw.split("broj ")[1].split("\n")[0] for r in readers.read_articles(spark, f"{out}/{folder}", glob="*.txt").orderBy(*readers.READ_ORDER).collect()]


def test_pages_to_archive_and_on(spark, tmp_path):
    out = str(tmp_path / "run")
    counts = archive.run_archive(first_pages(spark), out, rules=RULES, name="press")
    assert {k: counts[k] for k in ("processed", "rejected", "written", "records", "local", "unique", "input_files")} == {
        "processed": 6, "rejected": 2, "written": 4, "records": 4, "local": 4, "unique": 3, "input_files": 3}
    assert counts["markers"] == 4 and counts["archive_markers"] == 3
    assert texts(spark, out, "archive") == ["1", "2", "6"]
    summary = lines(tmp_path / "run" / "summary")[0]
    assert (summary["total_articles"], summary["unique_articles"], summary["duplicate_articles"], summary["input_files"]) == (4, 3, 1, 3)
    assert lines(tmp_path / "run" / "filter_summary")[0]["batch_dirs_processed"] == 3
    assert "- Success rate: 75.00%" in spark.read.text(f"{out}/report").toPandas()["value"].tolist()
    # the second run scrapes what is new only; a page without URL is never in the ledger
    more = first_pages(spark).where("page_id < 6").unionByName(pages(spark, (7, "https://news.example/e/", html(7), 1), (8, "https://news.example/b/", html(8), 3)))
    again = archive.run_archive(more, out, rules=RULES)
    assert (again["processed"], again["records"], again["unique"]) == (2, 6, 4)
    assert texts(spark, out, "archive") == ["1", "2", "7", "6"]


def test_a_run_that_ends_early_is_done_again(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "run")

    def broken(*args, **options):
        raise OSError("ended before the ledger")

    with monkeypatch.context() as m:
        m.setattr(archive.sinks, "write_progress", broken)
        with pytest.raises(OSError):
            archive.scrape_pages(first_pages(spark), out, rules=RULES)
    assert archive.next_run(spark, out) == 0
    archive.run_archive(first_pages(spark), out, rules=RULES)
    assert archive.next_run(spark, out) == 1
    assert sorted(texts(spark, out, "articles")) == ["1", "2", "3", "6"]


def test_input_is_read_by_one_job(spark, tmp_path, monkeypatch):
    reads = spark.sparkContext.accumulator(0)
    raw = "<***>\nNASLOV: Jedan dva tri cetiri pet\nSTRANA: https://a/{}\nAUTOR(I): A\n\n{}\n\n"
    rows = [(1, "f1", k, raw.format(k % 3, TEXT)) for k in range(6)] + [(2, "f2", 0, raw.format("x", "the that this these"))]

    @F.udf("string")
    def counted(x):
        reads.add(1)
        return x

    df = spark.createDataFrame(rows, "batch_no int, file string, pos long, raw string").withColumn("raw", counted("raw"))
    counts = archive.build_archive(df, str(tmp_path / "a"), rules=RULES, clean=True)
    assert reads.value == len(rows)
    assert (counts["records"], counts["local"], counts["foreign"], counts["unique"], counts["input_files"]) == (7, 6, 1, 3, 1)
    off = archive.build_archive(df, str(tmp_path / "b"), rules=RULES, deduplicate=False, compression="gzip")
    assert off["unique"] == 6
    empty = archive.build_archive(df.where("false"), str(tmp_path / "c"), rules=RULES)
    assert (empty["records"], empty["unique"], empty["markers"], empty["input_files"]) == (0, 0, 0, 0)
    assert lines(tmp_path / "c" / "summary")[0]["total_articles"] == 0


def test_link_run_index_and_rest(spark, tmp_path):
    from pressline.plans.links import link_run, listing_links, read_batches
    from pressline.sources import sinks

    site = SITE
    listing = spark.createDataFrame([(1, "https://news.example/", '<article class="item"><h2><a href="https://news.example/2024/05/x/">T</a></h2></article><div id="main-content"><a href="https://news.example/2023/y.html">u</a>'
                                      '<a href="https://news.example/2024/05/tag/z/">t</a></div><a href="/2022/07/w/">w</a>')], "page_id long, url string, html string")
    more = spark.createDataFrame([(f"https://news.example/2024/05/n{k:02}/",) for k in range(20)] + [("https://news.example/author/a/",), ("https://other/2024/05/x/",)], "url string")
    out = str(tmp_path / "run")
    counts = link_run([*[d.select("url") for d in listing_links(listing, site=site)], more, more], out, site=site, size=10)
    assert counts == {"total_links": 23, "batch_size": 10, "total_batches": 3, "to_do": 23}
    urls = [r.url for r in read_batches(spark, f"{out}/link_batches").orderBy("batch_no", "url").collect()]
    assert urls == sorted(urls) and urls[:2] == ["https://news.example/2022/07/w/", "https://news.example/2023/y.html"] and urls[-1] == "https://news.example/2024/05/x/"
    totals, files = readers.read_batch_index(spark, f"{out}/link_batches")
    assert totals.first().asDict() == {"total_links": 23, "batch_size": 10, "total_batches": 3}
    assert [(r.batch_no, r.n_links) for r in files.orderBy("batch_no").collect()] == [(1, 10), (2, 10), (3, 3)]
    sinks.write_progress(read_batches(spark, f"{out}/link_batches").where("batch_no < 3"), f"{out}/progress")
    again = link_run([more, listing.select("url")], out, site=site, size=10)
    # the ledger knows a URL in its batch: one link has moved to another batch and is done again
    assert (again["total_links"], again["to_do"]) == (21, 21 - 17)


def test_batches_are_discovered_with_and_without_an_index(spark, tmp_path):
    found = lambda d: sorted((r.batch_no, r.file.rsplit("/", 1)[1]) for r in readers.discover_batches(spark, str(d)).collect())
    folder = tmp_path / "link_batches"
    folder.mkdir()
    for k in (1, 2, 10):
        (folder / f"links_batch_{k}.json").write_text('["https://h/"]')
    (folder / "other.json").write_text("[]")
    listed = [(1, "links_batch_1.json"), (2, "links_batch_2.json"), (10, "links_batch_10.json")]
    assert found(folder) == listed
    (folder / "batch_index.json").write_text(json.dumps({"total_links": 1, "batch_size": 1000, "total_batches": 2, "batches": ["a/links_batch_3.json", "a/links_batch_4.json"]}, indent=4))
    assert found(folder) == [(3, "links_batch_3.json"), (4, "links_batch_4.json")]
    assert readers.read_batch_index(spark, str(folder))[0].first().total_batches == 2
    (folder / "batch_index.json").write_text('{"total_links": 1, "batc')
    assert readers.read_batch_index(spark, str(folder)) is None and found(folder) == listed
    assert found(tmp_path / "missing") == []
    own = tmp_path / "own"
    batches = spark.createDataFrame([(1, "https://h/a"), (1, "https://h/b"), (2, "https://h/c")], "batch_no int, url string")
    archive.sinks.write_batches(batches, str(own))
    assert found(own) == [(1, "batch_no=1"), (2, "batch_no=2")]
    archive.sinks.write_batch_index(batches, str(own), size=2)
    assert found(own) == [(1, "batch_no=1"), (2, "batch_no=2")] and exists(spark, f"{own}/_batch_index")
