import json

import pytest
from pyspark.sql import functions as F

from pressline.sources import readers, sinks
from pressline.streaming import incremental


def test_link_files(spark, tmp_path):
    (tmp_path / "ok.json").write_text(json.dumps(["https://a", "https://b"]))
    (tmp_path / "bad.json").write_text("{not json")
    (tmp_path / "none.json").write_text("[]")
    got = readers.read_links(spark, str(tmp_path))
    assert sorted(r.url for r in got.collect()) == ["https://a", "https://b"]
    assert readers.read_links(spark, str(tmp_path / "missing.json")).count() == 0


def test_link_rows_split_and_keep_every_character(spark, tmp_path):
    urls = [f'https://h/č,"{i}\\ x' for i in range(500)] + [""]
    sinks.write_links(spark.createDataFrame([(u,) for u in urls], "url string").coalesce(1), str(tmp_path / "rows"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        rows = readers.read_link_rows(spark, str(tmp_path / "rows"))
        got = sorted(r.url for r in rows.collect())
        assert rows.rdd.getNumPartitions() > 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted(urls)


def test_unfinished_run_is_reported(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "News_batch_1.txt").write_text(record(1, "https://a"))
    with pytest.raises(TimeoutError):
        incremental.run_incremental(
            incremental.stream_articles(spark, str(tmp_path / "src")), str(tmp_path / "out"), str(tmp_path / "ckpt"), timeout=0.001)


def test_link_result(spark, tmp_path):
    result = {"links": ["u1", "u2"], "stats": {"pages_visited": 3, "links_found": 2, "unique_links": 2, "categories": 0, "tags": 0, "authors": 0, "errors": 1},
              "failed_urls": {"x": "404", "y": "max_retries_exceeded"}, "timestamp": "2024-05-17T00:00:00"}
    (tmp_path / "r.json").write_text(json.dumps(result, indent=2))
    links, failed, stats = readers.read_link_result(spark, str(tmp_path / "r.json"))
    assert [r.url for r in links.collect()] == ["u1", "u2"]
    assert {tuple(r) for r in failed.collect()} == {("x", "404"), ("y", "max_retries_exceeded")}
    assert stats.first().pages_visited == 3


def test_sitemap(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>https://h/a?x=1&amp;y=2</loc><lastmod>2024</lastmod></url><url><loc>https://h/b</loc></url></urlset>')
    (tmp_path / "i.xml").write_text("<sitemapindex><sitemap><loc>https://h/s.xml</loc></sitemap></sitemapindex>")
    want = ["https://h/a?x=1&y=2", "https://h/b", "https://h/s.xml"]
    assert sorted(r.url for r in readers.read_sitemap(spark, str(tmp_path)).collect()) == want


def test_robots(spark, tmp_path):
    (tmp_path / "robots.txt").write_text("User-agent: *\nDisallow: /wp-admin/\nAllow: /a:b \nDisallow: /\nDisallow:\n Disallow: /no\nallow: /no\n")
    got = readers.read_robots(spark, str(tmp_path / "robots.txt"), base_url="https://h")
    assert sorted(r.url for r in got.collect()) == ["https://h/a:b", "https://h/wp-admin/"]


def test_ledger_and_batches(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "batch_no int, url string")
    ledger, out = str(tmp_path / "ledger"), str(tmp_path / "batches")
    assert readers.read_progress(spark, ledger).count() == 0
    sinks.write_progress(rows, ledger)
    sinks.write_progress(rows, ledger)
    assert readers.read_progress(spark, ledger).count() == 4
    sinks.write_batches(rows, out)
    sinks.write_batches(rows.where("batch_no = 2"), out)
    assert [p.name for p in (tmp_path / "batches").iterdir() if p.is_dir()] == ["batch_no=2"]


def test_archive_order_and_compression(spark, tmp_path):
    rows = spark.createDataFrame([(b, f"f{b}", 0, i, f"<***>\n{b}-{i}\n\n") for b in (10, 2) for i in (1, 0)], "batch_no int, file string, block long, pos long, raw string")
    sinks.write_archive(rows, str(tmp_path / "z"), compression="gzip")
    files = sorted((tmp_path / "z").glob("*.txt.gz"))
    text = "".join(r.value for f in files for r in spark.read.text(str(f), wholetext=True).collect())
    assert text == "<***>\n2-0\n\n<***>\n2-1\n\n<***>\n10-0\n\n<***>\n10-1\n\n"


def record(i, url):
    return f"<***>\nNASLOV: T{i}\n" + (f"STRANA: {url}\n" if url else "") + f"AUTOR(I): A\n\nb {i}\n\n"


def test_incremental_resume(spark, tmp_path):
    src, out, ckpt = (tmp_path / n for n in ("src", "out", "ckpt"))
    src.mkdir()
    run = lambda t=lambda d: d: incremental.run_incremental(
        incremental.stream_articles(spark, str(src)), str(out), str(ckpt), transform=t)
    (src / "News_batch_1.txt").write_text(record(1, "https://a") + record(2, None))
    run()
    run()  # nothing new
    (src / "News_batch_2.txt").write_text(record(3, "https://a"))
    run()
    got = spark.read.parquet(str(out))
    assert got.count() == 3 and {r.batch_no for r in got.collect()} == {1, 2}


def test_streaming_first_seen_over_runs(spark, tmp_path):
    src, out, ckpt = (tmp_path / n for n in ("src", "out", "ckpt"))
    src.mkdir()
    dedup = lambda d: incremental.stream_dedup(incremental.with_url(d))
    run = lambda: incremental.run_incremental(
        incremental.stream_articles(spark, str(src)), str(out), str(ckpt), transform=dedup)
    (src / "News_batch_1.txt").write_text(record(1, "https://a") + record(2, None) + record(3, "https://b") + record(4, "https://a"))
    run()
    (src / "News_batch_2.txt").write_text(record(5, "https://a") + record(6, None) + record(7, "https://c"))
    run()
    got = spark.read.parquet(str(out)).collect()
    assert sorted(r.url for r in got if r.url) == ["https://a", "https://b", "https://c"]
    assert sum(r.url is None for r in got) == 2


def test_watermark_variant_bounds_its_state(spark, tmp_path):
    src, out, ckpt = (tmp_path / n for n in ("src", "out", "ckpt"))
    src.mkdir()
    (src / "News_batch_1.txt").write_text(record(1, "https://a") + record(2, "https://a"))
    timed = lambda d: incremental.stream_dedup(
        incremental.with_url(d).withColumn("seen", F.to_timestamp(F.lit("2024-05-17 00:00:00"))), watermark=("seen", "1 day"))
    incremental.run_incremental(incremental.stream_articles(spark, str(src)), str(out), str(ckpt), transform=timed)
    assert spark.read.parquet(str(out)).count() == 1


def first_seen(spark, src, out, ckpt):
    incremental.run_first_seen(incremental.with_url(incremental.stream_articles(spark, str(src))), str(out), str(ckpt))
    return spark.read.parquet(str(out))


def test_first_seen_keeps_the_first_in_reading_order(spark, tmp_path):
    import os

    from pressline.operators.dedup import dedup_first_seen
    from pressline.session import shared_dir

    src, out, ckpt = (tmp_path / n for n in ("src", "out", "ckpt"))
    src.mkdir()
    (src / "News_batch_2.txt").write_text(record(1, "https://a") + record(2, None) + record(3, "https://a") + record(4, "https://b"))
    (src / "News_batch_1.txt").write_text(record(5, "https://b") + record(6, "https://b") + record(7, "https://d"))
    left = lambda: {f for f in os.listdir(shared_dir(spark).removeprefix("file:")) if f.startswith("cut")}
    before = left()
    first_seen(spark, src, out, ckpt)
    first_seen(spark, src, out, ckpt)  # nothing new
    assert left() == before
    (src / "News_batch_3.txt").write_text(record(8, "https://a") + record(9, None) + record(10, "https://c") + record(11, "https://c"))
    first_seen(spark, src, out, ckpt)
    # late file: its place in the order comes first, but its keys are known
    (src / "News_batch_0.txt").write_text(record(12, "https://c") + record(13, "https://e"))
    got = first_seen(spark, src, out, ckpt)
    number = lambda rows: sorted(int(r.raw.split("NASLOV: T")[1].split("\n")[0]) for r in rows)
    assert number(got.collect()) == [1, 2, 5, 7, 9, 10, 13]
    whole = incremental.with_url(readers.read_articles(spark, str(src)).where("batch_no > 0"))
    assert number(dedup_first_seen(whole, order=readers.READ_ORDER).collect()) == [1, 2, 5, 7, 9, 10]


def test_a_broken_run_repeats_and_loses_nothing(spark, tmp_path, monkeypatch):

    src, out, ledger, ckpt = (tmp_path / n for n in ("src", "out", "ledger", "ckpt"))
    src.mkdir()
    run = lambda: incremental.run_with_ledger(
        incremental.stream_articles(spark, str(src)), str(out), str(ledger), str(ckpt), transform=incremental.with_url)
    (src / "News_batch_1.txt").write_text(record(1, "https://a") + record(2, None))
    run()
    (src / "News_batch_2.txt").write_text(record(3, "https://b") + record(4, "https://b") + record(5, "https://c"))
    real = incremental.run_path

    def broken(table, number):
        if table == str(ledger) and number == 1:
            raise OSError("ended between rows and ledger")
        return real(table, number)

    monkeypatch.setattr(incremental, "run_path", broken)
    with pytest.raises(Exception, match="ended between"):
        run()
    assert spark.read.parquet(str(out)).count() == 5 and readers.read_progress(spark, str(ledger)).count() == 1
    monkeypatch.setattr(incremental, "run_path", real)
    run()
    run()
    assert spark.read.parquet(str(out)).count() == 5
    assert {(r.batch_no, r.url) for r in readers.read_progress(spark, str(ledger)).collect()} == {(1, "https://a"), (2, "https://b"), (2, "https://c")}


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_link_arrays_are_read_split_by_split(spark, tmp_path, small_splits):
    import random

    rng = random.Random(1)
    odd = ['a"b', "back\\slash", "end\\", "\\\"", "č 中", "tab\t", "", "[x]", ",", " , ", "]", "{}", " ", "/"]
    files = {}
    for k in range(6):
        links = [rng.choice(odd) if rng.random() < (0, 0, 0.1, 0.5, 1, 0.02)[k] else f"https://h/{k}/{rng.randrange(10**6)}/" for _ in range(120)]
        files[f"array{k}"] = (json.dumps(links, ensure_ascii=bool(k % 2), indent=k % 3 or None), links)
    files |= {"empty": ("", []), "none": (" [ ] ", []), "one": ('["x"]', ["x"]), "numbers": ('["a", 1, null, true, "b"]', ["a", "1", None, "true", "b"])}
    good = json.dumps([f"https://h/{k}" for k in range(100)])
    damaged = {"cut": good[:-1], "no comma": good.replace('", "https://h/50', '" "https://h/50'), "escape": good.replace("/70", "\\q70"), "line": good.replace("/70", "\n70"),
               "object": '{"a": "b"}', "open": good.replace('/60"', "/60"), "no bracket": good[1:]}
    for name, text in [*((n, t) for n, (t, _) in files.items()), *damaged.items()]:
        (tmp_path / f"{name}.json").write_text(text)
    got = {}
    table = readers.read_links(spark, str(tmp_path))
    for r in table.collect():
        got.setdefault(r.file.rsplit("/", 1)[1].replace("%20", " ").removesuffix(".json"), []).append(r.url)
    for name, (_, want) in files.items():
        assert sorted(got.get(name, []), key=str) == sorted(want, key=str), name
    whole = spark.read.text([str(tmp_path / f"{n}.json") for n in damaged], wholetext=True)
    before = whole.select(F.explode(F.from_json("value", "array<string>")).alias("url")).collect()
    assert sorted((u for n in damaged for u in got.get(n, [])), key=str) == sorted((r.url for r in before), key=str)
    one = readers.read_links(spark, str(tmp_path / "array0.json"))
    assert one.rdd.getNumPartitions() > 3 and one.count() == 120


def test_sitemaps_are_read_in_one_scan(spark, tmp_path, small_splits):
    urls = [f"https://h/{k}?a=1&b={k}" for k in range(80)]
    body = "".join(f"<url>\n  <loc>\n {u.replace('&', '&amp;')}</loc><image:image><image:loc>https://i/{k}</image:loc></image:image></url>" for k, u in enumerate(urls))
    (tmp_path / "a.xml").write_text(f'<?xml version="1.0"?><urlset xmlns:image="x">{body}</urlset>')
    (tmp_path / "b.xml").write_text("<sitemapindex><sitemap><loc><![CDATA[https://h/c?x&y]]></loc></sitemap><sitemap><loc>https://h/&#x10D;&#269;</loc></sitemap><loc> </loc><loc>bad & end</loc><loc>cut")
    found = readers.read_sitemap(spark, str(tmp_path))
    want = {*urls, "https://h/c?x&y", "https://h/čč", "bad & end"}
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r.url for r in found.collect()} == want
    held = spark.read.text(str(tmp_path), wholetext=True)
    assert {r.url for r in readers.sitemap_locs(held).collect()} == want


def test_link_results_are_read_split_by_split(spark, tmp_path, small_splits):
    odd = ['a"b', "back\\", "č", "]", "}", ": ", "links", "failed_urls"]
    stats = {"pages_visited": 3, "links_found": 2, "unique_links": 2, "categories": 0, "tags": 0, "authors": 0, "errors": 1}
    files = {
        "large": {"links": [f"https://h/{k}" for k in range(200)], "stats": stats, "failed_urls": {f"https://f/{k}": "404" for k in range(100)}, "timestamp": "t1"},
        "odd": {"timestamp": "t2", "failed_urls": {x: "r" + x for x in odd}, "links": odd, "stats": stats},
        "empty": {"links": [], "stats": stats, "failed_urls": {}, "timestamp": "t3"},
        "some": {"links": ["x"], "timestamp": "t4"},
        "extra": {"links": ["y"], "more": {"links": ["no"], "deep": [["no"]]}, "stats": stats, "failed_urls": {"z": "500"}, "timestamp": "t5"},
        "numbers": {"links": ["n1", 2, None], "stats": stats, "failed_urls": {"m": "410"}, "timestamp": "t6"},
    }
    for k, (name, value) in enumerate(files.items()):
        (tmp_path / f"{name}.json").write_text(json.dumps(value, indent=(2, None)[k % 2]))
    links, failed, summary = readers.read_link_result(spark, str(tmp_path))
    plain = spark.read.schema(readers.schemas.LINK_RESULT).json(str(tmp_path), multiLine=True)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(links) == rows(plain.select(F.explode("links")))
    assert rows(failed) == rows(plain.select(F.explode("failed_urls")))
    assert rows(summary) == rows(plain.select("stats.*", "timestamp"))
    assert len(rows(links)) == 200 + len(odd) + 1 + 1 + 3 and len(rows(summary)) == 6
    assert [d.count() for d in readers.read_link_result(spark, str(tmp_path / "missing"))] == [0, 0, 0]
