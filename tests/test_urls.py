from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from pressline.functions import urls as U
from pressline.operators import links
from pressline.params import Blacklist, Site

SITE = Site(domain="news.example")
BASE = "https://news.example/a/b/c.html?x=1#top"
HREFS = [
    "a", "/a", "//news.example/a", "../a", "../../../a", "?q", "#f", "", "./x/../y", "..", ".", "x//y", "/p/./q/../r/",
    "https://other.example/z", "mailto:a@b", "x?y=../z#w",
]


def test_join_agrees_with_the_standard_library(spark):
    for base in (BASE, "https://news.example", "http://h.example/x/"):
        df = spark.createDataFrame([(h,) for h in HREFS], "href string").select("href", U.url_join(F.lit(base), "href").alias("u"))
        for r in df.collect():
            assert r.u == urljoin(base, r.href), (base, r.href)


def test_extract_keeps_own_host_and_names_kinds(page):
    html = "".join(f'<a href="{h}">t</a>' for h in (
        "x", "/category/s/", "/tag/t/", "/author/w/", "https://m.news.example/x", "x", "/category/tag/author/"))
    got = {(r.url, r.kind) for r in links.extract_links(page(html), site=SITE).collect()}
    at = "https://news.example"
    assert got == {
        (at + "/a/x", None), (at + "/category/s/", "category"), (at + "/tag/t/", "tag"),
        (at + "/author/w/", "author"), (at + "/category/tag/author/", "category"),
    }


@pytest.mark.parametrize("path, want", [
    ("/2024/05/slug/", True), ("/a/b.html", True), ("/category/x/", False), ("/slug/", True),
    ("/feed/a.html", False), ("/page/3/", False), ("/a-12/", True), ("/slug", False), ("/x.pdf", False), ("/wp-json/a/", False),
])
def test_article_urls(one, path, want):
    assert one([U.is_article_url("u", SITE).cast("string")], u="https://news.example" + path) == str(want).lower()


def test_blacklist_order_and_reasons(spark):
    bl = Blacklist(urls=("https://news.example/bad/",), terms=("too hot", "nell"))
    rows = [
        ("https://news.example/bad/", "The x", "url"), ("https://news.example/x/", "The x", "title_start"),
        ("https://news.example/x/", "kako that would have been", "title_indicators"),
        ("https://news.example/x/", "jako Nell danas", "title_term"), ("https://news.example/too-hot/", "", "url_term"),
        ("https://news.example/EN/x", None, "url_lang"), ("https://news.example/x/", "u redu", None),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "url string, title string")
    got = [r.blacklist_reason for r in U.with_blacklist_reason(df, bl, title="title").collect()]
    assert got == [r[2] for r in rows]
    urls_only = [r.blacklist_reason for r in U.with_blacklist_reason(df, bl).collect()]
    assert urls_only == ["url", None, None, None, "url_term", "url_lang", None]


def test_final_link_filter(spark):
    keep = "https://news.example/dobar/"
    rows = [keep, "https://news.example/author/a/", "https://news.example/tag/t/", "https://other.example/x/",
            "https://news.example/in-english-x/", "https://news.example/Hudson-River/", "https://news.example/italiano/x"]
    got = links.filter_links(spark.createDataFrame([(u,) for u in rows], "url string"), site=SITE)
    assert [r.url for r in got.collect()] == [keep]


def test_listing_links(page):
    html = """
    <div class="TD-Module-1"><h2><span><a href="https://news.example/2024/ok/">Dobar naslov</a></span><a href="https://news.example/2024/second/">x</a></h2>
      <h3><a href="https://news.example/category/x/">k</a></h3><h4><a href="https://other.example/2024/y/">y</a></h4>
      <h2><a href="https://news.example/2024/the/">The x</a></h2><a href="https://news.example/2023/deep.html">d</a></div>
    <h2><a href="https://news.example/2024/outside/">o</a></h2>
    <div id="td-main-content-2"><a href="https://news.example/2022/m/">m</a><a href="https://news.example/2019/old/">o</a></div>"""
    d = page(html)
    urls = lambda df: sorted(r.url.removeprefix("https://news.example/") for r in df.collect())
    assert urls(links.heading_links(d, site=SITE)) == ["2024/ok/"]
    assert urls(links.content_links(d, site=SITE)) == ["2023/deep.html", "2024/ok/", "2024/second/"]
    assert urls(links.content_links(d, area="main", site=SITE)) == ["2022/m/"]


def test_pager_is_the_first_matching_class(page, spark):
    html = '<div class="page-numbers"><a href="/p/9/">9</a></div><div class="nav-links"><a href="/p/2/">2</a><a href="/p/3/">3</a></div><div class="nav-links"><a href="/p/4/">4</a></div>'
    seen = spark.createDataFrame([("https://news.example/p/3/",)], "url string")
    assert [r.url for r in links.pagination_links(page(html), seen).collect()] == ["https://news.example/p/2/"]


def test_seeds(spark):
    from datetime import date

    listing = links.listing_table(spark, site=SITE)
    names = spark.createDataFrame([("Sport",), ("Nema",)], "category string")
    assert [r.url for r in links.category_seeds(names, listing).collect()] == ["https://news.example/category/sport/"]
    assert [r.category for r in links.unknown_categories(names, listing).collect()] == ["Nema"]
    pages = links.page_seeds(spark.createDataFrame([("https://h/c",)], "url string"), max_pages=3)
    assert [r.url for r in pages.orderBy("page").collect()] == ["https://h/c/", "https://h/c/page/2/", "https://h/c/page/3/"]
    base = spark.createDataFrame([("https://h",)], "base string")
    months = links.archive_seeds(base, start_year=2023, end_year=2030, today=date(2024, 2, 3))
    assert months.count() == 14 and months.where("url = 'https://h/2024/02/'").count() == 1
    assert links.archive_seeds(base, start_year=2025, end_year=2030, today=date(2024, 2, 3)).count() == 0
    assert links.search_seeds(base, terms=["a"]).count() == 3


def test_sets(spark):
    df = lambda *u: spark.createDataFrame([(1, x) for x in u], "batch_no int, url string")
    assert [r.url for r in links.remaining(df("a", "b"), df("b")).collect()] == ["a"]
    assert links.advance_progress(df("a"), df("a", "b")).count() == 2
    assert [r.url for r in links.next_frontier(df("a", "a", "b", "c"), df("b"), df("c")).collect()] == ["a"]
    assert links.union_links(df("a"), df("a", "b")).count() == 2
