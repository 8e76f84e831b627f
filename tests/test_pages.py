import dataclasses
import json

from pyspark.sql import functions as F

from pressline.functions.text import let
from pressline.operators import fields as P
from pressline.operators import nodes
from pressline.params import DEFAULT_RULES, Blacklist, Site
from pressline.plans.articles import extract_rows, scrape_rows
from pressline.sources.dom import node_table

SITE = Site()
BL = Blacklist()


def values(df, column):
    return [r[0] for r in df.orderBy("page_id").select(column).collect()]


def field(dom, column):
    return values(dom.select("page_id", column.alias("v")), "v")


# --- nodes ------------------------------------------------------------------------
def test_tree_repair(page):
    html = "<div><p>a<p>b <b>c</div>d<ul><li>1<li>2<ul><li>3</ul></ul><br><img src=x>e<script>if (a<b) x('<p>')</script><!-- c -->f"
    rows = {(r.tag, r.node_id): r for r in node_table(page(html)).collect()}
    tags = [t for t, _ in sorted(rows, key=lambda k: k[1])]
    assert tags == ["div", "p", "p", "b", "ul", "li", "li", "ul", "li", "br", "img", "script"]
    by = {i: r for (_, i), r in rows.items()}
    assert (by[0].text, by[0].last_id) == ("abc", 3)
    assert (by[1].text, by[2].text, by[2].own_text) == ("a", "bc", "b")
    assert [by[i].text for i in (5, 6, 7, 8)] == ["1", "23", "3", "3"]
    assert by[8].depth == 3 and by[8].parent_id == 7 and by[6].nth == 2
    assert by[9].text == "" and by[11].text == ""


def test_unclosed_tags_can_stay_open(page):
    rows = node_table(page("<div><p>a<p>b</div>", implicit_close=False)).orderBy("node_id").collect()
    assert [(r.tag, r.text) for r in rows] == [("div", "ab"), ("p", "ab"), ("p", "b")]


def test_ancestors(page):
    rows = node_table(page("<div><p>a<b>c</b></p></div><i>x</i>"), ancestors=True).orderBy("node_id").collect()
    assert [(r.tag, r.ancestors) for r in rows] == [("div", []), ("p", [0]), ("b", [0, 1]), ("i", [])]


def test_attributes_and_entities(page):
    row = node_table(page('<a CLASS="x  y" href="/a?b&amp;c" disabled title=&quot;q&quot;>&copy; &lt;b&gt;</a>')).first()
    assert row.classes == ["x", "y"] and row.attrs == {"class": "x  y", "href": "/a?b&c", "disabled": "", "title": '"q"'}
    assert row.text == "© <b>"


def test_empty_pages(page):
    assert [r.n for r in page("", None).select(F.size("nodes").alias("n")).collect()] == [0, 0]


def test_first_element_decides_for_its_selector(page):
    html = '<h1 class="a"></h1><h1 class="a">filled</h1><h2 class="b">second</h2>'
    got = nodes.first_match(page(html), [nodes.sel("h1", "a"), nodes.sel("h2", "b")]).first()
    assert got.value == "second"


def test_within_and_nth(page):
    html = '<a>0</a><div class="x"><p><a>1</a></p><a>2</a><a>3</a></div>'
    d = page(html)
    assert field(d, nodes.first(nodes.sel("a", within=nodes.sel(cls="x")), nodes.text_of)) == ["1"]
    assert field(d, nodes.first(nodes.sel("a", nth=2, within=nodes.sel(cls="x")), nodes.text_of)) == ["3"]


def test_first_k(page):
    d = page("<p>a</p><p>b</p><p>c</p>", "<p>x</p>")
    got = {tuple(r) for r in nodes.first_k(d, ["p"], 2).collect()}
    assert got == {(0, 1, "a"), (0, 2, "b"), (1, 1, "x")}
    assert {tuple(r) for r in nodes.first_k_rows(node_table(d), ["p"], 2).collect()} == got


# --- title, date, author, category ----------------------------------------------------
def test_titles(page):
    d = page(
        '<h2 class="x td-post-title">Prvi</h2>', '<meta property="og:title" content=" Drugi | Site "><h1>n</h1>',
        '<h1 class="entry-title"></h1><meta property="og:title" content="og">', "<title>Treci - Site</title>", "<p>x</p>",
    )
    assert field(d, P.title_basic()) == ["Prvi", "Drugi", None, None, None]
    # a heading without text falls through to the next rule of the cascade
    assert field(d, P.title_cascade("url")) == ["A", "n", "og", "Treci", "A"]
    slug = page("", url="https://h/nova_vijest-2024/")
    assert field(slug, P.title_cascade("url")) == ["Nova Vijest 2024"]


def test_dates(page):
    d = page(
        '<span class="td-post-date x">30. travnja 2025.</span>', '<time class="entry-date">nedavno</time>',
        '<meta property="article:published_time" content="2024-05-17T10:00:00+02:00">', "<p></p>",
        '<meta property="article:published_time" content="bad">', '<span class="meta-date"></span><meta property="article:published_time" content="2024-05-17">',
    )
    assert values(P.with_date_basic(d), "date") == ["30.04.2025", "nedavno", "17.05.2024", None, None, ""]
    e = page(
        '<time datetime="2024-05-17T10:00:00Z">x</time>', '<span class="post-date">17/05/2024</span>',
        '<time class="published" content="2024-05-17"></time>', "<p></p>", url="https://h/2023/04/21/x/",
    )
    got = P.with_date_cascade(e)
    assert values(got, "date") == ["17.05.2024"] * 3 + ["21.04.2023"]
    assert [str(v) for v in values(got, "date_value")] == ["2024-05-17"] * 3 + ["2023-04-21"]


def test_authors(page):
    d = page(
        '<meta name="author" content=" Ana ">', '<meta name="author" content="News.Example"><span class="x-Author">Piše: Ivo</span>',
        '<span class="author">bynews desk</span><a rel="nofollow author">Eva</a>',
        '<div class="post-meta"><p>x</p><span>Autor : Mia Mić</span></div>', "<p>x</p>", '<span class="author">By</span>',
    )
    assert field(d, P.author_basic(SITE)) == ["Ana", "Ivo", "Eva", "Mia Mić", "news.example", "By"]
    e = page(
        '<meta name="author" content=" Ana ">', '<i class="post-author">by: news</i><p class="byline"><i class="author">AUTOR Iva</i></p>',
        '<a rel="author">Eva</a>', "<p>x</p>",
    )
    assert field(e, P.author_cascade(SITE)) == ["Ana", "Iva", "Eva", "news.example"]


def test_categories(page):
    d = page(
        '<div class="td-Breadcrumbs"><a>Home</a><a>Sport</a></div>', '<div class="breadcrumbs"><a>Home</a></div><meta property="article:section" content="vijesti">',
        '<span class="cat-x">' + "x" * 30 + '</span><a class="category">Vjera</a>', '<h1 class="entry-title">Nogomet</h1>',
        '<div class="breadcrumbs"><a>Home</a><a></a></div><span class="category">Xyz, nogomet i dr</span>',
    )
    found = let(d, category_on_page=P.category_on_page(), title=P.title_basic())
    assert values(found, "category_on_page") == ["Sport", "vijesti", "Vjera", None, "Xyz, nogomet i dr"]
    done = P.with_category_basic(found, DEFAULT_RULES)
    assert values(done, "category") == ["Sport", "Novice", "Religija", "Novice", "Sport"]
    # without a path segment the title decides
    no_path = page('<h1 class="entry-title">Nogomet danas</h1>', url="https://news.example")
    titled = let(no_path, category_on_page=P.category_on_page(), title=P.title_basic())
    assert values(P.with_category_basic(titled, DEFAULT_RULES), "category") == ["Sport"]
    by_url = page("<p>x</p>", url="https://news.example/kultura/x/")
    raw = let(by_url, category_on_page=P.category_on_page(), title=P.title_basic())
    assert values(P.with_category_basic(raw, DEFAULT_RULES), "category") == ["Kultura"]
    assert field(by_url, P.category_cascade(DEFAULT_RULES)) == ["Kultura"]
    crumbs = page('<div class="breadcrumbs"><a>a</a><a>b</a></div>', '<p class="post-meta"><i class="category">c</i></p>', "<p></p>")
    assert field(crumbs, P.category_cascade(DEFAULT_RULES)) == ["b", "c", "Novice"]


# --- subtitle ---------------------------------------------------------------------------
def test_subtitle_validity(one):
    for text, ok in [("x" * 9, False), ("x" * 10, True), ("x" * 250, True), ("x" * 251, False), ("dugi podnaslov...", False),
                     ("dugi podnaslov…", False), ("nesto sto je danas bilo", False), ("jučer je bilo lijepo", False),
                     ("Marko Maric je rekao", False), ("Mostar, 3. svibnja 2024. nesto", False), ("predanasnji red", True)]:
        assert one([P.valid_subtitle("t", BL).cast("string")], t=text) == str(ok).lower(), text
    assert one([P.valid_subtitle("t", Blacklist(subtitles=("crno",))).cast("string")], t="ovo je crno ovdje") == "false"


def test_best_subtitle(spark):
    s = "array<struct<text:string,score:int,source:string>>"
    rows = [
        (0, [("a" * 100, 8, ""), ("b" * 30, 10, "")]), (1, [("c" * 120, 10, ""), ("d" * 90, 10, "")]),
        (2, [("prvi", 5, ""), ("drgi", 5, "")]), (3, [("kraj…...", 5, "")]), (4, [("pita?", 5, "")]), (5, []),
    ]
    df = spark.createDataFrame(rows, f"page_id int, candidates {s}")
    assert values(P.best_subtitle(df), "subtitle") == ["b" * 30 + ".", "d" * 90 + ".", "prvi.", "kraj.", "pita?", None]


def test_subtitle_candidates(page):
    body = lambda *ps: '<div class="entry-content">' + "".join(f"<p>{p}</p>" for p in ps) + "</div>"
    long = "Ovo je prva recenica koja ima vise od cetrdeset znakova. " + "n" * 60
    d = page(
        '<p class="lead">Izravan podnaslov</p><meta property="og:description" content=" Opis stranice ">',
        body("k" * 50, "d" * 60), body("kratko", "d" * 60), body(long), body("Kratka. " + "x" * 100, "d" * 60),
        '<div class="post-content"><b>' + "s" * 45 + "</b><strong>" + "t" * 30 + "</strong><b>" + "u" * 45 + "</b></div>",
        '<p class="My-Intro">Uvodni odlomak</p>',
    )
    rows = d.select("page_id", F.inline(P.subtitle_candidates(BL))).collect()
    got = [[(r.source, r.score, len(r.text)) for r in rows if r.page_id == i] for i in range(7)]
    assert got == [
        # a direct subtitle with an intro class is found twice
        [("direct", 10, 17), ("meta", 8, len("Opis stranice")), ("intro", 7, 17)], [("first_para", 5, 50)], [("second_para", 3, 60)],
        [("first_para_sentence", 6, 55)], [], [("strong", 5, 45)], [("intro", 7, 14)],
    ]


def test_subtitle_cascade(page):
    d = page('<p class="lead">short</p><h2 class="subtitle">' + "x" * 21 + "</h2>", '<meta name="description" content="' + "y" * 299 + '">',
             '<p class="lead">' + "x" * 20 + "</p>", '<p class="lead">' + "x" * 300 + "</p>")
    assert field(d, P.subtitle_cascade()) == ["x" * 21, "y" * 299, None, None]


# --- body -------------------------------------------------------------------------------
def test_basic_body(page):
    html = """<div class="entry-content"><p>Prvi odlomak teksta</p><div><p>Ugnijezdjeni odlomak teksta</p></div>
      <p class="social-x">podijeli ovaj tekst</p><p>kratko</p><p>Ovo je OGLAS za nesto veliko</p>
      <p><script>x</script>tekst uz skriptu ovdje</p><div><blockquote class="twitter-tweet">tweet tweet tweet</blockquote></div>
      <p><img src=x>slika s potpisom</p><p><img src=x>slika s jako dugim potpisom ispod nje</p><h3>Medjunaslov teksta</h3><h2>nije dio</h2></div>
      <p>izvan spremnika je ovaj dugi tekst</p>"""
    got = values(P.body_of(page(html)), "content")
    assert got == ["Prvi odlomak teksta Ugnijezdjeni odlomak teksta Ugnijezdjeni odlomak teksta slika s jako dugim potpisom ispod nje Medjunaslov teksta"]
    # a known container without text is not replaced by the fallback
    empty = page('<div class="entry-content"><p>x</p></div><p>izvan spremnika je ovaj dugi tekst</p>')
    assert values(P.body_of(empty), "content") == [None]


def test_fallback_body(page):
    html = """<p>Prvi dovoljno dug odlomak.</p><div class="page-footer"><div><p>u podnozju dovoljno dug tekst</p></div></div>
      <ul class="Widget"><li><p>velika slova nisu ista klasa</p></li></ul><p>kratak odlomak</p>"""
    assert values(P.body_of(page(html)), "content") == ["Prvi dovoljno dug odlomak. velika slova nisu ista klasa"]


def test_cascade_body(page):
    d = page('<div class="entry-content"><p>oglas</p></div><div class="post-body"><h2>Naslov</h2><p>tekst</p><div>ne</div></div>',
             '<article><div class="content"><ul><li>a</li></ul></div></article>', '<div class="content"><p>x</p></div>',
             '<div itemprop="articleBody"><p>b</p></div>')
    assert field(d, P.body_cascade()) == ["Naslov tekst", "a", None, "b"]


def test_alternative_body(page):
    text = "rijec " * 30
    d = page(f"<article><p>{text}</p><style>p</style><p>Kraj Copyright 2024</p></article>", f'<div id="main">{text}</div>',
             "<article>kratko</article>", f"<article>{text[:90]} Pratite News {text}</article>")
    assert field(d, P.body_alternative(SITE)) == [text.strip() + " Kraj ", text.strip(), None, None]
    errors = P.with_body_and_error(d, SITE)
    assert values(errors, "error") == [None, None, "No content extracted", "No content extracted"]


# --- whole pages --------------------------------------------------------------------------
def test_metadata(page):
    d = page('<meta property="a" content="1"><meta name="a" content="2"><meta property="p" name="n"><meta charset="utf-8">'
             '<script type="application/ld+json">{"x": [1, "<b>"]}</script><script type="application/ld+json">{"y": 2}</script>',
             '<script type="application/ld+json">not json</script>')
    rows = P.with_metadata(d).orderBy("page_id").collect()
    assert rows[0].metadata == {"a": "2", "p": ""} and json.loads(rows[0].json_ld) == {"x": [1, "<b>"]}
    assert rows[1].metadata == {} and rows[1].json_ld is None


def test_foreign_by_html(page):
    d = page('<html lang="hr">', '<html lang="HR">', '<html lang="hr-HR">', "<html>", "<title>Italia dello sport</title>",
             "<title>Italia</title>", "<title>Trump</title>", '<body class="post italian-version">')
    assert values(P.foreign_by_html(d, BL), "html_reason") == [None, None, "lang", None, "title", None, "title", "class"]


def words(n, start=0):
    return " ".join(f"rijec{i}" for i in range(start, start + n))


def test_scrape_reject_chain(spark):
    def html(title="Dobar naslov clanka ovdje", body=None, lang="hr"):
        return f'<html lang="{lang}"><h1 class="entry-title">{title}</h1><div class="entry-content"><p>{body or words(30)}</p></div>'

    from pressline.fixed_values import INDICATORS_B

    inside = " ".join(f"x{t}y" for t in INDICATORS_B[:21])
    rows = [
        (0, "https://news.example/a/", html(), None), (1, "https://news.example/en/a/", html(), "url_blacklist"),
        (2, "https://news.example/a/", None, "no_page"), (3, "https://news.example/a/", html(lang="en"), "html_foreign"),
        (4, "https://news.example/a/", html("The x"), "title_blacklist"), (5, "https://news.example/a/", html("Dobra austria danas ovdje"), "title_reject"),
        (6, "https://news.example/a/", html(body="x"), "empty_body"), (7, "https://news.example/a/", html(body=inside), "indicator_terms"),
        (8, "https://news.example/a/", html(body=words(20) + " the that this"), "language"),
        (9, "https://news.example/a/", html(body=words(52) + " the r the r the r the r the r " + words(40)), "mid_sample"),
    ]
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    got = scrape_rows(df).orderBy("page_id").collect()
    assert [r.reject_reason for r in got] == [r[3] for r in rows]
    assert got[0].title == "Dobar naslov clanka ovdje" and got[0].author == "news.example" and got[0].category == "Novice"


def test_extract_keeps_every_page(spark):
    long = words(40)
    rows = [(0, "https://news.example/sport/x/", f'<article><h1>N</h1><div class="content"><p>{long}</p></div></article>'),
            (1, "https://news.example/x/", "<p>x</p>"), (2, "https://news.example/x/", "")]
    got = extract_rows(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()
    assert [r.error for r in got] == [None, "No content extracted", "Failed to retrieve page content"]
    assert got[0].content == long and got[0].category == "Sport" and got[2].title is None


def test_allowed_languages_are_a_parameter(spark):
    rules = dataclasses.replace(DEFAULT_RULES, blacklist=Blacklist(allowed_langs=("xx",)))
    df = spark.createDataFrame([(0, "https://news.example/a/", f'<html lang="xx"><p>{words(30)}</p>')], "page_id long, url string, html string")
    assert scrape_rows(df, rules=rules).first().reject_reason is None


def test_untitled_article_reaches_the_archive(spark):
    from pressline.operators.records import parse_records, render_records

    df = spark.createDataFrame([(0, "https://news.example/a/", f'<html lang="hr"><p>{words(30)}</p>')], "page_id long, url string, html string")
    kept = scrape_rows(df).where("reject_reason is null")
    back = parse_records(render_records(kept).where("raw is not null").select("raw")).first()
    assert back.title is None and back.content == words(30) and back.url == "https://news.example/a/"


def random_page(rng, size=60):
    tags = ("div", "p", "span", "a", "meta", "article", "h1", "section")
    attrs = lambda: rng.sample([
        f'class="{" ".join(rng.sample(["lead", "Post-Title", "meta", "author", "x"], rng.randrange(4)))}"', f'id="{rng.choice(["main", "main-content", "", "b"])}"',
        f'property="{rng.choice(["og:title", "og:description"])}"', 'content="c"', f'rel="{rng.choice(["author", "author nofollow", "tag"])}"'], rng.randrange(4))
    out, open_tags = [], []
    for k in range(size):
        if open_tags and rng.random() < 0.35:
            out.append(f"</{open_tags.pop()}>")
        tag = rng.choice(tags)
        out.append(f"<{' '.join([tag, *attrs()])}>t{k}")
        if tag != "meta":
            open_tags.append(tag)
    return "".join(out)


def plain_match(s, nodes, n):
    a, classes = n["attrs"], n["classes"]
    return (
        (not s.tags or n["tag"] in s.tags) and (s.nth is None or n["nth"] == s.nth) and (s.cls is None or s.cls in classes)
        and (not s.cls_like or any(t in (c.lower() if s.fold else c) for c in classes for t in s.cls_like))
        and (s.id is None or a.get("id") == s.id) and (s.id_like is None or s.id_like in a.get("id", ""))
        and (s.attr is None or s.attr in a) and (s.value is None or a[s.attr] == s.value) and (s.token is None or s.token in a[s.attr].split(" "))
        and (s.within is None or any(b["id"] < n["id"] <= b["last"] and plain_match(s.within, nodes, b) for b in nodes)))


def test_index_finds_what_a_walk_over_all_nodes_finds(page):
    import random

    from pressline.operators.nodes import Selector, find_all, probe

    rng = random.Random(5)
    selectors = [
        Selector(tags=("p",)), Selector(tags=("h1", "a", "div")), Selector(cls="lead"), Selector(tags=("span",), cls="author"),
        Selector(cls_like=("title", "meta"), fold=True), Selector(tags=("div",), cls_like=("Post",)), Selector(id="main"), Selector(id=""),
        Selector(tags=("div", "p"), id_like="main"), Selector(tags=("meta",), attr="property", value="og:title"), Selector(attr="rel", token="author"),
        Selector(attr="content"), Selector(attr="content", value="c"), Selector(tags=("a",), nth=2), Selector(nth=1), Selector(tags=("section",), within=Selector(cls="lead")),
        Selector(cls="x", within=Selector(tags=("div",), within=Selector(tags=("article", "section")))), Selector(cls="no such"), Selector(cls="two words"),
    ]
    dom = page(*[random_page(rng) for _ in range(40)], "", "text only")
    found = dom.select("nodes", *[F.transform(find_all(s), lambda n: n["id"]).alias(f"s{k}") for k, s in enumerate(selectors)]).collect()
    hits = 0
    for row in found:
        for k, s in enumerate(selectors):
            assert row[f"s{k}"] == [n["id"] for n in row.nodes if plain_match(s, row.nodes, n)], s
            hits += len(row[f"s{k}"])
    assert hits > 2000 and probe(selectors[9]) == (["@property=og:title"], "attr")


def test_only_wanted_fields_are_planned(spark):
    import time

    df = spark.createDataFrame([(1, "https://news.example/a/", "<h1>x</h1>")], "page_id long, url string, html string")
    text = lambda out: out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "extended")
    began = time.time()
    reasons = scrape_rows(df, columns=("reject_reason",))
    took = time.time() - began
    plan, whole = text(reasons), text(scrape_rows(df))
    for mark in ("candidates", "category_on_page", "author", "date_raw"):
        assert mark not in plan and mark in whole
    assert "piece_node" in plan and took < 5
    assert "meta_entries" not in text(extract_rows(df, columns=("content", "error"))) and "meta_entries" in text(extract_rows(df))
    assert scrape_rows(df, columns=("page_id", "title")).columns == ["page_id", "title"]


def test_table_function_gives_the_node_table(spark):
    import random

    from pressline.sources.dom import node_table, parse_pages, register_page_nodes

    rng = random.Random(6)
    rows = [(k, f"u{k}", random_page(rng, 30)) for k in range(30)] + [(None, None, "<p>x<p>y"), (40, "u", None), (41, "u", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    register_page_nodes(spark)
    df.createOrReplaceTempView("some_pages")
    got = spark.sql("select * from page_nodes(table(select page_id, url, html from some_pages))")
    want = node_table(parse_pages(df))
    assert got.columns == want.columns
    same = lambda t: sorted(map(repr, (r.asDict() for r in t.collect())))
    assert same(got) == same(want)
    last = spark.sql("select max(node_id) as n from page_nodes(table(select 1L, 'u', '<b>x</b>')) where tag = 'b'").first()
    assert last.n == 0


def test_a_scrape_holds_two_python_workers_a_task(spark):
    df = spark.createDataFrame([(1, "https://news.example/a/", "<h1>x</h1>")], "page_id long, url string, html string")
    plan = scrape_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("MapInArrow"), plan.count("ArrowEvalPython")) == (1, 1)


def test_the_first_reject_rule_wins_over_all_that_follow(spark):
    from pressline.params import Lexicon

    bl = Blacklist(allowed_langs=("hr",), terms=("bad title",), title_rejects=("no thanks",))
    rules = dataclasses.replace(DEFAULT_RULES, blacklist=bl, lexicon=Lexicon(max_substrings=3))
    foreign = " ".join(Lexicon().terms_b) + " " + words(120)
    made = lambda title, body, lang="hr": f'<html lang="{lang}"><h1 class="entry-title">{title}</h1><p>{body}</p></html>'
    rows = [
        (0, "https://news.example/bad-title/", made("Bad title", foreign), "url_blacklist"),
        (1, "https://news.example/a/", made("Bad title", foreign, "en"), "html_foreign"),
        (2, "https://news.example/a/", made("A bad title", foreign), "title_blacklist"),
        (3, "https://news.example/a/", made("Well, no thanks", foreign), "title_reject"),
        (4, "https://news.example/a/", made("Dobar naslov", foreign), "indicator_terms"),
        (5, None, made("Dobar naslov", words(120)), None),
        (6, None, None, "no_page"),
    ]
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    got = scrape_rows(df, rules=rules).orderBy("page_id").collect()
    assert [r.reject_reason for r in got] == [r[3] for r in rows]
