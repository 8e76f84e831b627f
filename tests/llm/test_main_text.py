import html as entities
import random
import re

import numpy as np
import pytest

from pressline.llm import main_text
from pressline.llm.main_text import Labeller, Reader, blocks_of, by_names, extract, fitted, main_texts, sigmoid, train

FIRST = "The council voted on Tuesday to approve the new budget, which includes funding for roads and schools."
SECOND = "Residents had argued for months that the plan was too costly, but supporters disagreed."
SCHEMA = "page_id long, url string, html string, text string, n_chars int"


def made(rng, k):
    """A page of one plain layout, and its article."""
    words = [f"w{rng.randrange(300)}" for _ in range(400)]
    line = lambda n: " ".join(rng.choices(words, k=n)).capitalize() + "."
    paragraphs = [line(rng.randrange(3, 60)) for _ in range(rng.randrange(1, 9))]
    title = line(6)
    body = "".join(f"<p>{p}" + rng.choice(["", "</p>", "<br></p>", "\n</p>\n"]) for p in paragraphs)
    menu = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in rng.choices(words, k=5))
    page = (
        f"<!DOCTYPE html><html><head><title>{title}</title><script>var x = '<p>no</p>';</script></head><body><nav><ul>{menu}</ul></nav><!-- no -->"
        f'<div class="ad">{line(8)}</div><article><h1>{title}</h1>{body}</article><footer>&copy; site{k} &middot; {line(7)}</footer></body>')
    return page, "\n".join([title, *paragraphs])


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(1)
    return [made(rng, k) for k in range(200)]


@pytest.fixture(scope="module")
def labeller(pages):
    return fitted([html for html, _ in pages[:100]])


def text_of(labeller, html):
    return main_texts(labeller, [html], Reader())[0]


def test_pages_not_learned_from(labeller, pages):
    got = main_texts(labeller, [html for html, _ in pages[100:]], Reader())
    assert got == [text for _, text in pages[100:]]


@pytest.mark.parametrize("page", [
    '<body><header class="site-header"><h1><a href="/">Daily News</a></h1></header><div class="menu"><a href="/">Home</a></div><main><article class="post">'
    "{}</article><div id=comments class=comments-area><h2>2 thoughts</h2><ol><li class=comment><p>I think this is a great decision.</p></li></ol></div></main>"
    "<aside class=widget><h3>Recent</h3><ul><li><a href=/x>Storm hits coast</a></li></ul></aside><footer>Powered by us</footer>",
    '<div class="navbar"><a href="/">Home</a></div><div class="content">{}</div><div class="sidebar"><h3>Related</h3><a href="/z">Another</a></div>'
    '<div class="cookie-notice">We use cookies. <button>Accept</button></div><form class=newsletter><label>Your email</label><input></form><div class=footer>2024</div>',
    '<body><div><a href="/">Home</a> <a href="/about">About</a> <a href="/c">Contact</a></div><div>{}</div><div>&copy; 2024 All rights reserved</div>',
    '<table><tr><td class="nav"><a href="/">Home</a><br><a href="/b">News</a><td class="main">{}</table><div id="bottom">Terms of use</div>',
])
def test_other_layouts(labeller, page):
    article = f"<h1>Budget approved</h1><p>{FIRST}</p><p>{SECOND}<p>{FIRST}</p>"
    assert text_of(labeller, page.format(article)) == "\n".join(["Budget approved", FIRST, SECOND, FIRST])


def test_blocks():
    html = "<body>a<b>b</b> &amp;&lt;\n c<br>d<p>e<p>f</p>g<ul><li>h<li>i<ul><li>j</ul></ul><script>k</script><style>l</style><!-- m --><hr>n&nbsp;o</div>"
    assert [b.text for b in blocks_of(html)] == ["ab &< c d", "e", "f", "g", "h", "i", "j", "n o"]
    got = {b.text: [e[0] for e in b.path] for b in blocks_of(html)}
    assert got["f"] == ["body", "p"] and got["j"] == ["body", "ul", "li", "ul", "li"] and got["i"] == ["body", "ul", "li"]


@pytest.mark.parametrize("html", [
    None, "", "  ", "<", "<p", "<!--", "<!-- a", "</p></p>", "<script>x", "<title>", "&", "&#0;&#xD800;&#99999999;", "<p class>x", "<p class='a>x", "\0", "<![CDATA[x]]>", "<?php", "<" * 3000,
    "<div>" * 3000 + "x", "</div>" * 3000, "<li>" * 3000, "<p>x " * 3000])
def test_broken_pages(labeller, html):
    assert isinstance(text_of(labeller, html), str)


def test_names_of_containers():
    html = '<nav>a</nav><article><header><h1>b</h1></header><p>c</p><div class="ad">d</div><ul class="comment-list"><li>e</li></ul></article><p>f</p><footer>g</footer>'
    assert dict(zip([b.text for b in blocks_of(html)], by_names(blocks_of(html)))) == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 0, "f": 0, "g": 0}
    assert by_names(blocks_of("<nav>a</nav><div>b</div><footer>c</footer>")).tolist() == [0, 1, 0]


def plain_states(p, x, way):
    """One page, one direction, gate by gate."""
    n, h, c, out = main_text.STATE, np.zeros(main_text.STATE), np.zeros(main_text.STATE), [None] * len(x)
    for t in range(len(x)) if way == "f" else reversed(range(len(x))):
        z = x[t] @ p[f"x{way}"] + h @ p[f"h{way}"] + p[f"c{way}"]
        i, f, o, g = sigmoid(z[:n]), sigmoid(z[n : 2 * n]), sigmoid(z[2 * n : 3 * n]), np.tanh(z[3 * n :])
        c = f * c + i * g
        h = out[t] = o * np.tanh(c)
    return out


def test_scores_equal_a_plain_loop(pages):
    model, reader = Labeller(seed=5, kind=np.float64), Reader()
    read = [reader.page(blocks_of(html)) for html in [pages[0][0], "<p>one", pages[1][0], ""]]
    for page, got in zip(read, model.scores(read)):
        starts = np.cumsum(page.sizes) - page.sizes
        x = [sum(model.p["places"][page.places[k]] * page.weights[k] for k in range(s, s + n)) + page.numbers[t] @ model.p["numbers"]
             for t, (s, n) in enumerate(zip(starts, page.sizes))]
        both = [np.r_[a, b] for a, b in zip(plain_states(model.p, x, "f"), plain_states(model.p, x, "b"))]
        want = [sigmoid(s @ model.p["out"] + model.p["bias"])[0] for s in both]
        assert np.allclose(got, want)


def test_gradient_equals_differences(pages):
    model, reader, rng = Labeller(seed=6, kind=np.float64), Reader(), np.random.default_rng(0)
    blocks = [blocks_of(pages[k][0])[:n] for k, n in ((0, 7), (1, 3), (2, 1))]
    read, labels = [reader.page(b) for b in blocks], [by_names(b) for b in blocks]
    _, grad = model.gradient(read, labels)
    for name, weights in model.p.items():
        flat, g = weights.reshape(-1), grad[name].reshape(-1)
        for k in {int(np.abs(g).argmax()), *rng.integers(len(flat), size=3).tolist()}:
            old, losses = flat[k], []
            for step in (1e-5, -1e-5):
                flat[k] = old + step
                losses.append(model.gradient(read, labels)[0])
            flat[k] = old
            assert g[k] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-3, abs=1e-8), name


def test_table(spark, pages, monkeypatch):
    monkeypatch.setattr(main_text, "PASS_BLOCKS", 64)
    rows = [(k, f"u{k}", html, "x", 1) for k, (html, _) in enumerate(pages[:60])]
    rows += [(None, None, pages[0][0], None, None), (3, "u3", pages[3][0], "y", 2), (3, "other", None, "z", 3), (70, "e", "", "", 0), (71, "s", "<script>1</script>", "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = {html: text for html, text in pages}
    got = sorted(map(tuple, extract(df, train(df)).collect()), key=str)
    expected = [(i, u, want.get(html, ""), len(want.get(html, ""))) for i, u, html, _, _ in rows]
    assert got == sorted(expected, key=str)


def test_empty_tables(spark):
    for rows in ([], [(1, "u", None, "", 0), (2, "u", "", "", 0)], [(1, "u", "<!-- x -->", "", 0)]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert [r.text for r in extract(df, train(df)).collect()] == [""] * len(rows)


def test_long_page(labeller):
    paragraphs = [f"Sentence {k} of a very long article, with some words." for k in range(5000)]
    html = "<nav><a href=/>Home</a></nav><article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article><footer>End</footer>"
    assert text_of(labeller, html) == "\n".join(paragraphs)
    assert entities.unescape(re.sub("<[^>]*>", "", html)).startswith("Home")
