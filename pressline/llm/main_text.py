"""Main text of web pages by a recurrent labeller of their blocks.

A page is cut into leaf blocks, the stretches of text between block-level tags.  Each block becomes a
vector of hashed tag-path parts, hashed words and a few numbers; a bidirectional LSTM in numpy reads the
blocks of a page in order, both ways, and labels each as main text or not.

* The model is fitted on a bounded sample of pages (``MAX_PAGES`` different ones of at most ``MAX_SAMPLE_CHARS``
  characters, by lowest hash).  No page is labelled by hand: names of containers give the labels, and each
  sampled page is also shown in other layouts (other containers, more boilerplate, names left out), so that
  the labeller has to read the surroundings.
* All pages are labelled whole.  Null and empty pages, and pages without text, give an empty text.
* Scripts, styles, comments and the head are no blocks.  ``br`` counts as white space, and inline tags
  as nothing.  White space is what ``str.split`` takes for it.
* Ids and URLs are handed through, null or repeated ones too; each row is a page of its own.  Columns other than
  the three named ones are not read.  An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressline.llm.common import released

MAX_PAGES = 160
MAX_SAMPLE_CHARS = 65_536
#: layouts in which each sampled page is shown, besides its own
LAYOUTS = 5
EPOCHS = 8
RATE = 0.01
PAGES_AT_ONCE = 32
#: hashed places of path parts and of words, width of their vectors, and of the state of each direction
PLACES = 2048
WIDTH = 16
STATE = 16
#: elements of a path that are read: the outermost and the innermost ones
OUTER, INNER = 4, 8
CACHED_WORDS = 100_000

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main map menu nav noscript object ol optgroup option p pre section select"
    " summary svg table tbody td template textarea tfoot th thead title tr ul video audio canvas".split())
EMPTY_TAGS = frozenset("hr br img input meta link area base col embed source track wbr param".split())
#: their content is never text of the page
SILENT_TAGS = frozenset("script style head title noscript template svg iframe object canvas audio video select textarea datalist math".split())
#: a new one of these ends an open one of the second list, up to a container of the third
ENDS = {
    "li": (("li", "p"), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd", "p"), ("dl",)), "dd": (("dt", "dd", "p"), ("dl",)),
    "tr": (("tr", "td", "th", "p"), ("table",)), "td": (("td", "th", "p"), ("tr", "table")), "th": (("td", "th", "p"), ("tr", "table")),
}
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass(frozen=True)
class Block:
    path: tuple[tuple[str, ...], ...]  # of each open block-level element, from the outside: its tag, then its names
    text: str
    linked: float  # share of the characters that stand in links


def element(tag: str, attrs: list[tuple[str, str | None]]) -> tuple[str, ...]:
    words = []
    for key, value in attrs:
        if key in ("class", "id", "role", "itemprop", "aria-label") and value:
            words += [w.lower() for w in NAME.findall(value[:200])]
    return (tag, *dict.fromkeys(words))


class Blocks(HTMLParser):
    """Collects the leaf blocks of one page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, ...]] = []
        self.count: Counter = Counter()  # of the open elements, by tag
        self.parts: list[str] = []
        self.linked = self.links = self.silent = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            path = self.open if len(self.open) <= OUTER + INNER else self.open[:OUTER] + self.open[-INNER:]
            self.blocks.append(Block(tuple(path), text, min(1.0, self.linked / len(text))))
        self.parts, self.linked = [], 0

    def close_back_to(self, k: int) -> None:
        for tag, *_ in self.open[k:]:
            self.silent -= tag in SILENT_TAGS
            self.count[tag] -= 1
        del self.open[k:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.parts.append(" ")
        elif tag == "a":
            self.links = 1
        if tag not in BLOCK_TAGS and tag not in SILENT_TAGS:
            return
        self.flush()
        if tag == "body":  # whatever the head left open ends here
            self.close_back_to(0)
        ended, within = ENDS.get(tag, (("p",), None))
        if any(self.count[t] for t in ended):
            at = len(self.open)
            for k in range(len(self.open) - 1, -1, -1) if within else range(len(self.open) - 1, len(self.open) - 2, -1):
                if self.open[k][0] in (within or ()):
                    break
                if self.open[k][0] in ended:
                    at = k
                    if self.open[k][0] != "p":
                        break
            self.close_back_to(at)
        if tag not in EMPTY_TAGS:
            self.open.append(element(tag, attrs))
            self.count[tag] += 1
            self.silent += tag in SILENT_TAGS

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.links = 0
        elif tag == "br":
            self.parts.append(" ")
        if tag not in BLOCK_TAGS and tag not in SILENT_TAGS:
            return
        self.flush()
        for k in range(len(self.open) - 1, -1, -1) if self.count[tag] else ():
            if self.open[k][0] == tag:
                self.close_back_to(k)
                break

    def handle_data(self, data: str) -> None:
        if self.silent <= 0:
            self.parts.append(data)
            self.linked += self.links * len(data.strip())


def blocks_of(html: str | None) -> list[Block]:
    if not html:
        return []
    reader = Blocks()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.blocks


# ---- what the labeller reads -----------------------------------------------------------------------------

WORDS = re.compile(r"\w+|[^\w\s]")
NUMBERS = 10


def place(kind: str, word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace"), zlib.crc32(kind.encode())) % PLACES


class Reader:
    """Blocks to hashed places and numbers; the places of words are kept in a bounded table."""

    def __init__(self) -> None:
        self.words: dict[str, int] = {}
        self.paths: dict[tuple, list[int]] = {}

    def word(self, word: str) -> int:
        if (k := self.words.get(word)) is None:
            if len(self.words) >= CACHED_WORDS:
                self.words.clear()
            k = self.words[word] = place("word", word.lower())
        return k

    def path(self, path: tuple[tuple[str, ...], ...]) -> list[int]:
        if (places := self.paths.get(path)) is None:
            if len(self.paths) >= CACHED_WORDS // 10:
                self.paths.clear()
            places = {place("tag", tag) for tag, *_ in path} | {place("name", n) for _, *names in path for n in names}
            places |= {place("leaf", ">".join(tag for tag, *_ in path[-k:])) for k in (1, 2)}
            places = self.paths[path] = sorted(places)
        return places

    def page(self, blocks: list[Block]) -> Page:
        places, weights, sizes, numbers = [], [], [], np.zeros((len(blocks), NUMBERS), np.float32)
        for k, b in enumerate(blocks):
            words = Counter(map(self.word, WORDS.findall(b.text)))
            total, path = sum(words.values()) or 1, self.path(b.path)
            places += path
            weights += [1.0] * len(path)
            places += words
            weights += [n / total for n in words.values()]
            sizes.append(len(path) + len(words))
            tag, length = b.path[-1][0] if b.path else "", len(b.text)
            numbers[k] = (
                np.log1p(total) / 4, b.linked, b.text[-1] in ".!?…:;”\"'", sum(map(b.text.count, ".,;")) * 4 / total, tag in ("h1", "h2", "h3"),
                len(b.path) / 8, 1 / (1 + k), 1 / (len(blocks) - k), length / total / 8, b.text[0].isupper())
        return Page(np.array(places, np.int64), np.array(weights, np.float32), np.array(sizes, np.int64), numbers)


@dataclass
class Page:
    places: np.ndarray
    weights: np.ndarray
    sizes: np.ndarray
    numbers: np.ndarray


# ---- the labeller ----------------------------------------------------------------------------------------

def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Two LSTMs over the vectors of a page's blocks, one from each end, and a logistic unit over both states."""

    def __init__(self, seed: int = 1, kind: type = np.float32) -> None:
        rng = np.random.default_rng(seed)
        new = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0] if len(shape) > 1 else 1)).astype(kind)
        self.p = {"places": new(PLACES, WIDTH) * 4, "numbers": new(NUMBERS, WIDTH), "out": new(2 * STATE, 1), "bias": np.zeros(1, kind)}
        for way in "fb":
            forget = np.zeros(4 * STATE, kind)
            forget[STATE : 2 * STATE] = 1
            self.p |= {f"x{way}": new(WIDTH, 4 * STATE), f"h{way}": new(STATE, 4 * STATE), f"c{way}": forget}

    def vectors(self, pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
        """(blocks, pages, width), short pages filled up, and where blocks are."""
        longest = max(len(p.sizes) for p in pages)
        x = np.zeros((longest, len(pages), WIDTH), self.p["places"].dtype)
        there = np.zeros((longest, len(pages), 1), self.p["places"].dtype)
        for k, p in enumerate(pages):
            n = len(p.sizes)
            if n:
                parts = self.p["places"][p.places] * p.weights[:, None]
                x[:n, k] = np.add.reduceat(parts, np.cumsum(p.sizes) - p.sizes) + p.numbers @ self.p["numbers"]
                there[:n, k] = 1
        return x, there

    def states(self, x: np.ndarray, there: np.ndarray, way: str) -> tuple[np.ndarray, list]:
        """States of one direction; a place without block leaves the state as it is."""
        steps = range(len(x)) if way == "f" else range(len(x) - 1, -1, -1)
        h, c = np.zeros((2, x.shape[1], STATE), x.dtype)
        out, kept = np.zeros((len(x), x.shape[1], STATE), x.dtype), []
        drive = x @ self.p[f"x{way}"] + self.p[f"c{way}"]
        for t in steps:
            z = drive[t] + h @ self.p[f"h{way}"]
            i, f, o = np.split(sigmoid(z[:, : 3 * STATE]), 3, axis=1)
            g = np.tanh(z[:, 3 * STATE :])
            c_new = f * c + i * g
            tc = np.tanh(c_new)
            kept.append((t, i, f, o, g, c, tc, h))
            c = c + there[t] * (c_new - c)
            h = h + there[t] * (o * tc - h)
            out[t] = h
        return out, kept

    def scores(self, pages: list[Page]) -> list[np.ndarray]:
        """The probability of main text for each block of each page."""
        x, there = self.vectors(pages)
        both = np.concatenate([self.states(x, there, way)[0] for way in "fb"], axis=2)
        y = sigmoid(both @ self.p["out"] + self.p["bias"])[:, :, 0]
        return [y[: len(p.sizes), k] for k, p in enumerate(pages)]

    def back(self, grad: np.ndarray, kept: list, x: np.ndarray, there: np.ndarray, way: str, out: dict) -> np.ndarray:
        """Gradient of one direction's weights, into ``out``, and of its input."""
        drive = np.zeros((*x.shape[:2], 4 * STATE), x.dtype)
        out[f"h{way}"] = np.zeros_like(self.p[f"h{way}"])
        dh, dc = np.zeros((2, x.shape[1], STATE), x.dtype)
        for t, i, f, o, g, c, tc, h in reversed(kept):
            m = there[t]
            dh = dh + grad[t]
            do, dcn = m * dh * tc, m * (dc + dh * o * (1 - tc * tc))
            z = np.concatenate([dcn * g * i * (1 - i), dcn * c * f * (1 - f), do * o * (1 - o), dcn * i * (1 - g * g)], axis=1)
            out[f"h{way}"] += h.T @ z
            drive[t] = z
            dh, dc = (1 - m) * dh + z @ self.p[f"h{way}"].T, (1 - m) * dc + dcn * f
        flat = drive.reshape(-1, 4 * STATE)
        out[f"x{way}"], out[f"c{way}"] = x.reshape(-1, WIDTH).T @ flat, flat.sum(0)
        return drive @ self.p[f"x{way}"].T

    def gradient(self, pages: list[Page], labels: list[np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over the blocks, and its gradient."""
        x, there = self.vectors(pages)
        (f, kept_f), (b, kept_b) = (self.states(x, there, way) for way in "fb")
        both = np.concatenate([f, b], axis=2)
        y = sigmoid(both @ self.p["out"] + self.p["bias"])
        want = np.zeros_like(y)
        for k, label in enumerate(labels):
            want[: len(label), k, 0] = label
        total = there.sum()
        loss = -float((there * (want * np.log(y + 1e-7) + (1 - want) * np.log(1 - y + 1e-7))).sum() / total)
        d = there * (y - want) / total
        out = {"out": both.reshape(-1, 2 * STATE).T @ d.reshape(-1, 1), "bias": d.sum((0, 1))}
        d = d @ self.p["out"].T
        dx = self.back(d[:, :, :STATE], kept_f, x, there, "f", out) + self.back(d[:, :, STATE:], kept_b, x, there, "b", out)
        out["places"], out["numbers"] = np.zeros_like(self.p["places"]), np.zeros_like(self.p["numbers"])
        for k, p in enumerate(pages):
            own = dx[: len(p.sizes), k]
            np.add.at(out["places"], p.places, np.repeat(own, p.sizes, axis=0) * p.weights[:, None])
            out["numbers"] += p.numbers.T @ own
        return loss, out

    def fit(self, pages: list[Page], labels: list[np.ndarray], epochs: int = EPOCHS) -> Labeller:
        """Adam over batches of pages of similar length."""
        rng = np.random.default_rng(2)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        order = sorted((k for k in range(len(pages)) if len(labels[k])), key=lambda k: len(labels[k]))
        batches = [order[k : k + PAGES_AT_ONCE] for k in range(0, len(order), PAGES_AT_ONCE)]
        for epoch in range(epochs):
            rate = RATE * (1 - epoch / epochs)
            for n in rng.permutation(len(batches)):
                step += 1
                _, grad = self.gradient([pages[k] for k in batches[n]], [labels[k] for k in batches[n]])
                for k, g in grad.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.p[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(g.dtype)
        return self


# ---- labels and layouts ----------------------------------------------------------------------------------

#: names of containers (tags, or words of a class, id or role), by what they hold
CONTENT = "article main content post entry story text body page single blog news detail prose richtext articlebody".split()
SURROUNDINGS = {
    "header": "header masthead banner topbar branding logo site hero".split(),
    "menu": "nav navigation menu navbar breadcrumb breadcrumbs tabs pagination pager toc skip".split(),
    "footer": "footer bottom copyright colophon legal contentinfo imprint".split(),
    "sidebar": "aside sidebar widget complementary related recommended popular trending teaser archive tags rail".split(),
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay paywall privacy message dialog".split(),
    "advert": "ad ads advert advertisement advertising sponsor sponsored promo promotion adsense dfp outbrain taboola".split(),
    "form": "form search login signup subscribe newsletter register contact button fieldset label input".split(),
    "share": "share sharing social follow meta byline author toolbar".split(),
    "comments": "comment comments commentlist respond reply replies disqus discussion thread feedback reader".split(),
}
OWN_TAGS = {"header": ["header"], "menu": ["nav"], "footer": ["footer"], "sidebar": ["aside"], "form": ["form"], "notice": ["dialog"], "advert": ["aside"]}
OUTSIDE = frozenset(n for names in SURROUNDINGS.values() for n in names) - frozenset("site skip hero meta text label message body page tags legal".split())
HOLDERS = frozenset(("article", "main", "articlebody"))


def by_names(blocks: list[Block]) -> np.ndarray:
    """1 for the blocks inside a page's content container, outside named surroundings; without container, for all outside these."""
    inside, outside = [], []
    for b in blocks:
        held = max((k for k, e in enumerate(b.path) if HOLDERS & {*e}), default=-1)
        inside.append(held >= 0)
        # a container's own names do not count against it, nor does a header inside it
        outside.append(any(OUTSIDE - {"header"} & {*e} if k > held >= 0 else OUTSIDE & {*e} for k, e in enumerate(b.path) if k != held))
    main = any(i and not o for i, o in zip(inside, outside))
    return np.array([(i or not main) and not o for i, o in zip(inside, outside)], np.float32)


class Layouts:
    """Shows the text of sampled pages in other containers and among more surroundings."""

    def __init__(self, pages: list[tuple[list[Block], np.ndarray]], seed: int = 3) -> None:
        self.rng = np.random.default_rng(seed)
        self.main = [b.text for blocks, label in pages for b, y in zip(blocks, label) if y]
        self.rest = [b.text for blocks, label in pages for b, y in zip(blocks, label) if not y] or ["Home"]

    def one(self, of: list):
        return of[int(self.rng.integers(len(of)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def wrapper(self, names: list[str], tags: list[str], bare: float) -> tuple[str, ...]:
        """A container with one or two of the names, as its tag or as its class; rarely one that says nothing."""
        if self.chance(bare):
            return ("div", *(["x" + str(self.rng.integers(100))] if self.chance(0.5) else []))
        if tags and self.chance(0.4):
            return (self.one(tags),)
        extra = [self.one(["inner", "wrap", "container", "block", "area", "box", "list", "col", "row"])] if self.chance(0.4) else []
        return (self.one(["div", "div", "section", "ul", "td"]), self.one(names), *extra)

    def words(self, n: int) -> str:
        text = self.one(self.main if self.main and self.chance(0.7) else self.rest).split()
        start = int(self.rng.integers(max(1, len(text) - n)))
        return " ".join(text[start : start + n]) or "Home"

    def surroundings(self, role: str, top: tuple) -> list[Block]:
        bare = 0.0 if role in ("comments", "notice", "advert", "form") else 0.15
        path = (*top, self.wrapper(SURROUNDINGS[role], OWN_TAGS.get(role, []), bare))
        out = []
        if role in ("comments", "sidebar", "share", "form") and self.chance(0.5):
            out.append(Block((*path, (self.one(["h2", "h3", "h4"]),)), self.words(int(self.rng.integers(1, 5))), 0.0))
        for _ in range(int(self.rng.integers(1, 8 if role in ("menu", "comments", "sidebar", "form") else 3))):
            if role == "menu":
                out.append(Block((*path, *((("ul",), ("li",)) if self.chance(0.8) else ())), self.words(int(self.rng.integers(1, 4))), 1.0))
            elif role == "comments":
                inner = (("li", "comment"), ("p",)) if self.chance(0.5) else (("div", self.one(SURROUNDINGS[role])), ("p",)) if self.chance(0.6) else (("p",),)
                out.append(Block((*path, *inner), self.one(self.main) if self.main and self.chance(0.6) else self.words(int(self.rng.integers(3, 30))), 0.0))
            elif role in ("sidebar", "header"):
                inner = [(), (("h3",),), (("p",),), (("ul",), ("li",))]
                out.append(Block((*path, *self.one(inner)), self.words(int(self.rng.integers(1, 12))), float(self.chance(0.6))))
            elif role == "form":
                out.append(Block((*path, (self.one(["label", "div", "p", "button"]),)), self.words(int(self.rng.integers(1, 10))), 0.0))
            elif role == "share":
                out.append(Block((*path, *(((self.one(["li", "p"]),),) if self.chance(0.5) else ())), self.words(int(self.rng.integers(1, 5))), float(self.chance(0.7))))
            else:
                text = self.one(self.rest) if self.chance(0.6) else self.words(int(self.rng.integers(3, 25)))
                out.append(Block((*path, *((("p",),) if self.chance(0.5) else ())), ("© " if role == "footer" and self.chance(0.5) else "") + text, float(self.chance(0.2))))
        return out

    def shown(self, blocks: list[Block], label: np.ndarray) -> tuple[list[Block], np.ndarray]:
        top: tuple = (("html",), ("body",))
        if self.chance(0.5):
            top = (*top, ("div", *([self.one(["wrapper", "page", "container", "site", "app", "layout"])] if self.chance(0.7) else [])))
        out: list[tuple[Block, int]] = []

        def around(role: str, p: float, at: tuple = top) -> None:
            if self.chance(p):
                out.extend((b, 0) for b in self.surroundings(role, at))

        for role, p in (("notice", 0.3), ("header", 0.6), ("menu", 0.7), ("form", 0.2), ("advert", 0.4), ("sidebar", 0.2)):
            around(role, p)
        holder = top
        for _ in range(int(self.rng.integers(1, 3))):
            holder = (*holder, self.wrapper(CONTENT, ["article", "main", "section"], 0.25))
        for k, b in enumerate([b for b, y in zip(blocks, label) if y]):
            leaf = b.path[-1] if b.path and b.path[-1][0] in ("h1", "h2", "h3", "p", "li", "blockquote", "pre") else ("p",)
            if leaf[0] == "p" and self.chance(0.1):
                leaf = (self.one(["div", "blockquote", "li", "h2", "td", "pre", "figcaption"]),)
            out.append((Block((*holder, (leaf[0],)), b.text, b.linked if self.chance(0.9) else 0.5), 1))
            if k == 0:
                around("share", 0.3, holder)
            elif self.chance(0.05):
                around(self.one(["advert", "sidebar", "form", "notice"]), 1.0, holder)
        for role, p in (("share", 0.3), ("sidebar", 0.3), ("comments", 0.15)):
            around(role, p, holder)
        for role, p in (("comments", 0.35), ("form", 0.3), ("sidebar", 0.5), ("advert", 0.3), ("notice", 0.2), ("menu", 0.2), ("footer", 0.8)):
            around(role, p)
        return [b for b, _ in out], np.array([y for _, y in out], np.float32)


def fitted(htmls: list[str]) -> Labeller:
    """A labeller fitted on these pages and on other layouts of them."""
    pages = [(blocks, by_names(blocks)) for blocks in map(blocks_of, htmls) if blocks]
    layouts = Layouts(pages)
    shown = pages + [layouts.shown(*p) for p in pages for _ in range(LAYOUTS)]
    reader = Reader()
    return Labeller().fit([reader.page(blocks) for blocks, _ in shown], [label for _, label in shown])


# ---- tables ----------------------------------------------------------------------------------------------

def train(pages: DataFrame, *, html_col: str = "html") -> Labeller:
    """Fits the labeller on a bounded sample; copies of a page count once."""
    rows = pages.select(F.col(f"`{html_col}`").alias("html")).where(F.length("html").between(1, MAX_SAMPLE_CHARS)).withColumn("h", F.xxhash64("html"))
    chosen = [r["h"] for r in rows.select("h").distinct().orderBy("h").limit(MAX_PAGES).collect()]
    sample = rows.where(F.col("h").isin(chosen)).groupBy("h").agg(F.min("html").alias("html")) if chosen else rows.limit(0)
    return fitted([r["html"] for r in sorted(sample.collect(), key=lambda r: r["h"])])


#: blocks in one pass of the labeller, filled-up places included
PASS_BLOCKS = 1 << 14


def passes(pages: list[Page]) -> Iterator[list[int]]:
    """Pages of similar length that are read together."""
    order, held = sorted(range(len(pages)), key=lambda k: len(pages[k].sizes)), []
    for k in order:
        if held and (len(held) + 1) * len(pages[k].sizes) > PASS_BLOCKS:
            yield held
            held = []
        held.append(k)
    if held:
        yield held


def main_texts(labeller: Labeller, htmls: list[str | None], reader: Reader) -> list[str]:
    blocks = [blocks_of(h) for h in htmls]
    pages = [reader.page(b) for b in blocks]
    out = [""] * len(htmls)
    for held in passes(pages):
        if not len(pages[held[-1]].sizes):
            continue
        for k, y in zip(held, labeller.scores([pages[i] for i in held])):
            out[k] = "\n".join(b.text for b, p in zip(blocks[k], y) if p >= 0.5)
    return out


def groups(htmls: list[str | None], chars: int = 1 << 22) -> Iterator[slice]:
    """Stretches of a batch of few characters, or of one long page."""
    start = total = 0
    for k, h in enumerate(htmls):
        if total and total + len(h or "") > chars:
            yield slice(start, k)
            start, total = k, 0
        total += len(h or "")
    yield slice(start, len(htmls))


def extract(pages: DataFrame, labeller: Labeller, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of all pages."""
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            htmls = batch.column(2).to_pylist()
            for part in groups(htmls):
                texts = main_texts(labeller, htmls[part], reader)
                rest = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays(
                    [rest.column(0), rest.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(released(run), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
