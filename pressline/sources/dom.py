"""Pages to node lists: the one stage that needs Python.

A page stays one row.  Its nodes are an array in document order, so every field
rule downstream is a column expression on that row and no rule needs a shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from pressline import schemas

# HTML syntax: elements that never have content, elements that end an open <p>
# or <li> scope, and elements whose text is not page text.
VOID = frozenset(
    "area base basefont bgsound br col embed hr img input keygen link meta "
    "param source spacer track wbr".split()
)
SCOPES = {
    "p": frozenset("article aside blockquote body div footer header li main nav section table td th ul ol".split()),
    "li": frozenset("ul ol menu body".split()),
}
# attributes whose values are part of the index, for selectors such as meta[property=..]
KEYED = ("property", "name", "itemprop", "rel")
NO_TEXT = frozenset(("script", "style", "template"))
PAGES_PER_BATCH = 128

# ship the parser with the task, so executors need no installed copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _Nodes(HTMLParser):
    """Collects the columns of one page's node list."""

    def __init__(self, implicit_close: bool):
        super().__init__(convert_charrefs=True)
        self.implicit_close = implicit_close
        self.rows: list[list] = []
        self.stack: list[int] = []
        self.siblings: list[dict[str, int]] = [{}]
        self.pieces: list[str] = []
        self.piece_node: list[int] = []
        self.text: list[str] = []
        self.json_ld: str | None = None

    def _flush(self) -> None:
        if not self.text:
            return
        data = "".join(self.text)
        self.text.clear()
        top = self.stack[-1] if self.stack else -1
        if top >= 0 and self.rows[top][5] in NO_TEXT:
            if self.json_ld is None and self.rows[top][6].get("type") == "application/ld+json":
                self.json_ld = data
            return
        data = data.strip()
        if data:
            self.pieces.append(data)
            self.piece_node.append(top)

    def _pop(self) -> None:
        row = self.rows[self.stack.pop()]
        row[2], row[8] = len(self.rows) - 1, len(self.pieces)
        self.siblings.pop()

    def _close_open(self, tag: str) -> None:
        """A new p or li ends an open one of the same scope."""
        scope = SCOPES[tag]
        for depth in range(len(self.stack) - 1, -1, -1):
            name = self.rows[self.stack[depth]][5]
            if name == tag:
                while len(self.stack) > depth:
                    self._pop()
                return
            if name in scope:
                return

    def handle_starttag(self, tag, attrs):
        self._flush()
        if self.implicit_close and tag in SCOPES:
            self._close_open(tag)
        node, seen = len(self.rows), self.siblings[-1]
        seen[tag] = seen.get(tag, 0) + 1
        n = len(self.pieces)
        self.rows.append([
            node, self.stack[-1] if self.stack else -1, node, len(self.stack),
            seen[tag], tag, {k: v or "" for k, v in attrs}, n, n,
        ])
        if tag not in VOID:
            self.stack.append(node)
            self.siblings.append({})

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._pop()

    def handle_endtag(self, tag):
        self._flush()
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.rows[self.stack[depth]][5] == tag:
                while len(self.stack) > depth:
                    self._pop()
                return

    def handle_data(self, data):
        self.text.append(data)

    def handle_comment(self, data):
        self._flush()

    def handle_decl(self, decl):
        self._flush()

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def finish(self) -> None:
        self.close()
        self._flush()
        while self.stack:
            self._pop()


def node_keys(tag: str, attrs: dict[str, str]) -> Iterator[str]:
    """What a node is found by: ``tag``, ``.class``, ``#id``, ``@attribute``, ``@attribute=value``; ``*.`` and ``*#`` for any class or id."""
    yield tag
    for name, value in attrs.items():
        yield "@" + name
        if name in KEYED:
            yield f"@{name}={value}"
    if classes := attrs.get("class", "").split():
        yield "*."
        yield from ("." + c for c in dict.fromkeys(classes))
    if "id" in attrs:
        yield "*#"
        yield "#" + attrs["id"]


def _places(rows: list[list]) -> dict[str, list[int]]:
    found: dict[str, list[int]] = {}
    for r in rows:
        for key in node_keys(r[5], r[6]):
            found.setdefault(key, []).append(r[0])
    return found


def _offsets(lengths: list[int]) -> pa.Array:
    out = [0]
    for n in lengths:
        out.append(out[-1] + n)
    return pa.array(out, pa.int32())


def _to_batch(ids: pa.Array, urls: pa.Array, parsed: list[_Nodes], schema: pa.Schema) -> pa.RecordBatch:
    """Assemble the nested columns from flat value lists and offsets."""
    rows = [r for p in parsed for r in p.rows]
    node_type = schema.field("nodes").type.value_type

    def ints(i: int) -> pa.Array:
        return pa.array([r[i] for r in rows], pa.int32())

    attrs = pa.MapArray.from_arrays(
        _offsets([len(r[6]) for r in rows]),
        pa.array([k for r in rows for k in r[6]], pa.string()),
        pa.array([v for r in rows for v in r[6].values()], pa.string()),
    )
    class_lists = [r[6]["class"].split() if "class" in r[6] else [] for r in rows]
    classes = pa.ListArray.from_arrays(
        _offsets([len(c) for c in class_lists]),
        pa.array([c for cs in class_lists for c in cs], pa.string()),
    )
    values = {
        "id": ints(0), "parent": ints(1), "last": ints(2), "depth": ints(3), "nth": ints(4),
        "tag": pa.array([r[5] for r in rows], pa.string()),
        "attrs": attrs, "classes": classes, "t0": ints(7), "t1": ints(8),
    }
    places = [_places(p.rows) for p in parsed]
    lists = [ids for found in places for ids in found.values()]
    index = pa.MapArray.from_arrays(
        _offsets([len(found) for found in places]),
        pa.array([k for found in places for k in found], pa.string()),
        pa.ListArray.from_arrays(_offsets([len(ids) for ids in lists]), pa.array([i for ids in lists for i in ids], pa.int32())),
    )
    structs = pa.StructArray.from_arrays(
        [values[f.name].cast(f.type) for f in node_type], fields=list(node_type)
    )
    columns = [
        ids.cast(schema.field("page_id").type),
        urls.cast(pa.string()),
        pa.ListArray.from_arrays(_offsets([len(p.rows) for p in parsed]), structs),
        pa.ListArray.from_arrays(
            _offsets([len(p.pieces) for p in parsed]),
            pa.array([t for p in parsed for t in p.pieces], pa.string()),
        ),
        pa.ListArray.from_arrays(
            _offsets([len(p.piece_node) for p in parsed]),
            pa.array([n for p in parsed for n in p.piece_node], pa.int32()),
        ),
        pa.array([p.json_ld for p in parsed], pa.string()),
        index,
    ]
    return pa.RecordBatch.from_arrays(
        [c if c.type == f.type else c.cast(f.type) for c, f in zip(columns, schema)], schema=schema
    )


def parse_pages(pages: DataFrame, *, implicit_close: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """``pages(page_id, url, html)`` -> one ``DOM`` row per page.

    Void tags never open.  ``implicit_close`` lets a new ``p`` or ``li`` end an
    open one, as HTML does; ``False`` keeps unclosed tags open to the end of
    their parent.  Pages without HTML give an empty node list.  ``keep`` names
    further columns of the input that go along.
    """
    rows = pages.select(F.col("page_id").cast("bigint"), "url", "html", *keep)
    out = StructType(schemas.DOM.fields + [rows.schema[c] for c in keep])
    schema = to_arrow_schema(schemas.DOM)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # small output batches keep the nested columns of long pages in bounds
            for start in range(0, whole.num_rows, PAGES_PER_BATCH):
                batch = whole.slice(start, PAGES_PER_BATCH)
                parsed = []
                for html in batch.column("html"):
                    p = _Nodes(implicit_close)
                    p.feed(html.as_py() or "")
                    p.finish()
                    parsed.append(p)
                made = _to_batch(batch.column("page_id"), batch.column("url"), parsed, schema)
                for name in keep:
                    made = made.append_column(batch.schema.field(name), batch.column(name))
                yield made

    return rows.mapInArrow(run, out)


def node_table(dom: DataFrame, *, ancestors: bool = False) -> DataFrame:
    """Relational form: one row per node, with its own and its whole text.

    ``last_id`` closes the descendant range: ``a`` is an ancestor of ``n`` iff
    ``a.node_id < n.node_id and n.node_id <= a.last_id``.  ``ancestors`` adds the
    ids of a node's ancestors as an array, outermost first.
    """
    n = F.col("n")
    start, size = n["t0"] + 1, n["t1"] - n["t0"]
    # a node's own pieces lie inside its share; joining skips the others' NULLs
    own = F.array_join(
        F.zip_with(
            F.slice("pieces", start, size), F.slice("piece_node", start, size),
            lambda text, owner: F.when(owner == n["id"], text),
        ),
        "",
    )
    above = F.transform(
        F.filter("nodes", lambda a: (a["id"] < n["id"]) & (n["id"] <= a["last"])), lambda a: a["id"]
    )
    source = ["page_id", "url", "pieces", "piece_node", *(["nodes"] if ancestors else [])]
    return dom.select(*source, F.explode("nodes").alias("n")).select(
        "page_id", "url",
        n["id"].alias("node_id"), n["parent"].alias("parent_id"), n["last"].alias("last_id"),
        n["depth"].alias("depth"), n["nth"].alias("nth"), n["tag"].alias("tag"),
        n["attrs"].alias("attrs"), n["classes"].alias("classes"),
        own.alias("own_text"),
        F.array_join(F.slice("pieces", start, size), "").alias("text"),
        *([above.alias("ancestors")] if ancestors else []),
    )


class PageNodes:
    """The node table as a table function: ``page_nodes(TABLE(SELECT page_id, url, html ..))``.

    Takes Arrow batches of pages and gives the rows of ``node_table``.
    """

    def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        schema = to_arrow_schema(schemas.NODE_ROW)
        for start in range(0, batch.num_rows, PAGES_PER_BATCH):
            part = batch.slice(start, PAGES_PER_BATCH)
            columns: list[list] = [[] for _ in schema]
            for page_id, url, html in zip(*(part.column(k).to_pylist() for k in range(3))):
                p = _Nodes(implicit_close=True)
                p.feed(html or "")
                p.finish()
                own: dict[int, list[str]] = {}
                for text, node in zip(p.pieces, p.piece_node):
                    own.setdefault(node, []).append(text)
                for node, parent, last, depth, nth, tag, attrs, t0, t1 in p.rows:
                    row = (
                        page_id, url, node, parent, last, depth, nth, tag, list(attrs.items()), attrs["class"].split() if "class" in attrs else [],
                        "".join(own.get(node, ())), "".join(p.pieces[t0:t1]))
                    for column, value in zip(columns, row):
                        column.append(value)
            yield pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def register_page_nodes(spark: SparkSession, name: str = "page_nodes") -> None:
    """Make ``PageNodes`` known to SQL."""
    spark.udtf.register(name, F.arrow_udtf(PageNodes, returnType=schemas.NODE_ROW))
