"""Finding nodes in a parsed page: selectors as data, matches as columns.

All functions work on the columns of a ``DOM`` row (``nodes``, ``pieces``, ``places``).
Values are computed in one pass per selector, so a page never leaves its row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressline.functions.text import (
    WS_CHARS, any_of, blank_to_null, contains_any, sql_text,
)
from pressline.sources.dom import KEYED

Value = Callable[[Column], Column]
NODES = "nodes"
PLACES = "places"


@dataclass(frozen=True)
class Selector:
    """What a node has to look like.

    ``cls`` is an exact class; ``cls_like`` any class containing one of the
    texts (``fold``: in lower case); ``value`` the exact attribute text, and
    ``token`` one of its words; ``within`` an ancestor; ``nth`` the place among
    siblings of the same tag.
    """

    tags: tuple[str, ...] = ()
    cls: str | None = None
    cls_like: tuple[str, ...] = ()
    fold: bool = False
    id: str | None = None
    id_like: str | None = None
    attr: str | None = None
    value: str | None = None
    token: str | None = None
    within: Selector | None = None
    nth: int | None = None


def sel(tag: str | None = None, cls: str | None = None, **more) -> Selector:
    return Selector(tags=(tag,) if tag else (), cls=cls, **more)


def attr(n: Column, name: str) -> Column:
    return F.try_element_at(n["attrs"], F.lit(name))


def has_class_like(n: Column, terms: Sequence[str], fold: bool = False) -> Column:
    return F.exists(n["classes"], lambda c: contains_any(F.lower(c) if fold else c, terms))


# Selectors and the common values are written as SQL text: a page plan has some
# hundred of them, and one parsed text replaces dozens of calls into the JVM.
def sql_attr(name: str) -> str:
    return f"try_element_at(n.attrs, {sql_text(name)})"


def sql_or_null(x: str) -> str:
    return f"get(filter(array({x}), v -> v <> ''), 0)"


TEXT = "array_join(slice(pieces, n.t0 + 1, n.t1 - n.t0), '')"
SPACED_TEXT = "array_join(slice(pieces, n.t0 + 1, n.t1 - n.t0), ' ')"
TEXT_OR_NULL = sql_or_null(TEXT)
NODE = "struct(n.id as id, n.last as last)"


def sql_tests(s: Selector) -> dict[str, str]:
    """The conditions of a selector on a node ``n``, each under the part of the selector it stands for."""
    tests = {}
    if s.tags:
        tests["tags"] = f"n.tag in ({', '.join(sql_text(t) for t in s.tags)})"
    if s.nth is not None:
        tests["nth"] = f"n.nth = {s.nth}"
    if s.cls is not None:
        tests["cls"] = f"array_contains(n.classes, {sql_text(s.cls)})"
    if s.cls_like:
        shown = "lower(c)" if s.fold else "c"
        tests["cls_like"] = f"exists(n.classes, c -> rlike({shown}, {sql_text(any_of(s.cls_like))}))"
    if s.id is not None:
        tests["id"] = f"coalesce({sql_attr('id')} = {sql_text(s.id)}, false)"
    if s.id_like is not None:
        tests["id_like"] = f"coalesce(contains({sql_attr('id')}, {sql_text(s.id_like)}), false)"
    if s.attr is not None:
        a = sql_attr(s.attr)
        if s.value is not None:
            tests["attr"] = f"coalesce({a} = {sql_text(s.value)}, false)"
        elif s.token is not None:
            tests["attr"] = f"coalesce(array_contains(split({a}, ' +'), {sql_text(s.token)}), false)"
        else:
            tests["attr"] = f"{a} is not null"
    return tests


def probe(s: Selector) -> tuple[list[str], str | None]:
    """Keys of the page's index that hold all nodes of a selector, and the part of it that they already answer.

    The rarest kind of key is taken: an id, a class, an attribute with its value,
    an attribute, any class or id, then tags.
    """
    if s.id is not None:
        return ["#" + s.id], "id"
    if s.cls is not None and s.cls.split() == [s.cls]:
        return ["." + s.cls], "cls"
    if s.attr is not None and s.attr in KEYED and s.value is not None:
        return [f"@{s.attr}={s.value}"], "attr"
    if s.attr is not None:
        return ["@" + s.attr], None if s.value is not None or s.token is not None else "attr"
    if s.cls_like:
        return ["*."], None
    if s.id_like is not None:
        return ["*#"], None
    return list(s.tags), "tags"


def sql_pool(keys: Sequence[str]) -> str:
    """The nodes under some keys of the index, in document order."""
    lists = [f"coalesce(try_element_at({PLACES}, {sql_text(k)}), cast(array() as array<int>))" for k in keys]
    found = lists[0] if len(lists) == 1 else f"array_sort(concat({', '.join(lists)}))"
    return f"transform({found}, i -> get({NODES}, i))"


def sql_find_all(s: Selector) -> str:
    """Array of matching nodes in document order.

    Only the nodes under the selector's index keys are looked at; ancestors are
    found once and compared by their ranges.
    """
    keys, answered = probe(s)
    tests = [test for part, test in sql_tests(s).items() if part != answered]
    pool = sql_pool(keys) if keys else NODES
    if s.within is not None:
        below = " and ".join([*tests, "exists(above, a -> a.id < n.id and n.id <= a.last)"])
        return f"get(transform(array({sql_find_all(s.within)}), above -> filter({pool}, n -> {below})), 0)"
    return f"filter({pool}, n -> {' and '.join(tests)})" if tests else pool


def sql_first(s: Selector, value: str) -> str:
    return f"get(transform(slice({sql_find_all(s)}, 1, 1), n -> {value}), 0)"


def find_all(*selectors: Selector) -> Column:
    """Nodes matching the selectors, one selector after the other."""
    found = [sql_find_all(s) for s in selectors]
    return F.expr(found[0] if len(found) == 1 else f"concat({', '.join(found)})")


def find_firsts(*selectors: Selector) -> Column:
    """The first node of each selector, as one array."""
    return F.expr(f"concat({', '.join(f'slice({sql_find_all(s)}, 1, 1)' for s in selectors)})")


def descendants(n: Column) -> Column:
    """All nodes below ``n``, in document order: a contiguous slice."""
    return F.slice(F.col(NODES), n["id"] + 2, n["last"] - n["id"])


def first(s: Selector, value: Value | str) -> Column:
    """``value`` (SQL on ``n``, or a function of the node) of the first matching node."""
    if isinstance(value, str):
        return F.expr(sql_first(s, value))
    return F.get(F.transform(find_firsts(s), value), F.lit(0))


def pieces_of(n: Column) -> Column:
    """Stripped text pieces below the node."""
    return F.slice(F.col("pieces"), n["t0"] + 1, n["t1"] - n["t0"])


def text_of(n: Column) -> Column:
    """Text below the node, its pieces joined without a separator."""
    return F.array_join(pieces_of(n), "")


def text_or_null(n: Column) -> Column:
    return blank_to_null(text_of(n))


def sql_content_or_text() -> str:
    """Trimmed ``content`` attribute if there is one, else the text."""
    content = f"btrim({sql_or_null(sql_attr('content'))}, {sql_text(WS_CHARS)})"
    return f"coalesce({content}, {TEXT_OR_NULL})"


def cascade(selectors: Sequence[Selector], value: Value | str) -> Column:
    """First non-NULL value; each selector offers only its first node."""
    if isinstance(value, str):
        return F.expr(f"coalesce({', '.join(sql_first(s, value) for s in selectors)})")
    return F.coalesce(*[first(s, value) for s in selectors])


def first_element(selectors: Sequence[Selector]) -> Column:
    """struct(id, last) of the first node of the first selector that matches at all."""
    return cascade(selectors, NODE)


def first_match(dom: DataFrame, selectors: Sequence[Selector], value: Value | str = TEXT_OR_NULL) -> DataFrame:
    """``(page_id, url, value)``: the selector cascade as an operator."""
    return dom.select("page_id", "url", cascade(selectors, value).alias("value"))


def first_k(dom: DataFrame, tags: Sequence[str], k: int) -> DataFrame:
    """The first ``k`` elements of the tags per page, as rows with their rank."""
    hits = F.slice(find_all(Selector(tags=tuple(tags))), 1, k)
    rows = dom.select("page_id", F.posexplode(F.transform(hits, text_of)).alias("i", "text"))
    return rows.select("page_id", (F.col("i") + 1).cast("bigint").alias("rank"), "text")


def first_k_rows(nodes: DataFrame, tags: Sequence[str], k: int) -> DataFrame:
    """``first_k`` on the relational node table."""
    w = Window.partitionBy("page_id").orderBy("node_id")
    ranked = nodes.where(F.col("tag").isin(*tags)).withColumn("rank", F.row_number().over(w).cast("bigint"))
    return ranked.where(F.col("rank") <= k).select("page_id", "rank", "text")
