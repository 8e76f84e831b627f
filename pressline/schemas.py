"""Declared schemas; nothing is inferred on read."""

from pyspark.sql import types as T

_S = T.StringType()
_L = T.LongType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


PAGES = _struct(page_id=_L, url=_S, html=_S)

ARTICLE = _struct(url=_S, title=_S, date=_S, author=_S, category=_S, subtitle=_S, content=_S)

ARTICLE_EXTRACTED = T.StructType(
    ARTICLE.fields
    + _struct(metadata=T.MapType(_S, _S), json_ld=_S, error=_S).fields
)

LINK_STATS = _struct(
    pages_visited=_L, links_found=_L, unique_links=_L, categories=_L, tags=_L,
    authors=_L, errors=_L,
)
LINK_RESULT = _struct(
    links=T.ArrayType(_S), stats=LINK_STATS, failed_urls=T.MapType(_S, _S), timestamp=_S,
)

BATCH_TOTALS = _struct(total_links=_L, batch_size=_L, total_batches=_L)
BATCH_INDEX = _struct(total_links=_L, batch_size=_L, total_batches=_L, batches=T.ArrayType(_S))
BATCH_FILE = _struct(batch_no=T.IntegerType(), file=_S, n_links=_L)
PROGRESS = _struct(batch_no=T.IntegerType(), url=_S)
RECORD = _struct(batch_no=T.IntegerType(), file=_S, pos=_L, raw=_S)
ATTEMPT = _struct(url=_S, attempt=T.IntegerType(), status=T.IntegerType(), error=_S)
SITEMAP_URL = _struct(loc=_S)

# One page as a flat, pre-ordered node list.  ``id`` is the place in document
# order and the descendants of a node are exactly ``id + 1 .. last``, so every
# ancestor test is a range test.  ``t0``/``t1`` delimit the node's share of the
# page's text pieces, so no text is stored twice.
NODE = _struct(
    id=T.IntegerType(), parent=T.IntegerType(), last=T.IntegerType(),
    depth=T.IntegerType(), nth=T.IntegerType(), tag=_S,
    attrs=T.MapType(_S, _S), classes=T.ArrayType(_S),
    t0=T.IntegerType(), t1=T.IntegerType(),
)
DOM = _struct(
    page_id=_L, url=_S, nodes=T.ArrayType(NODE), pieces=T.ArrayType(_S),
    piece_node=T.ArrayType(T.IntegerType()), json_ld=_S,
    # ids of the nodes with a tag, a class, an id or an attribute, in document order
    places=T.MapType(_S, T.ArrayType(T.IntegerType())),
)

# a node as a row of its own, with its texts
NODE_ROW = _struct(
    page_id=_L, url=_S, node_id=T.IntegerType(), parent_id=T.IntegerType(), last_id=T.IntegerType(), depth=T.IntegerType(),
    nth=T.IntegerType(), tag=_S, attrs=T.MapType(_S, _S), classes=T.ArrayType(_S), own_text=_S, text=_S,
)
