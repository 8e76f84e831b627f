"""N-gram Jaccard join of documents: size-aware, heavy and light.

A text's set has its distinct shingles of ``shingle`` words (four).  Two sets link when
100 * intersection >= ``percent`` (85) * union.

* Equal sets are one node.
* Light: two sets of at most ``boundary`` shingles link exactly if they share a subset of the size that
  their two sizes ask for.  All such subsets are listed, and those that are equal meet.
* Heavy: if one of the sets is larger, both have, among their first n - ceil(n * percent / 100) + 1 shingles in one
  common order, a shingle in common.  The inverted lists of these shingles are scanned.  Shingles that
  many texts have come last in the order, so their long lists are hardly used.
* ``boundary`` is where the subsets to list and the lists to scan cost least together, from the
  histogram of set sizes and the mean length of the lists.

A list of near copies is not expanded into all its pairs.  Long lists are cut into tiles, which first
give a spanning forest of the pairs that a 1024-bit parity sketch can't tell apart; their sets are
compared, and then only pairs of nodes that are not yet in one component come up.  A sketch can prove
two sets too far apart to link, never the contrary, so no link is lost.

Shingles, sets and subsets are told apart by 64-bit hashes.

Cases: null and empty texts, and texts without words, have an empty set (size 0) and link with nothing;
texts with fewer words than a shingle have one; repeated rows and copies are one node and get a
row each; a null id never names a component while another id is there; empty tables give no rows; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from pressline.llm.common import broadcast_if, cut, driver_released, id_as_text, id_as_was, released, text_rows
from pressline.llm.components import components

SHINGLE = 4  # words, unless the caller asks for others
PERCENT = 85  # of the union that two sets share if they link, likewise
HEAVY = 24  # a shingle with so many texts comes last in the order
COUNTED = 0.4  # share of the order, by hash, from which first shingles come; only these are counted
LONG_LIST = 32  # longer lists are compared in tiles
TILE = 2048
MASK_BITS = 24  # of the table of heavy shingles; shingles that share a place share its mark
ID_BITS = 24  # of the table of ids whose texts are read again, which is broadcast: 4 MB at most
MAX_BOUNDARY = 36
CACHED_WORDS = 50_000
#: pairs of id and hash, of 16 bytes each
BROADCAST_KEYS = 2_000_000
WORDS_64 = 16  # longs of a sketch

_WORDS: dict[bytes, int] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def forget() -> None:
    """The words of this worker."""
    _WORDS.clear()


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    if len(_WORDS) > CACHED_WORDS:
        _WORDS.clear()
    for w in words:
        if w not in _WORDS:
            _WORDS[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter((_WORDS[w] for w in words), np.uint64, len(words))
    if len(h) <= shingle:
        h = np.append(h, np.full(shingle - len(h), len(h), np.uint64))
    out = h[: len(h) - shingle + 1].copy()
    for k in range(1, shingle):
        out = mixed(out) + h[k : len(h) - shingle + 1 + k] * np.uint64(0x9E3779B97F4A7C15)
    return np.unique(mixed(out))


def node_of(s: np.ndarray) -> int:
    return int(np.int64(xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63)))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def sketch(s: np.ndarray) -> list[int]:
    """Parity of the shingles in each of 1024 places."""
    places = np.bincount((s >> np.uint64(54)).astype(np.int64), minlength=1024) & 1
    return np.packbits(places.astype(np.uint8)).view(np.int64).tolist()


def overlap_needed(a, b, percent: int = PERCENT):
    return -(-percent * (a + b) // (100 + percent))


def may_link(a: int, b: int, percent: int = PERCENT) -> bool:
    return 100 * min(a, b) >= percent * max(a, b)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - (percent * n + 99) // 100 + 1


def subsets_listed(n: int, boundary: int, percent: int = PERCENT) -> int:
    """How many subsets a set of n shingles lists."""
    asked = ((b, overlap_needed(n, b, percent)) for b in range(1, boundary + 1) if may_link(n, b, percent))
    return sum(comb(n, c) for b, c in asked if c <= min(n, b))


def choose_boundary(sizes: dict[int, int], mean_list: float, percent: int = PERCENT) -> int:
    """The boundary at which listing subsets and scanning lists cost least together."""

    def cost(x: int) -> float:
        total = 0.0
        for n, count in sizes.items():
            if n <= x:
                total += count * subsets_listed(n, x, percent)
            if n > x or 100 * n >= percent * (x + 1):
                total += count * prefix_length(n, percent) * (1 + mean_list)
        return total

    return min(range(MAX_BOUNDARY + 1), key=cost)


def per_text(rows: DataFrame, make, schema: str, shingle: int = SHINGLE) -> DataFrame:
    """make(.., shingles) gives the rows of a text from its other columns, as a list of tuples; a batch for each batch."""
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [r for *key, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) for r in make(*key, shingles(t, shingle))]
            columns = zip(*found) if found else [()] * len(out)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    return id_as_text(rows).mapInArrow(released(run, forget), schema)


def heavy_table(rows: DataFrame, shingle: int = SHINGLE) -> tuple[np.ndarray, float, dict[int, int]]:
    """Bit table of the shingles that many texts have, the mean list length, and the small set sizes.

    Shingles are told apart by 32 bits here, which only shapes the order.  The table has a fixed size;
    only its words come to the driver.
    """
    size_mark, low = 1 << 40, np.uint64(0xFFFFFFFF)
    limit = np.uint64(int(COUNTED * (1 << 64)))

    def entries(_, s):
        h = (s[s < limit] & low).astype(np.int64)
        return [(np.append(h, size_mark + len(s)) if 0 < len(s) <= 2 * MAX_BOUNDARY else h,)]

    counts = per_text(rows, entries, "h array<long>", shingle).select(F.explode("h").alias("h")).groupBy("h").agg(F.count("*").alias("c"))
    is_size = F.col("h") >= size_mark
    place = F.shiftright(F.col("h").bitwiseAND(F.lit((1 << MASK_BITS) - 1)), 6)
    many = ~is_size & (F.col("c") >= HEAVY)
    nowhere = 1 << (MASK_BITS - 6)  # where the counts of all others are summed
    word = F.when(is_size, size_mark - F.col("h")).when(many, place).otherwise(nowhere)
    heavy = F.when(many, F.expr("shiftleft(1L, int(h & 63))")).otherwise(F.lit(0).cast("long"))
    light = F.least("c", F.lit(HEAVY))
    words = counts.groupBy(word.alias("word")).agg(F.bit_or(heavy).alias("bits"), F.sum("c").alias("c"), F.sum(light).alias("s"), F.sum(light * light).alias("q"))
    table, sizes, total, square = np.zeros(nowhere + 1, np.int64), {}, 0, 0
    for r in words.collect():
        if r["word"] < 0:
            sizes[-r["word"]] = r["c"]
        else:
            table[r["word"]] = r["bits"]
            total, square = total + r["s"], square + r["q"]
    return table, square / max(1, total), sizes


def is_heavy(table: np.ndarray, s: np.ndarray) -> np.ndarray:
    h = s & np.uint64((1 << MASK_BITS) - 1)
    return (table.view(np.uint64)[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) == 1


def light_keys(s: np.ndarray, boundary: int, percent: int = PERCENT) -> list[tuple[int, bool]]:
    """(hash of a subset and the two sizes that ask for it, whether the set has the lower size).

    The last bit of the hash is set if the two sizes are one.
    """
    n, out = len(s), []
    for b in range(1, boundary + 1):
        c = overlap_needed(n, b, percent)
        if may_link(n, b, percent) and c <= min(n, b):
            sizes = f"{min(n, b)}:{max(n, b)}:".encode()
            for part in combinations(range(n), c):
                h = xxhash.xxh64_intdigest(sizes + s[list(part)].tobytes())
                out.append(((h & ~1 | (n == b)) - (1 << 63), n <= b))
    return out


def light_links(docs: DataFrame) -> DataFrame:
    """Edges (u, v) that connect what the shared subsets link; each is a true link."""
    listed = docs.select("node", F.col("n_shingles").alias("n"), F.explode(F.arrays_zip("keys", "low")).alias("e")).select("node", "n", "e.keys", "e.low")
    listed = listed.withColumnRenamed("keys", "key").distinct()
    # sets of one size link among themselves, sets of two sizes with each other
    ends = listed.groupBy("key").agg(
        F.min(F.when(F.col("low"), F.col("node"))).alias("a"), F.min(F.when(~F.col("low"), F.col("node"))).alias("b"), F.count("*").alias("f"))
    met = listed.join(ends.where("f > 1"), "key")
    other = F.when(F.col("low"), F.coalesce(F.col("b"), F.when(F.pmod("key", F.lit(2)) == 1, F.col("a")))).otherwise(F.col("a"))
    return met.select(F.col("node").alias("u"), other.alias("v")).where("v is not null and u <> v")


def list_entries(s: np.ndarray, boundary: int, table: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of a set in the common order, and what stands before each."""
    n = len(s)
    if n == 0 or (n <= boundary and 100 * n < percent * (boundary + 1)):
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    late = is_heavy(table, s)
    first = np.concatenate([s[~late], s[late]])[: prefix_length(n, percent)]
    before = np.insert((first[:-1] & np.uint64(0x7FFFFFFF)).astype(np.int32), 0, -1)
    return signed(first), before


def lists_of(docs: DataFrame) -> DataFrame:
    """(token, f, node, n, pos, before): the inverted lists that have at least two nodes."""
    entries = docs.select("node", F.col("n_shingles").alias("n"), F.posexplode(F.arrays_zip("tokens", "before")).alias("pos", "e"))
    # dealt before they are gathered: lists mostly have one node, so gathering first would only add bytes
    entries = entries.select(F.col("e.tokens").alias("token"), "node", "n", "pos", F.col("e.before").alias("before")).repartition("token")
    lists = entries.groupBy("token").agg(F.collect_set(F.struct("node", "n", "pos", "before")).alias("l"))
    return lists.where(F.size("l") > 1).select("token", F.size("l").alias("f"), F.explode("l").alias("e")).select("token", "f", "e.*")


def needed(a: str, b: str, percent: int) -> str:
    return f"(({percent} * ({a} + {b}) + {99 + percent}) div {100 + percent})"


def short_list_pairs(lists: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of a short list that may link.

    A pair is looked at where its shared shingles begin: not where both have the same one before, and only
    at places that leave room for the overlap it needs.
    """
    short = lists.where(F.col("f") <= LONG_LIST)
    need = needed("a.n", "b.n", percent)
    on = (f"a.token = b.token and a.node < b.node and 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) and (a.before <> b.before or a.pos = 0 or b.pos = 0) "
          f"and a.pos <= a.n - {need} and b.pos <= b.n - {need}")
    pairs = short.alias("a").join(short.alias("b"), F.expr(on)).select(F.col("a.node").alias("u"), F.col("b.node").alias("v"), F.expr(f"a.n + b.n - 2 * {need}").alias("room")).distinct()
    u = nodes.select(F.col("node").alias("u"), F.col("sketch").alias("s_u"))
    v = nodes.select(F.col("node").alias("v"), F.col("sketch").alias("s_v"))
    apart = " + ".join(f"bit_count(s_u[{k}] ^ s_v[{k}])" for k in range(WORDS_64))
    return pairs.join(u, "u").join(v, "v").where(f"{apart} <= room").select("u", "v")


def long_list_pairs(lists: DataFrame, nodes: DataFrame, labels: DataFrame | None, percent: int) -> DataFrame:
    """Pairs (u, v) of the long lists that may link, as far as they are needed for the components.

    A list is cut into blocks by a hash, and each pair of blocks is a tile of its own.  Without labels a
    tile gives a spanning forest of its pairs, nearest sketches first; with labels (components found so
    far) it gives the pairs between components.
    """
    named = lists.where(F.col("f") > LONG_LIST).join(nodes.select("node", "sketch"), "node")
    label = F.col("node")
    if labels is not None:
        named, label = named.join(labels, "node", "left"), F.coalesce("component", "node")
    blocks = F.ceil(F.col("f") / float(TILE)).cast("int")
    named = named.select("token", "node", label.alias("c"), "n", "pos", "before", "sketch", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"))
    tiles = named.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    tiles = tiles.withColumn("t1", F.least("block", "other")).withColumn("t2", F.greatest("block", "other"))
    forest = labels is None

    def compare(tile: pa.Table) -> pa.Table:
        tile = tile.take(np.argsort(tile["node"].to_numpy(), kind="stable"))
        bits = tile["sketch"].combine_chunks().flatten().to_numpy().reshape(tile.num_rows, -1).view(np.uint64)
        node, c, n, pos, before, block = (tile[x].to_numpy() for x in ("node", "c", "n", "pos", "before", "block"))
        one = tile["t1"][0] == tile["t2"][0]
        us, vs, far = [], [], []
        for k in range(len(node) - 1):
            rest = slice(k + 1, None)
            need = overlap_needed(n[k], n[rest], percent)
            ok = (100 * np.minimum(n[k], n[rest]) >= percent * np.maximum(n[k], n[rest])) & (pos[k] <= n[k] - need) & (pos[rest] <= n[rest] - need)
            ok &= (before[rest] != before[k]) | (pos[k] == 0) | (pos[rest] == 0)
            ok &= (one | (block[rest] != block[k])) & (node[rest] != node[k])
            if not forest:
                ok &= c[rest] != c[k]
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            d = np.bitwise_count(bits[k] ^ bits[k + 1 + at]).sum(1)
            near = n[k] + n[k + 1 + at] - d.astype(np.int64) >= 2 * need[at]
            us.append(np.full(near.sum(), k)), vs.append(k + 1 + at[near]), far.append(d[near])
        if not us:
            return pa.table({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
        u, v, d = np.concatenate(us), np.concatenate(vs), np.concatenate(far)
        if forest:
            top, keep = list(range(len(node))), []

            def root(x: int) -> int:
                while top[x] != x:
                    top[x] = top[top[x]]
                    x = top[x]
                return x

            for e in np.argsort(d, kind="stable"):
                a, b = root(int(u[e])), root(int(v[e]))
                if a != b:
                    top[b] = a
                    keep.append(e)
            u, v = u[keep], v[keep]
        return pa.table({"u": node[u], "v": node[v]})

    return tiles.groupBy("token", "t1", "t2").applyInArrow(compare, "u long, v long").distinct()


def perhaps_among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows with an id of ``ids``, and few others, without moving a text.

    A bit table of the hashed ids has a fixed number of words, whatever the input's size; ids that share a
    place are told apart by the join that follows.
    """

    def place(name: str) -> tuple:
        at = F.xxhash64(name).bitwiseAND(F.lit((1 << ID_BITS) - 1))
        return F.shiftright(at, 6).alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int")).alias("_bit")

    words = ids.select(*place("any_id")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    met = rows.select("*", *place("doc_id")).join(F.broadcast(words), "_word")
    return met.where(F.col("_bits").bitwiseAND(F.col("_bit")) != 0).select(*rows.columns)


def verified(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those of the distinct pairs (u, v) that link."""
    near = cut(pairs)
    wanted = near.select(F.col("u").alias("node")).unionByName(near.select(F.col("v").alias("node"))).distinct()
    one = cut(wanted.join(nodes.select("node", "any_id"), "node").select("any_id").distinct())
    maybe = perhaps_among(rows, one)
    texts = maybe.join(one, maybe["doc_id"].eqNullSafe(one["any_id"]), "left_semi").select("doc_id", "text")
    driver_released(rows.sparkSession)
    sets = per_text(texts, lambda _, s: [(node_of(s), s.tobytes())] if len(s) else [], "node long, s binary", shingle)
    sets = sets.join(wanted, "node", "left_semi").dropDuplicates(["node"])
    met = near.join(sets.select(F.col("node").alias("u"), F.col("s").alias("s_u")), "u").join(
        sets.select(F.col("node").alias("v"), F.col("s").alias("s_v")), "v")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("s_u").to_pylist(), batch.column("s_v").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return met.mapInArrow(released(compare), "u long, v long")


def in_order() -> Column:
    """What the rows of a component are put in order by; null ids come last."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")


def linked(df: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, lowest) for every row.

    ``lowest`` is the (id is null, id, text hash) that comes first in the row's component, null for an empty set.
    """
    rows = text_rows(df, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    bits, mean_list, sizes = heavy_table(rows, shingle)
    boundary = choose_boundary(sizes, mean_list, percent)
    table = df.sparkSession.sparkContext.broadcast(bits)  # of fixed size
    driver_released(df.sparkSession)

    def entries(doc_id, text_hash, s):
        if not len(s):
            return [(doc_id, text_hash, 0, None, None, [], [], [], [])]
        tokens, before = list_entries(s, boundary, table.value, percent)
        keys = light_keys(s, boundary, percent) if len(s) <= boundary else []
        return [(doc_id, text_hash, len(s), node_of(s), sketch(s), tokens, before, [k for k, _ in keys], [x for _, x in keys])]

    hashed = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    docs = cut(id_as_was(per_text(hashed, entries, "doc_id string, text_hash long, n_shingles long, node long, sketch array<long>, tokens array<long>, before array<int>, keys array<long>, low array<boolean>", shingle), kind))
    nodes = cut(docs.where("n_shingles > 0").groupBy("node").agg(F.min(in_order()).alias("first"), F.max("sketch").alias("sketch")))
    nodes = nodes.select("node", "first", F.col("first.doc_id").alias("any_id"), "sketch")
    lists = cut(lists_of(docs))
    driver_released(df.sparkSession)
    light = light_links(docs)
    candidates = short_list_pairs(lists, nodes, percent).unionByName(long_list_pairs(lists, nodes, None, percent)).distinct()
    first = cut(verified(candidates, nodes, rows, shingle, percent).unionByName(light))
    driver_released(df.sparkSession)
    labels = components(first)
    merged = labels
    if lists.where(F.col("f") > LONG_LIST).limit(1).count():
        second = verified(long_list_pairs(lists, nodes, labels, percent), nodes, rows, shingle, percent)
        merged = components(first.unionByName(second))
    named = nodes.join(merged, "node", "left").select("node", "first", F.coalesce("component", "node").alias("c"))
    lowest = named.groupBy("c").agg(F.min("first").alias("lowest"))
    by_node = named.join(lowest, "c").select("node", "lowest")
    return docs.select("doc_id", "text_hash", "n_shingles", "node").join(by_node, "node", "left")


def join(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, node) for every row."""
    out = linked(df, id_col, text_col, shingle, percent)
    return out.select("doc_id", "n_shingles", F.coalesce("lowest.doc_id", "doc_id").alias("component_id"), "node")


def few(keys: DataFrame) -> DataFrame:
    """Written keys of documents, sent to all tasks while they are few; the texts are only shuffled beyond that."""
    return broadcast_if(keys, keys.count(), BROADCAST_KEYS)


def one_of_each(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The input without the documents that link, directly or not, to one that comes before.

    The lowest id stays, null ids come last, and texts of one id are told apart by their hash.  Repeated
    rows (same id and text) become one; rows with an empty set all stay.
    """
    below = linked(df, id_col, text_col, shingle, percent).where((F.col("n_shingles") > 0) & ~F.col("lowest").eqNullSafe(in_order()))
    below = few(cut(below.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()))
    key = [F.col(f"`{id_col}`").alias("_id"), F.xxhash64(text_col).alias("_hash")]
    rest = df.join(below, df[id_col].eqNullSafe(below["_id"]) & (F.xxhash64(F.coalesce(df[text_col], F.lit(""))) == below["_hash"]), "left_anti")
    repeated = few(cut(df.select(*key).groupBy("_id", "_hash").count().where("count > 1").select("_id", "_hash")))
    same = rest[id_col].eqNullSafe(repeated["_id"]) & F.xxhash64(rest[text_col]).eqNullSafe(repeated["_hash"])
    copies = rest.join(repeated, same, "left_semi").dropDuplicates([id_col, text_col])
    return rest.join(repeated, same, "left_anti").unionByName(copies)
