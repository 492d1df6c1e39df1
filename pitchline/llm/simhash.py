"""SimHash near-dedup: fingerprints, shard BK-trees over bit distance, components.

1. ``fingerprints``: one 64-bit SimHash per text (Arrow batches, numpy).
2. ``links``: fingerprints within ``max_bits`` agree on at least
   ``blocks - max_bits`` of ``blocks`` bit blocks, so every such pair meets in
   a shard named by one choice of agreeing blocks and their bits. Shards with
   one member are dropped by a map-side combined count. Every other shard is
   cut into chunks of at most ``chunk`` fingerprints on average; each chunk
   becomes a BK-tree (children keyed by integer Hamming distance to the
   parent) that is sent to all query chunks of its shard, and a search follows
   only the edges within the radius. A task cell holds two chunks, never a
   whole hot shard, and returns a spanning forest of its links: every link's
   connection is kept, the quadratic list of pairs is not.
3. ``components``: large-star / small-star rounds on the forest edges, each
   round a written table, until nothing changes.

``blocks`` only moves work between shard count and shard size; the links are
the same: with 4 bits, 5 blocks give 5 keys of 13 bits, 6 give 15 keys of 21,
7 give 35 of 27, 8 give 70 of 32 (for some 10^7, 10^8, 10^10 fingerprints).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.functions.columns import broadcast_if_small
from pitchline.llm.common import bounded_batches, land, text_or_empty

SEED = 42
#: Shingles hashed and counted at a time, so a very long text needs little memory beside itself.
SHINGLE_BLOCK = 1 << 16


def fingerprint(text: str, shingle: int = 4) -> int:
    """SimHash of one text as a signed 64-bit integer; no words gives 0."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) < shingle:
        hashes: Iterator[int] = iter([digest(join(words), SEED)])
        total = 1
    else:
        runs = zip(*(itertools.islice(words, k, None) for k in range(shingle)))
        hashes = (digest(join(run), SEED) for run in runs)
        total = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, total, SHINGLE_BLOCK):
        part = np.fromiter(hashes, np.uint64, min(SHINGLE_BLOCK, total - start))
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprint_column(text_col: str, shingle: int = 4) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
    return of(text_or_empty(text_col))


class BKTree:
    """BK-tree over distinct fingerprints; a batch of queries is searched level by level.

    ``children[node]`` maps the integer distance to the one child at it. For the
    search the children of a node lie side by side, ordered by their edge.
    """

    def __init__(self, values: np.ndarray):
        self.values = values.astype(np.uint64)
        n = len(values)
        ints = [int(v) for v in self.values]
        children: list[dict[int, int]] = [{} for _ in range(n)]
        for i in range(1, n):
            at, v = 0, ints[i]
            while True:
                d = (ints[at] ^ v).bit_count()
                nxt = children[at].get(d)
                if nxt is None:
                    children[at][d] = i
                    break
                at = nxt
        # edges as one sorted key (node * 65 + distance), so a range of edges is two binary searches
        edges = sorted((node * 65 + d, child) for node in range(n) for d, child in children[node].items())
        self.edge_keys = np.array([k for k, _ in edges], np.int64)
        self.edge_child = np.array([c for _, c in edges], np.int64)

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query index, node index) of all pairs at ``radius`` or less."""
        q = np.arange(len(queries), dtype=np.int64)
        node = np.zeros(len(queries), np.int64)
        queries = queries.astype(np.uint64)
        found_q, found_n = [], []
        while len(q):
            d = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
            hit = d <= radius
            found_q.append(q[hit])
            found_n.append(node[hit])
            lo = np.searchsorted(self.edge_keys, node * 65 + np.maximum(d - radius, 0), "left")
            hi = np.searchsorted(self.edge_keys, node * 65 + np.minimum(d + radius, 64), "right")
            count = hi - lo
            q = np.repeat(q, count)
            first = np.cumsum(count) - count
            node = self.edge_child[np.repeat(lo - first, count) + np.arange(count.sum())]
        return np.concatenate(found_q), np.concatenate(found_n)


def _forest(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spanning forest of the links between values ``a`` and ``b``."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            yield x, y


def _cell_links(left: np.ndarray, right: np.ndarray, same: bool, radius: int) -> Iterator[tuple[int, int]]:
    """Forest of the links within one chunk (``same``) or between two chunks of a shard."""
    if len(left) == 0 or len(right) == 0:
        return
    values, queries = (left, left) if same else (right, left)
    q, n = BKTree(values).within(queries, radius)
    a, b = queries[q].view(np.int64), values[n].view(np.int64)
    other = a != b
    yield from _forest(a[other], b[other])


def _search(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Cells arrive sorted by (shard, value, i, j); one cell's two chunks are held at a time."""
    out: list[tuple[int, int]] = []
    key, held = None, []

    def flush():
        if key is not None and held:
            own = np.concatenate([h[0] for h in held])
            fps = np.concatenate([h[1] for h in held]).view(np.uint64)
            i, j = key[2], key[3]
            out.extend(_cell_links(fps[own == i], fps[own == j], i == j, radius))

    def ready() -> pa.RecordBatch:
        a, b = zip(*out)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(6)]
        if not len(cols[0]):
            continue
        change = np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)
        bounds = np.concatenate([[0], np.flatnonzero(change) + 1, [len(cols[0])]])
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            here = tuple(int(c[lo]) for c in cols[:4])
            if here != key:
                flush()
                key, held = here, []
            held.append((cols[4][lo:hi], cols[5][lo:hi]))
        if len(out) >= 10_000:
            yield ready()
    flush()
    if out:
        yield ready()


def _masks(max_bits: int, blocks: int) -> list[int]:
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    part = [(1 << edges[k + 1]) - (1 << edges[k]) for k in range(blocks)]
    masks = [sum(part[k] for k in agree) for agree in itertools.combinations(range(blocks), blocks - max_bits)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def links(fps: DataFrame, max_bits: int = 4, blocks: int = 6, chunk: int = 1024) -> DataFrame:
    """(a, b): links between different fingerprints of ``fps(fp)``, a spanning forest per task cell."""
    if not max_bits < blocks <= 64:
        raise ValueError("blocks must lie above max_bits")
    masks = _masks(max_bits, blocks)
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks]))
                       .alias("shard", "bits"))
    shared = keyed.groupBy("shard", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    cells = (keyed.join(shared, ["shard", "bits"])
             .withColumn("own", F.pmod(F.xxhash64("fp"), chunks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
             .select("shard", "bits", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     "own", "fp"))
    cells = cells.repartition("shard", "bits", "i", "j").sortWithinPartitions("shard", "bits", "i", "j")
    return cells.mapInArrow(lambda it: _search(it, max_bits), "a long, b long")


def _landed_side(least: DataFrame) -> DataFrame:
    """One row per key, written and read again before it is joined to the rows it came from.

    Joined directly, both sides would share the aggregate's partitioning and
    Spark could not split a hub with many rows; a table is broadcast where its
    size allows it, and otherwise shuffled for the join alone, which it can.
    """
    return broadcast_if_small(land(least, "simhash-least"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable over ``edges(a, b)``; only nodes with edges."""
    pairs = F.col("a") != F.col("b")
    now = land(edges.where(pairs).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
               "simhash-links")
    seen = None
    while True:
        # large-star: every larger neighbour moves to the smallest neighbour
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _landed_side(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = (both.where("v > u").join(low, "u").where("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small-star: every smaller neighbour and the node itself move to the smallest neighbour
        least = _landed_side(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (large.join(least, "u")
                 .select(F.inline(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                          F.struct(F.col("v").alias("u"), F.col("m").alias("v")))))
                 .where("u != v").distinct())
        now = land(small, "simhash-stars")
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state


def classified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
               max_bits: int = 4, blocks: int = 6, chunk: int = 1024) -> DataFrame:
    """(id, text_hash, fp, component_id) of every row; see ``near_dedup``."""
    marked = land(bounded_batches(docs).select(F.col(id_col).alias("id"), F.xxhash64(text_or_empty(text_col)).alias("text_hash"),
                              fingerprint_column(text_col, shingle).alias("fp")), "simhash-fingerprints")
    fps = marked.groupBy("fp").agg(F.min("id").alias("first_id"))
    found = components(links(fps.select("fp"), max_bits, blocks, chunk))
    rooted = (fps.join(found, fps["fp"] == found["node"], "left")
              .select("fp", F.coalesce("root", "fp").alias("root"), "first_id"))
    least = _landed_side(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    classes = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return marked.join(classes, "fp")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    Rows whose fingerprints are linked directly or over others share the
    smallest id among them. NULL and blank texts have fingerprint zero and are
    linked like any other; texts of fewer than ``shingle`` words hash their
    whole sequence. Repeated rows share a fingerprint, so they never add
    links; NULL ids never become a component's id unless it has no other
    (component_id NULL). Other columns are ignored; an empty table gives an
    empty result.
    """
    return classified(docs, id_col, text_col, **params).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group, columns unchanged.

    Dropped rows are named by (id, text hash), so a repeated id with another
    text is judged by itself. Rows with a NULL id stay: they cannot be told
    apart.
    """
    losers = (classified(docs, id_col, text_col, **params).where("id != component_id")
              .select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash")).distinct())
    same = (docs[id_col] == losers["__id"]) & (F.xxhash64(text_or_empty(text_col)) == losers["__hash"])
    return docs.join(losers, same, "left_anti")
