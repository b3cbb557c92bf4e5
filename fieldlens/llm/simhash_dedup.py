"""Near-duplicate groups by SimHash and BK-trees.

1. Each text gets a 64-bit fingerprint; equal fingerprints collapse into one
   row, so copies never meet each other again.
2. Fingerprints are dealt to shards.  Cutting the 64 bits into ``radius + 2``
   blocks leaves any two fingerprints within the radius with at least two
   equal blocks, so one shard per pair of blocks and their value holds every
   link.  Shards stay about (rows / 2**21) in size for the radius of 4.
3. A shard's fingerprints form a BK-tree (children keyed by the integer
   Hamming distance to their parent); all queries walk it together, and only
   along edges within the radius.  A shard returns a spanning forest of its
   links, never all pairs.
4. Star contraction joins the forests into components.

A tree lives in the task that owns its shard instead of being broadcast:
trees of all fingerprints grow with the corpus, and a broadcast has to have
a size bound.  A shard with over ``tree_size`` fingerprints is cut into
chunks, and each pair of chunks is a task's work of its own, so a hot shard
is split and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.components import components
from fieldlens.llm.runtime import checkpoint, releasing, skew_join

_BLOCK = 1 << 16


def simhash(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """64-bit fingerprint of a UTF-8 text: ASCII letters lower-cased, words
    between ASCII whitespace, each shingle (repeats included) one vote per
    bit; a bit needs over half of the votes.  A text with fewer words than a
    shingle is one shingle; a text without words has fingerprint zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    k = min(shingle, len(words))
    begins = np.concatenate([[0], ends[:len(words) - k] + 1]).tolist()
    ends = ends[k - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(ends), _BLOCK):
        hashes = np.array([digest(joined[i:j], seed) for i, j in zip(begins[at:at + _BLOCK], ends[at:at + _BLOCK])],
                          dtype=">u8")
        bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64)
        votes += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * votes > len(ends)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                 seed: int = 42) -> DataFrame:
    """(doc_id, digest, fp): the fingerprint of every row as a signed long,
    with a digest that tells texts of one id apart.  A null text has no words;
    repeated rows stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [simhash(t.as_py() or b"", shingle, seed) for t in batch.column(2)]  # one text at a time
            yield pa.record_batch([*batch.columns[:2], pa.array(np.array(prints, dtype=np.uint64).view(np.int64))],
                                  names=["doc_id", "digest", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("digest"),
                       F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(releasing(run), "doc_id long, digest long, fp long")


class BKTree:
    """BK-tree over distinct 64-bit values, searched by many queries at once."""

    def __init__(self, values: np.ndarray):
        self.values = values
        # node -> [(distance, child node)]; nodes are positions in values
        self.children: list[list[tuple[int, int]]] = [[] for _ in values]
        todo = [np.arange(len(values))] if len(values) else []
        while todo:
            group = todo.pop()
            node, rest = int(group[0]), group[1:]
            if not len(rest):
                continue
            away = np.bitwise_count(values[rest] ^ values[node])
            order = np.argsort(away, kind="stable")
            away, rest = away[order], rest[order]
            cuts = np.flatnonzero(np.diff(away)) + 1
            for part in np.split(rest, cuts):
                self.children[node].append((int(np.bitwise_count(values[part[0]] ^ values[node])), int(part[0])))
                todo.append(part)

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, positions of the queries within the radius of it)."""
        todo = [(0, np.arange(len(queries)))] if len(self.values) else []
        while todo:
            node, asking = todo.pop()
            away = np.bitwise_count(queries[asking] ^ self.values[node]).astype(np.int16)
            near = asking[away <= radius]
            if len(near):
                yield node, near
            for distance, child in self.children[node]:
                go = asking[np.abs(away - distance) <= radius]
                if len(go):
                    todo.append((child, go))


def shard_links(tree_side: np.ndarray, query_side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (value, root value) of the links within the radius
    between two sets of fingerprints (the same set twice for a whole shard)."""
    values, at = np.unique(np.concatenate([tree_side, query_side]), return_inverse=True)
    tree_at, query_at = at[:len(tree_side)], at[len(tree_side):]
    parent = list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for node, near in BKTree(tree_side).within(query_side, radius):
        a = root(int(tree_at[node]))
        for i in query_at[near].tolist():
            b = root(i)
            if a != b:
                parent[max(a, b)] = a = min(a, b)
    roots = np.array([root(i) for i in range(len(values))], dtype=np.int64)
    linked = roots != np.arange(len(values))
    return values[linked], values[roots[linked]]


def _block_masks(radius: int) -> list[int]:
    """One 64-bit mask for each pair of the ``radius + 2`` blocks."""
    cuts = [64 * i // (radius + 2) for i in range(radius + 3)]
    blocks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])]
    return [a | b for a, b in combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame, radius: int = 4, tree_size: int = 8192) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect exactly
    the fingerprints within ``radius`` bits (a spanning forest per shard)."""
    shards = F.explode(F.array(*[
        F.struct(F.lit(i).cast("short").alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v"))
        for i, m in enumerate(_block_masks(radius))]))
    dealt = prints.select("fp", shards.alias("s")).select("fp", "s.k", "s.v")
    # Shards over the tree size: c chunks; the cell (x, y) holds chunks x <= y.
    hot = (dealt.groupBy("k", "v").count().where(F.col("count") > tree_size)
           .select("k", "v", F.ceil(F.col("count") / tree_size).cast("int").alias("c")))
    own = F.pmod(F.xxhash64("fp"), F.col("c")).cast("int")
    cells = F.when(F.col("c").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("c") - 1))
    rows = (dealt.join(hot, ["k", "v"], "left")
            .select("k", "v", "fp", F.coalesce(own, F.lit(0)).alias("own"), F.explode(cells).alias("other"))
            .select("k", "v", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "fp")
            .repartition("k", "v", "x", "y").sortWithinPartitions("k", "v", "x", "y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _groups(batches, 4):
            own, x, fp = shard[:, 4], shard[:, 2], shard[:, 5].view(np.uint64)
            a, b = shard_links(np.unique(fp[own == x]), np.unique(fp), radius)
            if len(a):
                yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return rows.select(*[F.col(c).cast("long").alias(c) for c in rows.columns]).mapInArrow(releasing(run), "a long, b long")


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[np.ndarray]:
    """Runs of two or more rows with equal leading columns, across batches."""
    held: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
        if held and (held[-1][-1, :n_keys] != rows[0, :n_keys]).any():
            if sum(map(len, held)) > 1:
                yield np.concatenate(held)
            held = []
        cuts = np.flatnonzero((rows[1:, :n_keys] != rows[:-1, :n_keys]).any(axis=1)) + 1
        edges = np.concatenate([[0], cuts, [len(rows)]])
        if len(cuts):
            first, last = rows[:edges[1]], rows[edges[-2]:]
            if sum(map(len, held)) + len(first) > 1:
                yield np.concatenate([*held, first])
            inner = np.flatnonzero(np.diff(edges) > 1)
            for i in inner[(inner > 0) & (inner < len(edges) - 2)]:
                yield rows[edges[i]:edges[i + 1]]
            held = [last]
        else:
            held.append(rows)
    if sum(map(len, held)) > 1:
        yield np.concatenate(held)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    radius: int = 4, seed: int = 42, tree_size: int = 8192) -> DataFrame:
    """(doc_id, digest, fp, root, component_id) of every row; ``root`` is a
    fingerprint that names the component, ``component_id`` is the
    smallest doc_id that is reachable over links of at most ``radius`` bits.

    Null and empty texts have fingerprint zero and link like any other; a
    null doc_id never becomes a component's id unless the whole component has
    none; repeated rows stay rows; an empty table gives an empty result."""
    prints = checkpoint(fingerprints(docs, id_col, text_col, shingle, seed))
    distinct = checkpoint(prints.groupBy("fp").agg(F.min("doc_id").alias("low")))
    stars = components(links(distinct.select("fp"), radius, tree_size), "a", "b")
    rooted = (distinct.join(stars, distinct.fp == stars.node, "left")
              .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    named = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = skew_join(rooted, named, ["root"]).select("fp", "root", "component_id")
    return prints.join(classes, "fp").select("doc_id", "digest", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each component (see ``near_duplicates``): the one with the
    smallest id, among rows of that id the one with the smallest text digest,
    then the smallest other columns.  A component without any id keeps one
    row all the same."""
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("digest"))
    groups = near_duplicates(docs, id_col, text_col, **options)
    first = groups.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("first"))
    # Two hashes of id and text stand for the pair: no nulls, one exchange.
    pair = lambda i, d: (F.xxhash64(i, d).alias("k1"), F.xxhash64(F.lit(7), d, i).alias("k2"))
    chosen = first.select(*pair(F.col("first.doc_id"), F.col("first.digest"))).distinct()
    return (keyed.select("row", *pair(F.col("doc_id"), F.col("digest"))).join(chosen, ["k1", "k2"], "left_semi")
            .groupBy("k1", "k2").agg(F.min("row").alias("row")).select("row.*"))
