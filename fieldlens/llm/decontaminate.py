"""Find benchmark items in documents: SimHash over item-sized windows, a
multi-index over Hamming blocks, and an exact weighted-shingle check.

The benchmark is a query set: it is read in blocks of a bounded number of
items, each block's index is broadcast and meets all documents once.  Windows
are as long as the item they are compared with.  A window that shares no
shingle with any item has similarity zero, so only windows around shared
shingles get a fingerprint.  The index cuts fingerprints into ``blocks``
pieces: two within ``radius`` bits differ by at most one bit in some piece, so
looking up each piece and its one-bit neighbours yields every item
within the radius.  Each of those is then compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.runtime import releasing
from fieldlens.llm.words import Words, text_runs

_BITS = 64
_STRETCH = 4096  # shingles whose fingerprints are counted at once


def _simhashes(shingles: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """Fingerprint of the ``size`` shingles from each ``begin`` on (weights
    are counts: a shingle votes once per occurrence)."""
    bits = np.unpackbits(shingles.astype(">u8").view(np.uint8)).reshape(-1, _BITS)
    upto = np.zeros((len(shingles) + 1, _BITS), dtype=np.int32)
    np.cumsum(bits, axis=0, out=upto[1:])
    votes = upto[begin + size] - upto[begin]
    return np.packbits(2 * votes > size, axis=1).view(">u8").astype(np.uint64).ravel()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two shingle multisets: the weight of a
    shingle is its count."""
    va, ca = np.unique(a, return_counts=True)
    vb, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    both = np.minimum(ca[ia], cb[ib]).sum()
    return float(both / (len(a) + len(b) - both))


class HammingIndex:
    """All stored fingerprints within ``radius`` bits of a query, by blocks."""

    def __init__(self, values: np.ndarray, radius: int):
        self.values, self.radius = values, radius
        n = radius // 2 + 1  # each block then has one with at most one bit changed
        cuts = [_BITS * i // n for i in range(n + 1)]
        self.blocks = [(np.uint64(lo), np.uint64((1 << (hi - lo)) - 1)) for lo, hi in zip(cuts, cuts[1:])]
        self.tables = []
        for (shift, mask), width in zip(self.blocks, np.diff(cuts)):
            piece = ((values >> shift) & mask).astype(np.int64)
            near = np.concatenate([piece, *(piece ^ (1 << b) for b in range(width))])
            item = np.tile(np.arange(len(values)), width + 1)
            order = np.argsort(near, kind="stable")
            self.tables.append((np.searchsorted(near[order], np.arange((1 << width) + 1)), item[order]))

    def within(self, query: int) -> np.ndarray:
        """Positions of the stored fingerprints within the radius."""
        query = np.uint64(query)
        found = []
        for (shift, mask), (edges, items) in zip(self.blocks, self.tables):
            piece = int((query >> shift) & mask)
            found.append(items[edges[piece]:edges[piece + 1]])
        near = np.unique(np.concatenate(found))
        return near[np.bitwise_count(self.values[near] ^ query) <= self.radius]


class ItemIndex:
    """Index of a block of items that have shingles of ``k`` words."""

    def __init__(self, ids: list[int], shingles: list[np.ndarray], k: int, radius: int):
        self.ids, self.k, self.shingles = np.array(ids, dtype=np.int64), k, shingles
        self.size = np.array([len(s) for s in shingles])
        prints = np.concatenate([_simhashes(s, np.array([0]), len(s)) for s in shingles])
        self.hamming = HammingIndex(prints, radius)
        every = np.concatenate(shingles)
        self.known, back = np.unique(every, return_inverse=True)
        # the item sizes that each known shingle occurs in
        pairs = np.unique(np.stack([back, np.repeat(self.size, self.size)]), axis=1)
        self.edges = np.searchsorted(pairs[0], np.arange(len(self.known) + 1))
        self.sizes = pairs[1]

    def leaks(self, words: Words, threshold: float) -> Iterator[tuple[int, int, float, int]]:
        """(row, item id, best similarity, its first word) of a run of texts."""
        shingles = words.shingles(self.k)
        at = np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)
        hits = np.flatnonzero(self.known[at] == shingles)
        hits = hits[words.row[hits] == words.row[hits + self.k - 1]]
        if not len(hits):
            return
        cuts = np.flatnonzero(np.diff(words.row[hits])) + 1
        for group in np.split(hits, cuts):
            row = int(words.row[group[0]])
            begin, end = int(words.first[row]), int(words.first[row + 1]) - self.k + 1
            yield from ((row, *hit) for hit in self._row(shingles[begin:end], group - begin, at[group], threshold))

    def _row(self, shingles: np.ndarray, hits: np.ndarray, known: np.ndarray, threshold: float):
        best: dict[int, tuple[float, int]] = {}
        count = self.edges[known + 1] - self.edges[known]
        hit = np.repeat(hits, count)
        size = self.sizes[np.repeat(self.edges[known], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
        for n in np.unique(size).tolist():
            span = min(n, len(shingles))  # a text shorter than the item is one window
            last = len(shingles) - span
            # windows around a hit, as a union of ranges of their begins
            ends = np.zeros(last + 2, dtype=np.int64)
            np.add.at(ends, np.clip(hit[size == n] - n + 1, 0, last), 1)
            np.add.at(ends, np.clip(hit[size == n], 0, last) + 1, -1)
            begins = np.flatnonzero(np.cumsum(ends[:-1]))
            missing = int((self.size == n).sum())  # items of this size without an exact copy so far
            i = 0
            while i < len(begins) and missing:
                j = int(np.searchsorted(begins, begins[i] + _STRETCH))
                gaps = np.flatnonzero(np.diff(begins[i:j]) > 4 * span)
                j = i + int(gaps[0]) + 1 if len(gaps) else j
                part, i = begins[i:j], j
                local = shingles[part[0]:part[-1] + span]
                prints = _simhashes(local, part - part[0], span)
                for start, value in zip(part.tolist(), prints):
                    for item in self.hamming.within(value).tolist():
                        if self.size[item] != n or best.get(item, (0.0, 0))[0] >= 1.0:
                            continue
                        alike = similarity(shingles[start:start + span], self.shingles[item])
                        if alike >= threshold and alike > best.get(item, (0.0, 0))[0]:
                            best[item] = (alike, start)
                            missing -= alike >= 1.0
        return [(int(self.ids[i]), alike, start) for i, (alike, start) in sorted(best.items())]


def item_indexes(rows: list[tuple[int, str]], shingle: int, radius: int) -> list[ItemIndex]:
    """Indexes of a block of (id, text) items, one per shingle length: items
    shorter than a shingle count as one shingle of all their words.  Items
    without words are left out."""
    by_length: dict[int, tuple[list, list]] = {}
    for item, text in rows:
        data = np.frombuffer((text or "").encode(), dtype=np.uint8)
        words = Words(data, np.array([0, len(data)]), normalise=True)
        if len(words):
            k = min(shingle, len(words))
            ids, shingles = by_length.setdefault(k, ([], []))
            ids.append(item)
            shingles.append(words.shingles(k))
    return [ItemIndex(ids, shingles, k, radius) for k, (ids, shingles) in sorted(by_length.items())]


def _item_blocks(items: DataFrame, id_col: str, text_col: str, block_items: int, block_bytes: int):
    """The items as (id, text) lists of bounded size, one at a time."""
    rows = items.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text")).where(
        "item is not null and text is not null").distinct()
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(-(-n // block_items), -(-size // block_bytes))
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        yield [(r["item"], r["text"]) for r in part.sort("item", "text").collect()]


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text", shingle: int = 5, threshold: float = 0.8,
               radius: int = 19, block_items: int = 4096, block_bytes: int = 1 << 24) -> DataFrame:
    """(doc_id, item_id, similarity, first_word) for each row and item of
    which some window of the item's length has a weighted shingle similarity
    of at least ``threshold``; the best window, the first among equals.

    Words are runs of letters and digits, ASCII letters lower-cased.  Null,
    empty and word-less texts or items never match, nor do items with a null
    id; repeated items count once per id, repeated rows stay rows; a null
    doc_id is returned as null, one row for each such document.  No items or no documents: no rows."""
    return _leaks(docs, items, id_col, text_col, item_id_col, item_text_col, shingle, threshold, radius, block_items, block_bytes).drop("digest")


def _leaks(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_id_col: str = "item_id", item_text_col: str = "text",
           shingle: int = 5, threshold: float = 0.8, radius: int = 19, block_items: int = 4096, block_bytes: int = 1 << 24) -> DataFrame:
    """The rows of ``find_leaks`` with the digest of the document's text; the
    documents are read once for each block of items."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("digest", F.xxhash64("text"))
    schema = "doc_id long, digest long, item_id long, similarity double, first_word long, block int"
    out = spark.createDataFrame([], schema)
    for b, block in enumerate(_item_blocks(items, item_id_col, item_text_col, block_items, block_bytes)):
        index = spark.sparkContext.broadcast(item_indexes(block, shingle, radius))

        def run(batches: Iterator[pa.RecordBatch], index=index, b=b) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found: dict[tuple[int, int], tuple[float, int]] = {}
                for i, _, data, offsets in text_runs(batch.column(1)):
                    words = Words(data, offsets, normalise=True)
                    for part in index.value:
                        for row, item, alike, first in part.leaks(words, threshold):
                            before = found.get((i + row, item), (0.0, 0))
                            found[i + row, item] = max(before, (alike, first), key=lambda at: (at[0], -at[1]))
                if found:
                    (row, item), (alike, first) = zip(*found), zip(*found.values())
                    at = pa.array(row)
                    yield pa.record_batch([batch.column(0).take(at), batch.column(2).take(at), pa.array(item, pa.int64()),
                                           pa.array(alike, pa.float64()), pa.array(first, pa.int64()), pa.array([b] * len(row), pa.int32())],
                                          names=["doc_id", "digest", "item_id", "similarity", "first_word", "block"])

        out = out.union(rows.mapInArrow(releasing(run), schema))
    # a row has one leak per item and block, so a block counts the equal rows
    best = lambda: F.max(F.struct("similarity", (-F.col("first_word")).alias("before"))).alias("best")
    by_block = (out.groupBy("doc_id", "digest", "item_id", "block").agg(best(), F.count("*").alias("rows"))
                .select("*", "best.similarity", (-F.col("best.before")).alias("first_word")).drop("best"))
    whole = by_block.groupBy("doc_id", "digest", "item_id").agg(best(), F.max("rows").alias("rows"))
    return whole.select("doc_id", "digest", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.before")).alias("first_word"),
                        F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("copy")).drop("copy")


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without any leak (see ``find_leaks``); a row with
    a null id is judged by its text like any other.  Items need no id: all
    count, those with a null id too."""
    options.pop("item_id_col", None)
    items = items.select(F.lit(0).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    # rows are told apart by this key and the digest of their text
    leaks = _leaks(keyed, items, "key", "text", **options).select(F.col("doc_id").alias("leak"), F.col("digest").alias("leak_digest")).distinct()
    rows = keyed.select("row", "key", F.xxhash64("text").alias("digest"))  # the text travels once, in its row
    return rows.join(leaks, (F.col("key") == F.col("leak")) & (F.col("digest") == F.col("leak_digest")), "left_anti").select("row.*")
