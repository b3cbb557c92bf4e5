"""Remove word windows that an earlier document already has, by super-k-mers.

The minimiser of a window is the smallest hash among its ``anchor``-word
shingles.  Consecutive windows of a document that share a minimiser form a
super-k-mer, which travels as one packed string to the minimiser's bucket;
equal windows always meet there.  In a bucket, sorting the windows shows
which ones start in a document with a smaller id.

Three measures keep it to the size of the input:

* A first, narrow pass counts the minimisers.  A bucket that only one
  document reaches holds no repeat, so its super-k-mers never travel.
* A bucket of over ``hot_bucket`` super-k-mers (a passage or a text with very
  many copies) or ``hot_windows`` windows (texts that repeat one phrase, whose
  super-k-mers have no bound) is not gathered: its windows go out one by one as 128-bit
  digests and are settled by a min aggregate with map-side combine and a join.
* Text is moved by document id once: all joins with it, that of the hot
  buckets too, use one exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.runtime import checkpoint, releasing, skew_join
from fieldlens.llm.words import Words, sliding_min, text_runs


class SuperKmers:
    """Super-k-mers of a run of texts: row, first window (word number within
    the row), number of windows and minimiser."""

    def __init__(self, words: Words, window: int, anchor: int):
        low = sliding_min(words.shingles(anchor), window - anchor + 1)
        n = len(low)
        inside = np.flatnonzero(words.row[:n] == words.row[window - 1:window - 1 + n])
        row, low = words.row[inside], low[inside]
        new = np.ones(len(inside), dtype=bool)
        new[1:] = (low[1:] != low[:-1]) | (row[1:] != row[:-1])
        begin = np.flatnonzero(new)
        self.row = row[begin]
        self.start = inside[begin] - words.first[self.row]
        self.windows = np.diff(np.append(begin, len(inside)))
        self.minimiser = low[begin].view(np.int64)
        # number within the row
        self.number = np.arange(len(begin)) - np.searchsorted(self.row, self.row)


def _packed(text: bytes) -> tuple[bytes, np.ndarray]:
    """Words joined by one space, and where each word begins (one more entry
    for the end, as if another word followed)."""
    words = text.split()
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    return b" ".join(words), np.concatenate([[0], np.cumsum(sizes + 1)])


def _minimisers(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, digest = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for i, j, data, offsets in text_runs(batch.column(2)):
                found = SuperKmers(Words(data, offsets), window, anchor)
                yield pa.record_batch(
                    [pa.array(found.minimiser), pa.array(doc[i:j][found.row]), pa.array(digest[i:j][found.row]),
                     pa.array(found.number.astype(np.int32)), pa.array(found.windows.astype(np.int64))],
                    names=["minimiser", "doc", "digest", "number", "windows"])
    return run


def _shared(reached: DataFrame, hot_bucket: int, hot_windows: int) -> DataFrame:
    """Minimisers that several documents reach, and whether they are hot."""
    return (reached.groupBy("minimiser").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("n"),
                                             F.sum("windows").alias("windows"))
            .where("low < high").select("minimiser", ((F.col("n") > hot_bucket) | (F.col("windows") > hot_windows)).alias("hot")))


def _flagged(batches: Iterator[pa.RecordBatch], window: int, anchor: int):
    """(doc, digest, text offsets, super-k-mers and which are wanted) by row."""
    for batch in batches:
        doc, digest = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        wanted, texts = batch.column(3).to_pylist(), batch.column(2)
        for i, j, data, offsets in text_runs(texts):
            found = SuperKmers(Words(data, offsets), window, anchor)
            edges = np.searchsorted(found.row, np.arange(j - i + 1))
            for r in range(j - i):
                if wanted[i + r]:
                    at = edges[r] + np.sort(np.array(wanted[i + r]))
                    joined, begins = _packed(data[offsets[r]:offsets[r + 1]].tobytes())
                    yield doc[i + r], digest[i + r], joined, begins, found, at


def _super_kmers(window: int, anchor: int, batch_rows: int = 4096):
    schema = pa.schema([("minimiser", pa.int64()), ("doc", pa.int64()), ("digest", pa.int64()),
                        ("start", pa.int32()), ("packed", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for doc, digest, joined, begins, found, at in _flagged(batches, window, anchor):
            for start, n, low in zip(found.start[at].tolist(), found.windows[at].tolist(), found.minimiser[at].tolist()):
                out.append((low, doc, digest, start, joined[begins[start]:begins[start + n + window - 1] - 1]))
            if len(out) >= batch_rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    return run


def _hot_windows(window: int, anchor: int, batch_rows: int = 16384):
    schema = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("doc", pa.int64()), ("digest", pa.int64()),
                        ("start", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for doc, digest, joined, begins, found, at in _flagged(batches, window, anchor):
            for start, n in zip(found.start[at].tolist(), found.windows[at].tolist()):
                for w in range(start, start + n):
                    h = hashlib.blake2b(joined[begins[w]:begins[w + window] - 1], digest_size=16).digest()
                    out.append((int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True),
                                doc, digest, w))
                    if len(out) >= batch_rows:
                        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                        out = []
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    return run


def repeated_windows(bucket: list[tuple[int, int, int, bytes]], window: int) -> list[tuple[int, int, int, int]]:
    """Word ranges (doc, digest, from, to) of a bucket's windows that also
    start in a smaller document; the bucket is a list of super-k-mers
    (doc, digest, first word, packed words)."""
    if len({doc for doc, _, _, _ in bucket}) < 2:
        return []
    windows = []
    for k, (doc, _, _, packed) in enumerate(bucket):
        begins = np.concatenate([[0], np.flatnonzero(np.frombuffer(packed, np.uint8) == 0x20) + 1, [len(packed) + 1]]).tolist()
        windows.extend((packed[b:e - 1], doc, k, w) for w, (b, e) in enumerate(zip(begins, begins[window:])))
    windows.sort()
    repeats: dict[int, list[int]] = {}
    seen, smallest = None, 0
    for text, doc, k, w in windows:
        if text != seen:
            seen, smallest = text, doc
        elif doc > smallest:
            repeats.setdefault(k, []).append(w)
    out = []
    for k, found in repeats.items():
        doc, digest, start, _ = bucket[k]
        found.sort()
        begin = last = found[0]
        for w in found[1:]:
            if w > last + window:
                out.append((doc, digest, start + begin, start + last + window))
                begin = w
            last = w
        out.append((doc, digest, start + begin, start + last + window))
    return out


def _buckets(window: int):
    schema = pa.schema([("doc", pa.int64()), ("digest", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket: list[tuple] = []
        out: list[tuple] = []
        key = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != key:
                    out += repeated_windows(bucket, window)
                    key, bucket = row[0], []
                bucket.append(row[1:])
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        out += repeated_windows(bucket, window)
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, ranges as first << 32 | last) -> counts and kept words."""
    for batch in batches:
        totals, removed, kept = [], [], []
        for text, ranges in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
            words = (text or b"").split()
            gone = np.zeros(len(words) + 1, dtype=np.int32)
            for both in ranges or []:
                gone[both >> 32] += 1
                gone[both & 0xFFFFFFFF] -= 1
            stay = np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()
            totals.append(len(words))
            removed.append(len(words) - len(stay))
            kept.append(b" ".join(words if len(stay) == len(words) else [words[i] for i in stay]).decode())
        yield pa.record_batch([batch.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()),
                               pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50,
                   anchor: int = 8, hot_bucket: int = 4096, hot_windows: int = 1 << 17) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every row: every word that is
    covered by a ``window``-word sequence which also starts in a document with
    a smaller id is removed; kept words are joined by one space.

    Windows are judged on the input.  A null text has no words; a text with
    fewer words than a window loses nothing; a null id is neither smaller nor
    larger than another, so such a row is kept whole.  Repeated rows (one id)
    do not remove each other.  An empty table gives an empty result."""
    text = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("digest"),
                       F.col(text_col).alias("text"))
    known = text.where("doc is not null and text is not null")
    reached = known.mapInArrow(releasing(_minimisers(window, anchor)), "minimiser long, doc long, digest long, number int, windows long")
    shared = _shared(reached, hot_bucket, hot_windows)
    number = lambda hot: F.collect_set(F.when(F.col("hot") == F.lit(hot), F.col("number")))
    wanted = checkpoint(skew_join(reached.drop("windows"), shared, ["minimiser"]).groupBy("doc", "digest")
                        .agg(number(False).alias("cold"), number(True).alias("hot")))

    def with_text(column: str) -> DataFrame:
        lists = wanted.select("doc", "digest", F.col(column).alias("wanted"))
        return text.join(lists, ["doc", "digest"], "left").select("doc", "digest", "text", "wanted")

    ranges = (with_text("cold")
              .mapInArrow(releasing(_super_kmers(window, anchor)), "minimiser long, doc long, digest long, start int, packed binary")
              .repartition("minimiser").sortWithinPartitions("minimiser")
              .mapInArrow(releasing(_buckets(window)), "doc long, digest long, first int, last int"))
    if not wanted.where(F.size("hot") > 0).isEmpty():
        # the same join as above and below, so its exchange of the texts serves all three
        hot = with_text("hot").mapInArrow(releasing(_hot_windows(window, anchor)), "hi long, lo long, doc long, digest long, start int")
        low = hot.groupBy("hi", "lo").agg(F.min("doc").alias("low"))
        ranges = ranges.union(skew_join(hot, low, ["hi", "lo"]).where("doc > low").select(
            "doc", "digest", F.col("start").alias("first"), (F.col("start") + window).alias("last")))
    both = F.shiftleft(F.col("first").cast("long"), 32).bitwiseOR(F.col("last").cast("long"))
    gone = ranges.groupBy("doc", "digest").agg(F.collect_set(both).alias("ranges"))
    return (text.join(gone, ["doc", "digest"], "left").select("doc", "text", "ranges")
            .mapInArrow(releasing(_cut), "doc_id long, n_words long, n_removed long, kept_text string"))
