"""Token ids of a corpus as checksummed binary blocks, and back.

Documents are dealt into ranges of their ids; each task tokenizes its range
in order, appends the end id to every document and cuts the stream of ids
into blocks of ``token_codec.BLOCK`` ids.  A file holds the blocks of one
range: number of the range (``part``) and of the block, the coded ids
(``payload``) and the documents that have ids in the block.  Blocks decode on
their own, so files can be read in any order and split anywhere; Spark's
commit protocol keeps the output of lost or repeated tasks out.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlens.llm import token_codec
from fieldlens.llm.runtime import releasing
from fieldlens.llm.words import text_runs

# The normaliser and pre-tokenizer for which pieces can be encoded one by one:
# tokens never reach over white space, nor from a letter to the marks below or back.
_BY_WORD = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
_ADDED = re.compile(r"<\|[a-z]+\|>")  # added tokens that no cut and no lower-casing touches
_WORD = "^[a-zß-öø-ÿ]+$"
_LETTER, _MARK, _SPACE, _OTHER, _LEAD, _NEXT, _SIGN, _WIDE = range(1, 9)
_KIND = np.full(256, _OTHER, dtype=np.uint8)  # digits, "'" and "|" are cut from nothing but white space
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[list(b'.,;:!?)"(#*$%&+-/<=>@[]^_`{}~\\')] = _MARK
_KIND[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = _LETTER
_KIND[0x80:] = _WIDE
_KIND[0xC3] = _LEAD  # first byte of U+00C0 to U+00FF
_KIND[0x80:0xC0] = _NEXT
_KIND[[0x97, 0xB7]] = _SIGN  # the second byte of the two signs among them
_BETWEEN, _JOINED = ".", 1000
_CACHE_WORDS = 500_000
_RUN_BYTES = 10 << 20  # known pieces are looked up once a run


def _pieces_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, where each piece begins and the end, first piece of each text
    and the end) of pieces that can be encoded one by one: texts without ASCII
    white space, cut there and between a letter and a mark.  A to Z and U+00C0
    to U+00DE are in lower case, except in pieces with other characters
    beyond U+00FF or below U+00C0 (NFC goes before) or a ``<|``."""
    text = data.tobytes()
    kind = np.frombuffer(text.translate(_KIND.tobytes()), dtype=np.uint8)
    lower = np.frombuffer(bytearray(text).lower(), dtype=np.uint8)  # A to Z only
    letter, space, mark = kind == _LETTER, kind == _SPACE, kind == _MARK
    odd = kind == _WIDE
    word_begin = word_end = letter
    lead = np.flatnonzero(kind >= _LEAD)  # bytes beyond ASCII
    if len(lead):
        odd[lead] = True
        lead = lead[kind[lead] == _LEAD]
        second = kind[lead + 1]
        odd[lead] = odd[lead + 1] = False
        word = lead[second == _NEXT]
        word_begin, word_end = letter.copy(), letter.copy()
        word_begin[word], word_end[word + 1] = True, True
        upper = word[data[word + 1] <= 0x9E] + 1
        lower[upper] += 0x20
    begin = np.zeros(len(data) + 1, dtype=bool)
    begin[1:-1] = space[:-1] | (word_end[:-1] & mark[1:]) | (mark[:-1] & word_begin[1:])
    begin[offsets] = True
    keep = ~space
    at = np.flatnonzero(begin[:-1] & keep)
    if b"<|" in text:
        odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
    if odd.any():
        raw = np.zeros(len(at), dtype=bool)
        raw[np.searchsorted(at, np.flatnonzero(odd), side="right") - 1] = True
        if at[0]:  # white space before the first piece
            raw, edges = np.append(False, raw), np.concatenate([[0], at, [len(data)]])
        else:
            edges = np.append(at, len(data))
        lower = np.where(np.repeat(raw, np.diff(edges)), data, lower)
    starts = np.flatnonzero(begin[:-1][keep]) if len(at) else at
    return lower[keep], np.append(starts, int(keep.sum())), np.searchsorted(at, offsets)


class Encoder:
    """Ids of texts by the ``tokenizers`` library, without special tokens
    added.  With the normaliser and pre-tokenizer above, each different piece
    of text is encoded once and its ids are kept; beyond ``_CACHE_WORDS``,
    those that no second run of texts asked for are forgotten.  With any other,
    texts are encoded as they are."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_str(tokenizer_json)
        if self.whole.get_vocab_size() > 1 << 16:
            raise ValueError("the block format holds ids below 65,536")
        config = json.loads(tokenizer_json)
        self.by_word = all(config.get(k) == v for k, v in _BY_WORD.items()) and all(
            _ADDED.fullmatch(t["content"]) and not (t["lstrip"] or t["rstrip"] or t["normalized"] or t["single_word"]) for t in config["added_tokens"])
        if self.by_word:  # a lower-case word of letters is one pre-token, and so is a mark between two
            self.words = Tokenizer.from_str(tokenizer_json)
            self.words.normalizer = None
            self.words.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.Split(_BETWEEN, "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            between = self.words.encode(_BETWEEN, add_special_tokens=False).ids
            self.by_word = len(between) == 1
            self.between = between[0]
        self.known = pa.array([], pa.large_string())
        self.flat, self.edges, self.runs = np.zeros(0, np.uint16), np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _forget(self) -> None:
        """Keep what more than one run has asked for, half the room at most."""
        kept = np.flatnonzero(self.runs > 1)
        if 2 * len(kept) > _CACHE_WORDS:
            kept = np.sort(kept[np.argsort(-self.runs[kept], kind="stable")[:_CACHE_WORDS // 2]])
        size = np.diff(self.edges)[kept]
        edges = np.concatenate([[0], np.cumsum(size)])
        self.flat = self.flat[np.repeat(self.edges[kept] - edges[:-1], size) + np.arange(edges[-1])]
        self.edges, self.runs, self.known = edges, np.ones(len(kept), np.int32), self.known.take(pa.array(kept))

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of lower-case words, many a call."""
        joined = [_BETWEEN.join(words[i:i + _JOINED]) + _BETWEEN for i in range(0, len(words), _JOINED)]
        encoded = self.words.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.uint16), *(np.array(one.ids, dtype=np.uint16) for one in encoded)])
        end = np.flatnonzero(ids == self.between)
        if len(end) != len(words):
            raise ValueError("the tokenizer does not keep words apart")
        return np.delete(ids, end), np.diff(end, prepend=-1) - 1

    def _rest(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of other pieces."""
        ids = [one.ids for one in self.whole.encode_batch_fast(pieces, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        return np.fromiter(itertools.chain.from_iterable(ids), dtype=np.uint16, count=int(size.sum())), size

    def _add(self, pieces: pa.Array, ids: np.ndarray, size: np.ndarray) -> None:
        self.known = pa.concat_arrays([self.known, pieces])
        self.flat = np.concatenate([self.flat, ids])
        self.edges = np.concatenate([self.edges, self.edges[-1] + np.cumsum(size)])
        self.runs = np.concatenate([self.runs, np.zeros(len(size), np.int32)])

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where the ids of each different piece are kept; new ones are encoded."""
        if len(self.known) > _CACHE_WORDS:
            self._forget()
        found = pc.index_in(pieces, self.known).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(found < 0)
        word = pc.match_substring_regex(pieces.take(pa.array(new)), _WORD).to_numpy(zero_copy_only=False)
        for places, ids_of in ((new[word], self._words), (new[~word], self._rest)):
            found[places] = len(self.known) + np.arange(len(places))
            some = pieces.take(pa.array(places))
            self._add(some, *ids_of(some.to_pylist()))
        self.runs[found] += 1
        return found

    def run(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each) of a run of texts."""
        if not self.by_word:
            texts = [data[b:e].tobytes().decode() for b, e in zip(offsets, offsets[1:])]
            encoded = [one.ids for one in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
            sizes = np.array([len(ids) for ids in encoded], dtype=np.int64)
            return np.fromiter((i for ids in encoded for i in ids), dtype=np.uint16, count=int(sizes.sum())), sizes
        if not len(data):
            return np.zeros(0, np.uint16), np.zeros(len(offsets) - 1, np.int64)
        shown, at, first = _pieces_of(data, offsets)
        pieces = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(shown))
        coded = pieces.dictionary_encode()
        place = self._places(coded.dictionary)[coded.indices.to_numpy()]
        begin = self.edges[place]
        size = self.edges[place + 1] - begin
        upto = np.concatenate([[0], np.cumsum(size)])
        where = np.repeat((begin - upto[:-1]).astype(np.int32), size)
        where += np.arange(upto[-1], dtype=np.int32)
        return self.flat[where], np.diff(upto[first])


@functools.lru_cache(maxsize=1)
def _encoder(tokenizer_json: str) -> Encoder:
    """A worker's encoder: Spark keeps workers for later tasks, and so the ids
    of the pieces that their texts share."""
    return Encoder(tokenizer_json)


_DOCS = pa.list_(pa.struct([("seq", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int64()), ("n", pa.int64())]))
_FILE = "part long, block long, payload binary, docs array<struct<seq:long,doc_id:long,first:long,n:long>>"


class _Stream:
    """One range's ids and documents on their way into blocks."""

    def __init__(self, part: int):
        self.part, self.block, self.seq, self.total = part, 0, 0, 0
        self.waiting, self.ids = 0, []
        self.docs = np.zeros((4, 0), dtype=np.int64)  # seq, doc_id, first, n
        self.null = np.zeros(0, dtype=bool)

    def add(self, doc_id: np.ndarray, null: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        first = self.total + np.cumsum(sizes) - sizes
        seq = self.seq + np.arange(len(sizes))
        self.docs = np.concatenate([self.docs, np.stack([seq, doc_id, first, sizes])], axis=1)
        self.null = np.concatenate([self.null, null])
        self.seq, self.total, self.waiting = self.seq + len(sizes), self.total + len(ids), self.waiting + len(ids)
        self.ids.append(ids)

    def batches(self, last: bool) -> Iterator[pa.RecordBatch]:
        """Coded blocks, as many at once as the coder has lanes."""
        size, group = token_codec.BLOCK, token_codec.LANES
        while self.waiting >= size * group or (last and self.waiting):
            ids = np.concatenate(self.ids)
            cuts = range(0, min(len(ids), size * group), size)
            coded = token_codec.encode([ids[i:i + size] for i in cuts])
            self.ids = [ids[size * group:]]
            self.waiting = len(self.ids[0])
            begin = (self.block + np.arange(len(coded))) * size
            _, _, first, n = self.docs
            lo = np.searchsorted(first + n, begin, side="right")
            hi = np.searchsorted(first, begin + size, side="left")
            count = hi - lo
            at = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
            fields = [pa.array(self.docs[0][at]), pa.array(self.docs[1][at], mask=self.null[at]),
                      pa.array(first[at]), pa.array(n[at])]
            docs = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(count)]).astype(np.int32),
                                            pa.StructArray.from_arrays(fields, fields=list(_DOCS.value_type)))
            yield pa.record_batch([pa.array([self.part] * len(coded), pa.int64()), pa.array(begin // size),
                                   pa.array(coded, pa.binary()), docs], names=["part", "block", "payload", "docs"])
            self.block += len(coded)
            open_docs = first + n > self.block * size
            self.docs, self.null = self.docs[:, open_docs], self.null[open_docs]


def _with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> np.ndarray:
    return np.insert(ids, np.cumsum(sizes), end_id)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every text, then ``end_id``, in ascending order of the
    ids of the documents (null first, rows of one id in the order of their
    text's hash) as coded blocks below ``path``, which must not exist yet.

    ``tokenizer`` is the path of a ``tokenizers`` JSON file; its text is sent
    to the tasks.  A null or empty text has the end id only; repeated rows
    are repeated; an empty table gives a dataset without blocks.  Rows of one
    id are dealt by text and row, so no id has to fit in one task."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        model = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, stream = _encoder(model.value), _Stream(TaskContext.get().partitionId())
        for batch in batches:
            doc_id = batch.column(0)
            null, doc_id = doc_id.is_null().to_numpy(zero_copy_only=False), doc_id.fill_null(0).to_numpy()
            for i, j, data, offsets in text_runs(batch.column(1), _RUN_BYTES):
                ids, sizes = encoder.run(data, offsets)
                stream.add(doc_id[i:j], null[i:j], _with_end(ids, sizes, end_id), sizes + 1)
                yield from stream.batches(last=False)
        yield from stream.batches(last=True)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange("doc_id", "hash", "row").sortWithinPartitions("doc_id", "hash", "row")
    ordered.select("doc_id", "text").mapInArrow(releasing(run), _FILE).write.parquet(path)


_ZEROS = bytes(4 * token_codec.BLOCK)


def crc32_joined(pieces: list[tuple[int, int]]) -> int:
    """crc32 of a byte string from (crc32, number of bytes) of its pieces:
    what comes before a piece counts as if zeros stood in the piece's place."""
    out = 0
    for crc, size in pieces:
        zero = 0
        while size:
            step = min(size, len(_ZEROS))
            out, zero, size = zlib.crc32(_ZEROS[:step], out), zlib.crc32(_ZEROS[:step], zero), size - step
        out ^= zero ^ crc
    return out


def _pieces(with_ids: bool):
    """Coded blocks -> the part of each document that lies in the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, token_codec.LANES):
                batch = whole.slice(i, token_codec.LANES)
                ids = token_codec.decode(batch.column(2).to_pylist())
                docs = batch.column(3)
                count = docs.value_lengths().to_numpy()
                row = np.repeat(np.arange(len(ids)), count)
                inner = docs.flatten()
                seq, first, n = (inner.field(k).to_numpy() for k in (0, 2, 3))
                begin = batch.column(1).to_numpy()[row] * token_codec.BLOCK
                size = np.array([len(x) for x in ids])[row]
                lo, hi = np.maximum(first, begin), np.minimum(first + n, begin + size)
                cuts = zip(row.tolist(), (lo - begin).tolist(), (hi - begin).tolist())
                if with_ids:
                    last = pa.array([ids[r][b:e] for r, b, e in cuts], pa.list_(pa.int32()))
                else:
                    data = [memoryview(x.astype("<u4")) for x in ids]
                    last = pa.array([zlib.crc32(data[r][b:e]) for r, b, e in cuts], pa.int64())
                yield pa.record_batch([batch.column(0).take(pa.array(row)), pa.array(seq), inner.field(1), pa.array(first), pa.array(n),
                                       pa.array(lo - first), pa.array(hi - lo), last],
                                      names=["part", "seq", "doc_id", "first", "n", "at", "size", "piece"])
    return run


def _read(spark: SparkSession, path: str, with_ids: bool) -> DataFrame:
    """(part, seq, doc_id, start, n_tokens, pieces in order) per document."""
    blocks = spark.read.schema(_FILE).parquet(path)
    kind = "array<int>" if with_ids else "long"
    pieces = blocks.mapInArrow(releasing(_pieces(with_ids)), "part long, seq long, doc_id long, first long, n long, at long, size long, "
                                                  f"piece {kind}")
    docs = (pieces.groupBy("part", "seq")
            .agg(F.first("doc_id").alias("doc_id"), F.first("first").alias("first"), F.sum("size").alias("n_tokens"),
                 F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "size", "piece"))).alias("pieces")))
    # ranges before a range: a table with a row for each written file
    ranges = blocks.select("part", F.explode("docs").alias("d")).groupBy("part").agg(F.max(F.col("d.first") + F.col("d.n")).alias("ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("before"))
    whole = F.when(F.col("n_tokens") == F.col("n"), F.col("n_tokens")).otherwise(
        F.raise_error(F.lit("ids of a document are missing from the token files")).cast("long"))
    return docs.join(offsets, "part").select("part", "seq", "doc_id", (F.col("before") + F.col("first")).alias("start"),
                                             whole.alias("n_tokens"), "pieces")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document below ``path``: ids as
    an array of integers, the end id included; ``start`` counts the ids of all
    documents before it."""
    ids = F.flatten(F.transform("pieces", lambda p: p["piece"]))
    return _read(spark, path, with_ids=True).select("doc_id", "start", "n_tokens", ids.alias("ids"))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document below ``path``,
    from the decoded ids: crc32 of a document's ids as little-endian
    unsigned 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc, sizes = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            joined = [c[0] if len(c) == 1 else crc32_joined([(one, 4 * n) for one, n in zip(c, s)]) for c, s in zip(crc, sizes)]
            yield pa.record_batch([*(batch.column(i) for i in range(3)), pa.array(joined, pa.int64())],
                                  names=["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = _read(spark, path, with_ids=False).select("doc_id", "start", "n_tokens", "pieces.piece", "pieces.size")
    return rows.mapInArrow(releasing(run), "doc_id long, start long, n_tokens long, ids_crc32 long")
