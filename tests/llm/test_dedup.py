"""SimHash near-dedup and substring dedup against brute force."""

import hashlib
import os

import numpy as np
import pytest

from fieldlens.llm import decontaminate, queries, simhash_dedup, substring_dedup
from tests.llm import brute

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))


def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    copies = [(100 + i, "same text here again and again", "en") for i in range(5)]
    return [(1, "", None), (2, None, "en"), (None, PASSAGE, "en"), (3, "one", "en"), (4, LONG, "en"), (5, LONG, None),
            (6, "one", "en"), (6, "one", "en"), (7, PASSAGE + " tail of seven", "en"), (8, "head " + PASSAGE, "en"),
            (9, " \t\n\x0b\x0c\r ", "en"), (None, None, None), *copies, *copies[:2]]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), "doc_id long, text string, hash string")


@needs_data
def test_simhash_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {i: brute.simhash(t) for i, t in docs.items()}
    groups = brute.components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op5_simhash_dedup(spark, SF).collect()}
    assert got == {i: (f"{prints[i]:016x}", groups[i]) for i in docs}


def test_simhash_odd_rows(odd):
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash_dedup.near_duplicates(odd).collect()), key=repr)
    rows = odd_rows()
    ids = {k: brute.simhash(t) for k, (_, t, _) in enumerate(rows)}
    groups = brute.components(ids)
    low = {g: min((rows[k][0] for k in ids if groups[k] == g and rows[k][0] is not None), default=None) for g in set(groups.values())}
    assert got == sorted(((rows[k][0], ids[k], low[groups[k]]) for k in ids), key=repr)


def test_one_row_of_each_component_stays(odd):
    kept = simhash_dedup.drop_near_duplicates(odd).collect()
    rows = odd_rows()
    prints = {k: brute.simhash(t) for k, (_, t, _) in enumerate(rows)}
    groups = brute.components(prints)
    assert len(kept) == len(set(groups.values()))
    assert {r.doc_id for r in kept} >= {1, 3, 4, 100}
    assert kept[0].asDict().keys() == {"doc_id", "text", "hash"}


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_dedup.near_duplicates(none).count() == 0
    assert simhash_dedup.drop_near_duplicates(none).count() == 0
    assert substring_dedup.remove_repeats(none).count() == 0


def test_bk_tree_finds_all_within_radius():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (40, 12), dtype=np.uint64)
    values = np.unique(np.concatenate([centre, (centre[:, None] ^ flips).ravel(), (centre[:, None] ^ flips ^ np.roll(flips, 1, 1)).ravel()]))
    found = {(node, int(q)) for node, near in simhash_dedup.BKTree(values).within(values, 4) for q in near}
    want = {(i, j) for i in range(len(values)) for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 4).tolist()}
    assert found == want


@pytest.mark.parametrize("tree_size", [8192, 16])
def test_hot_shard_is_split_without_losing_links(spark, tree_size):
    """One tight ball of fingerprints and a chain of links of exactly 4 bits."""
    rng = np.random.default_rng(2)
    ball = [int(rng.integers(0, 1 << 62)) ^ 0] * 1
    ball += [ball[0] ^ (1 << a) ^ (1 << b) for a, b in rng.integers(0, 62, (150, 2)).tolist() if a != b]
    chain = [sum(15 << 4 * k for k in range(n)) for n in range(1, 15)]
    far = [int(x) for x in rng.integers(0, 1 << 62, 50)]
    prints = sorted(set(ball + chain + far))
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    from fieldlens.llm.components import components
    roots = {r.node: r.root for r in components(simhash_dedup.links(df, 4, tree_size), "a", "b").collect()}
    want = brute.components({p: p for p in prints})
    assert {p: roots.get(p, p) for p in prints} == want


@needs_data
def test_substring_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = {i: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, (n, gone, kept) in brute.cut_repeats(docs).items()}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op4_substring_dedup(spark, SF).collect()}
    assert got == want
    assert sum(gone for _, gone, _ in want.values()) > 0


@pytest.mark.parametrize("hot_bucket", [4096, 1])
def test_substring_odd_rows(odd, hot_bucket):
    """Hot buckets take another way to the same result; null ids are kept
    whole; repeated rows of one id do not remove each other."""
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.remove_repeats(odd, hot_bucket=hot_bucket).collect()), key=repr)
    known = {i: t for i, t, _ in odd_rows() if i is not None}
    cut = brute.cut_repeats(known)
    want = [(i, *cut[i]) if i is not None else (None, len(brute.words(t)), 0, " ".join(brute.words(t))) for i, t, _ in odd_rows()]
    assert got == sorted(want, key=repr)
    assert cut[5][1] == 30_000 and cut[8][1] == 60


def test_substring_repeated_words_in_one_document(spark):
    """A text of one word over and over is a single super-k-mer."""
    df = spark.createDataFrame([(1, "x " * 500), (2, "y " * 100 + "x " * 70), (3, "x " * 49)], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(df).collect()}
    assert got == {1: (500, 0), 2: (170, 70), 3: (49, 0)}


def test_substring_texts_of_one_phrase_are_not_gathered(spark):
    """Two super-k-mers of very many windows make a hot bucket, whose digests
    leave in bounded batches; the result is the same either way."""
    import pyarrow as pa
    long = "round and round it goes " * 20_000
    text = pa.record_batch([pa.array([1]), pa.array([5]), pa.array([long]), pa.array([[0]], pa.list_(pa.int32()))],
                           names=["doc", "digest", "text", "wanted"])
    sizes = [b.num_rows for b in substring_dedup._hot_windows(50, 8)(iter([text]))]
    assert sum(sizes) == 99_951 and max(sizes) <= 16_384
    df = spark.createDataFrame([(1, 5, long), (2, 6, long), (3, 7, " ".join(f"w{i}" for i in range(99)))], "doc long, digest long, text string")
    reached = df.mapInArrow(substring_dedup._minimisers(50, 8), "minimiser long, doc long, digest long, number int, windows long")
    assert [r.hot for r in substring_dedup._shared(reached, 4096, 1 << 17).collect()] == [True]
    assert [r.hot for r in substring_dedup._shared(reached, 4096, 1 << 18).collect()] == [False]
    docs = df.selectExpr("doc as doc_id", "text")
    for options in ({}, {"hot_windows": 1 << 18}):
        got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(docs, **options).collect()}
        assert got == {1: (100_000, 0), 2: (100_000, 100_000), 3: (99, 0)}


def test_hot_buckets_share_the_exchange_of_the_texts(spark):
    text = " ".join(f"w{i}" for i in range(80))
    df = spark.createDataFrame([(i, f"{text} own{i}") for i in range(12)], "doc_id long, text string")
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(s, None) for s in settings]
    try:
        for s in settings:
            spark.conf.set(s, "-1")
        out = substring_dedup.remove_repeats(df, hot_bucket=1)
        assert [n for _, n in sorted((r.doc_id, r.n_removed) for r in out.collect())] == [0] + [80] * 11
    finally:
        for s, v in zip(settings, before):
            spark.conf.set(s, v) if v is not None else spark.conf.unset(s)
    plan = out._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert plan.count("ReusedExchange [doc") >= 2


def test_a_long_text_of_one_item_is_searched_in_bounded_memory():
    """Windows of a text that repeats an item are looked at a stretch at a
    time, and no longer once the item has been found exactly."""
    import tracemalloc

    from fieldlens.llm.words import Words
    item = " ".join(f"word{i}" for i in range(30))
    index = decontaminate.item_indexes([(7, item), (8, item + " and more words than the other one has")], 5, 19)
    data = np.frombuffer(((item + " ") * 1000).encode(), np.uint8)
    words = Words(data, np.array([0, len(data)]), normalise=True)
    tracemalloc.start()
    found = [hit for part in index for hit in part.leaks(words, 0.8)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(i, alike, first) for _, i, alike, first in found][0] == (7, 1.0, 0) and peak < 20e6
