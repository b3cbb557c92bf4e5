"""Mixing and sharding: laws, edge cases and brute force."""

import os
import zlib
from collections import Counter, defaultdict

import pytest

from fieldlens.llm import mixing, queries, sharding
from fieldlens.llm.ordering import running_sum
from tests.llm import brute

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def targets(sizes):
    """Reshare the excess of capped sources until none is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    capped, out = set(), {}
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        rest = sum(weight[s] for s in names if s not in capped)
        out = {s: 3 * sizes[s] if s in capped else left * weight[s] / rest for s in names}
        above = {s for s in names if s not in capped and out[s] > 3 * sizes[s]}
        if not above:
            return out
        capped |= above


@needs_data
def test_mixing_keeps_its_law(spark):
    rows = queries.op2_mixing(spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sizes = defaultdict(int)
    for r in docs.values():
        sizes[r.source] += len(brute.words(r.text))
    want = targets(sizes)
    taken, largest = Counter(), Counter()
    for r in rows:
        source = docs[r.doc_id].source
        assert r.size == len(brute.words(docs[r.doc_id].text)) and r.source_size == sizes[source]
        assert r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 3 * r.size and r.taken % max(1, r.size) == 0
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    assert len(rows) == len(docs)
    assert sum(sizes.values()) - max(largest.values()) <= sum(taken.values()) <= sum(sizes.values())
    reach = max(largest[s] / want[s] for s in sizes)
    for s in sizes:  # the cut is common to all sources, within one document's finish time
        assert abs(taken[s] - want[s]) <= largest[s] + reach * want[s]
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in queries.op2_mixing(spark, SF).collect()}


def test_targets_stop_at_three_times_the_source(spark):
    df = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 5), (None, 700)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(targets({"a": 10, "b": 1000, "c": 5, None: 700}))
    assert got["a"] == 30


def odd(spark):
    rows = [(1, None, "a", "x"), (2, "", None, "x"), (None, "one two three", "a", "x"), (3, "one two three", None, None),
            (3, "one two three", None, None), (4, "four " * 50, "b", "x"), (5, "five " * 20_000, "b", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, bucket string").selectExpr("*", "7 AS size", "8 AS slot", "9 AS row")


def test_mixing_odd_rows(spark):
    df = odd(spark)
    rows = mixing.mix(df).collect()
    assert len(rows) == 7 and {r.row for r in rows} == {9} and {r.slot for r in rows} == {8}
    assert all(r.taken == 0 for r in rows if not (r.text or "").strip())
    assert all(r.size == len(brute.words(r.text)) and 0 <= r.copies <= 3 for r in rows)
    assert mixing.take(df).columns == df.columns
    assert mixing.take(df).count() == sum(r.copies for r in rows)
    assert mixing.mix(df.limit(0)).count() == 0
    assert [r.taken for r in mixing.mix(df.where("doc_id = 2")).collect()] == [0]  # nothing to take at all


@needs_data
def test_sharding_keeps_its_law(spark):
    rows = queries.op10_sharding(spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    shards = defaultdict(list)
    for r in rows:
        text = (docs[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 16, zlib.crc32(text), "rows", None)
        shards[r.shard].append(r)
    counts = [len(shards[s]) for s in range(40)]
    assert set(shards) == set(range(40)) and max(counts) - min(counts) <= 1
    assert all(sorted(r.slot for r in shards[s]) == list(range(len(shards[s]))) for s in shards)
    # the order by (slot within shard) is the brute-force interleaving
    import hashlib
    key = {i: hashlib.md5(f"42:{i}".encode()).hexdigest() for i in docs}
    by_source = defaultdict(list)
    for i in sorted(docs, key=key.get):
        by_source[docs[i].source].append(i)
    order = sorted(((2 * k + 1) / (2 * len(ids)), s or "", key[i], i) for s, ids in by_source.items() for k, i in enumerate(ids))
    assert [i for *_, i in order] == [r.doc_id for s in range(40) for r in sorted(shards[s], key=lambda r: r.slot)]


def test_every_shard_matches_the_mixture(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "'t' AS text", "CASE WHEN id % 4 < 2 THEN 'hot' ELSE concat('s', id % 4) END AS source")
    got = Counter((r.shard, r.source) for r in sharding.interleave(df).collect())
    assert all(abs(got[s, "hot"] - 50) <= 2 and abs(got[s, "s2"] - 25) <= 2 for s in range(40))


def test_sharding_odd_rows(spark):
    df = odd(spark)
    rows = sharding.interleave(df, shards=3).collect()
    assert sorted(Counter(r.shard for r in rows).values()) == [2, 2, 3]
    assert {r.size for r in rows} == {7} and {r.bucket for r in rows} == {"x", None}
    assert sharding.interleave(df.limit(0)).count() == 0
    assert len({(r.shard, r.slot) for r in sharding.interleave(df, shards=40).collect()}) == 7


def test_running_sum_over_buckets(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "id AS v", "id DIV 100 AS bucket")
    got = {(r.g, r.v): r.before for r in running_sum(df, ["g"], "bucket", ["v"], "v", "before").collect()}
    assert got == {(v % 3, v): sum(u for u in range(v) if u % 3 == v % 3) for v in range(1000)}


def test_rows_without_an_id_spread_over_the_buckets(spark):
    from pyspark.sql import functions as F

    from fieldlens.llm.ordering import key_bucket, shuffle_key
    df = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    n = [r["count"] for r in df.groupBy(key_bucket(shuffle_key(F.col("doc_id"), F.col("text"), 42), 64).alias("b")).count().collect()]
    assert len(n) == 64 and max(n) < 2 * 20_000 / 64
