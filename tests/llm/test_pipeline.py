"""The pipeline against brute-force versions of its stages."""

import os

import pytest

import corpus_pipeline
from tests.llm import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_stages_one_by_one(spark):
    first = spark.read.parquet(f"{SF}/documents.parquet")
    steps = {}
    docs = first
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "sharding":
            assert out.columns == first.columns
        out = spark.createDataFrame(out.collect(), out.schema)
        steps[name] = [r.asDict() for r in out.collect()]
        docs = out

    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"]: r["text"] for r in steps["quality_classifier"]}
    clean = [i for i, r in labels.items() if r.quality == 1 and r.toxic == 0]
    junk = [i for i, r in labels.items() if r.quality == 0]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean) and sum(i in kept for i in junk) <= 0.2 * len(junk)

    groups = brute.components({i: brute.simhash(t) for i, t in kept.items()})
    single = {r["doc_id"]: r["text"] for r in steps["simhash_dedup"]}
    assert set(single) == set(groups.values())

    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    leaked = {d for d, _ in brute.leaks(single, items)}
    pure = {r["doc_id"]: r for r in steps["decontamination"]}
    assert set(pure) == set(single) - leaked

    total = sum(len(brute.words(r["text"])) for r in pure.values())
    taken = [len(brute.words(r["text"])) for r in steps["mixing"]]
    assert {r["doc_id"] for r in steps["mixing"]} <= set(pure)
    assert total - max(taken) <= sum(taken) <= total

    shards = [r["shard"] for r in steps["sharding"]]
    counts = [shards.count(s) for s in range(40)]
    assert sorted(r["doc_id"] for r in steps["sharding"]) == sorted(r["doc_id"] for r in steps["mixing"])
    assert max(counts) - min(counts) <= 1


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    assert out.count() == out.select("shard", "slot").distinct().count() > 0


def test_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert "pipeline" in names and all(sum(k.startswith(f"op{n}_") for k in names) == 1 for n in range(1, 11))
