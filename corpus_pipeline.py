"""The corpus pipeline: documents in, shuffled training shards out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldlens.llm import decontaminate, mixing, sharding, simhash_dedup, weak_quality
from fieldlens.llm.runtime import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly labelled classifier keeps."""
    model = weak_quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return weak_quality.score(docs, model).where("kept").select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash_dedup.drop_near_duplicates(docs, shingle=4, radius=4, seed=42)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), shingle=5, threshold=0.8)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.take(docs, weights=(5, 2, 1), share=1.0, max_epochs=3, seed=42)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture with shard (0 to 39) and slot of every row."""
    return sharding.interleave(docs, shards=40, seed=42)


STAGES = [
    ("quality_classifier", quality),
    ("simhash_dedup", deduplicate),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: SimHash, the trained classifier and the Hamming index have no SQL form; the
#: tests hold run() against brute-force versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    sf_dir = sf_dir.rstrip("/")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
