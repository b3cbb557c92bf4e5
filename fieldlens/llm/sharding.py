"""Cut a table into shards that each match the mixture of sources, by
proportional stratified interleaving.

Rows are ranked in a seeded shuffle within their source; the rank as a
fraction of the source's rows orders all rows, which spreads every source
evenly over the order; equal cuts of the order are the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.ordering import bucket_count, key_bucket, running_sum, shuffle_key
from fieldlens.llm.runtime import attach, checkpoint, shielded


def interleave(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", seed: int = 42) -> DataFrame:
    """Every input row with ``shard`` (0 to ``shards`` - 1) and ``slot`` (from
    0, without gaps).  Shards' row counts differ by at most one.

    A null source is a source of its own, a null id an id like any other; rows
    of one id are ordered by text, so repeated rows change places only with
    their equals and reruns agree.  Fewer rows than shards leave shards empty;
    an empty table gives an empty result.  Input columns called like an output
    column are replaced."""
    away, back = shielded(docs, ["shard", "slot"])
    rows = docs.select(
        *away, F.col(source_col).alias("source"),
        shuffle_key(F.col(id_col), F.col(text_col), seed).alias("key"), F.xxhash64(text_col).alias("text_hash"),
        F.lit(1).cast("long").alias("one"))
    counts = checkpoint(rows.groupBy("source").agg(F.sum("one").alias("source_rows")))
    total = counts.agg(F.sum("source_rows")).first()[0] or 0
    buckets = bucket_count(docs)
    ranked = attach(rows, counts, ["source"]).withColumn("bucket", key_bucket(F.col("key"), buckets))
    ranked = running_sum(ranked, ["source"], "bucket", ["key", "text_hash"], "one", "rank")
    spread = (ranked.withColumn("fraction", (2 * F.col("rank") + 1) / (2 * F.col("source_rows")))
              .withColumn("slice", F.floor(F.col("fraction") * buckets).cast("long"))
              .drop("bucket"))
    placed = running_sum(spread, [], "slice", ["fraction", "source", "key", "text_hash"], "one", "position")
    shard = F.expr(f"(position * {shards}) div {max(1, total)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (placed.withColumn("shard", shard).withColumn("slot", F.col("position") - first)
            .select(*back, F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot")))
