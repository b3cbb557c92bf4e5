"""Mix sources to target weights by weighted fair queueing.

Every source is a queue of its seeded-shuffled documents, repeated for up to
``max_epochs`` passes.  A document's virtual finish time is the source's
cumulative words up to and including it, divided by the source's target.  All
copies are ordered by finish time and the order is cut at the total budget,
so every source has been served in proportion to its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.ordering import bucket_count, key_bucket, running_sum, shuffle_key
from fieldlens.llm.runtime import attach, checkpoint, shielded

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0,
                   max_epochs: int = 3) -> DataFrame:
    """(source, source_size, rank, target) from (source, source_size).

    Sources by code point, null last, take the weights in turn.  The budget is
    ``share`` of all sizes.  A target stops at ``max_epochs`` times its
    source's size and the excess is reshared by weight: with sources in the
    order of cap / weight, the ones to be capped come first, and the level of
    the others is what is left of the budget over what is left of the weights."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    ranked = (sizes.withColumn("rank", F.row_number().over(by_name).cast("long"))
              .withColumn("weight", F.element_at(cycle, (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")))
              .withColumn("cap", F.lit(max_epochs).cast("long") * F.col("source_size"))
              .withColumn("budget", F.sum("source_size").over(Window.partitionBy()) * F.lit(share)))
    filled = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    level = ((F.col("budget") - F.coalesce(F.sum("cap").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             / F.sum("weight").over(filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    levels = ranked.withColumn("level", level).withColumn("capped", F.col("level") * F.col("weight") > F.col("cap"))
    final = F.min_by(F.when(~F.col("capped"), F.col("level")), F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "rank")))
    return levels.select(
        "source", "source_size", "rank",
        F.when(F.col("capped"), F.col("cap").cast("double"))
        .otherwise(final.over(Window.partitionBy()) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0, max_epochs: int = 3, seed: int = 42) -> DataFrame:
    """Every input row with ``size``, ``source_size``, ``target``, ``copies``
    (0 to ``max_epochs``) and ``taken`` = size * copies.

    Words count as size; null and empty texts have size 0 and are never taken.
    A null source is a source of its own, a null id an id like any other.
    Rows of one id are ordered by size and text, so repeated rows change
    places only with their equals and reruns agree.  Input columns called like
    an output column are replaced.  An empty table gives an empty result."""
    away, back = shielded(docs, ["size", "source_size", "target", "copies", "taken"])
    rows = docs.select(
        *away, F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), shuffle_key(F.col(id_col), F.col(text_col), seed).alias("key"),
        F.xxhash64(text_col).alias("text_hash"))
    # The narrow form serves all planning; text moves once, in the last step.
    narrow = checkpoint(rows.select("source", "size", "key", "text_hash"))
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = checkpoint(source_targets(sizes, weights, share, max_epochs))
    total = targets.agg((F.coalesce(F.sum("source_size"), F.lit(0)) * F.lit(share)).alias("budget")).first()["budget"]
    buckets = bucket_count(narrow)

    def queued(frame: DataFrame) -> DataFrame:
        """Running words of each source up to and including the row."""
        frame = attach(frame, targets, ["source"]).withColumn("bucket", key_bucket(F.col("key"), buckets))
        frame = running_sum(frame, ["rank"], "bucket", ["key", "size", "text_hash"], "size", "served")
        return frame.withColumn("served", F.col("served") + F.col("size"))

    def finish(epoch: Column | int) -> Column:
        return (F.col("served") + F.lit(epoch) * F.col("source_size")) / F.nullif(F.col("target"), F.lit(0.0))

    # Where the global order is cut: the bucket of finish times that the budget
    # ends in, then the first copy in it that does not fit.
    copies = (queued(narrow).where("size > 0 and target > 0")
              .select("rank", "size", F.explode(F.array(*[finish(e) for e in range(max_epochs)])).alias("finish"))
              .withColumn("slice", F.least(F.floor(F.col("finish") * buckets), F.lit(4 * buckets)).cast("long")))
    copies = checkpoint(copies)
    slices = copies.groupBy("slice").agg(F.sum("size").alias("size"))
    upto = slices.select("slice", "size", F.sum("size").over(Window.orderBy("slice")).alias("end"))
    last = upto.where(F.col("end") > total).orderBy("slice").select("slice", (F.col("end") - F.col("size")).alias("before")).first()
    cut = None
    if last:
        inside = copies.where(F.col("slice") == last["slice"]).select(
            "finish", "rank", (F.sum("size").over(Window.orderBy("finish", "rank")) + F.lit(last["before"])).alias("end"))
        cut = inside.where(F.col("end") > total).orderBy("finish", "rank").select("finish", "rank").first()

    def taken_copy(epoch: int) -> Column:
        if cut is None:
            return F.lit(1)
        at = finish(epoch)
        return ((at < cut["finish"]) | ((at == cut["finish"]) & (F.col("rank") < cut["rank"]))).cast("int")

    fits = (F.col("size") > 0) & (F.col("target") > 0)
    count = F.when(fits, sum((taken_copy(e) for e in range(max_epochs)), F.lit(0))).otherwise(0).cast("int")
    return queued(rows).withColumn("copies", count).select(
        *back, "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def take(docs: DataFrame, **options) -> DataFrame:
    """The mixed table itself: every row as often as ``mix`` takes it."""
    mixed = mix(docs, **options)
    return mixed.where("copies > 0").select(*[F.col(f"`{c}`") for c in docs.columns],
                                            F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy")).drop("__copy")
