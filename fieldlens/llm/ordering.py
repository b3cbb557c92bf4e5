"""Running sums and positions over a total order, without gathering a group
in one task: rows are cut into buckets that follow the order, bucket sums are
added up over the (small) table of buckets, and only rows of one bucket are
sorted together.  A group that holds a third of all rows spreads over all
its buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.runtime import attach, shuffle_partitions

_ROWS_PER_BUCKET = 50_000
_HEX = 7  # leading hex digits of a shuffle key that choose its bucket


def bucket_count(rows: DataFrame) -> int:
    """Buckets for a table: some 50,000 rows each, up to the 16**7 that a
    shuffle key's leading digits tell apart."""
    n = rows.count()
    return min(16 ** _HEX, max(shuffle_partitions(rows.sparkSession), -(-n // _ROWS_PER_BUCKET)))


def shuffle_key(id_col: Column, text_col: Column, seed: int) -> Column:
    """Seeded pseudo-random key of a row's id; rows without an id are told
    apart by their text, so they do not share one key."""
    unnamed = F.concat(F.lit("null:"), F.md5(F.coalesce(text_col.cast("binary"), F.lit(b""))))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_col.cast("string"), unnamed)))


def key_bucket(key: Column, buckets: int) -> Column:
    """Bucket of a shuffle key, in the order of the keys."""
    lead = F.conv(F.substring(key, 1, _HEX), 16, 10).cast("long")
    return F.floor(lead * F.lit(buckets) / F.lit(16 ** _HEX)).cast("long")


def running_sum(rows: DataFrame, by: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same ``by`` that
    come before this one in ``order``; ``bucket`` must not decrease along it."""
    sums = rows.groupBy(*by, bucket).agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*by, bucket, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(*by, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (attach(rows, offsets, [*by, bucket])
            .withColumn(out, F.col("__offset") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("__offset"))
