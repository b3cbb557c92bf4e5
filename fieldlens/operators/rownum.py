"""Global row number after a sort, without funnelling rows through one task.

``row_number() OVER (ORDER BY ..)`` with no partition moves every row into a
single task.  Instead rows are cut into buckets by fixed boundaries of the
sort key, counted per bucket, numbered within their bucket, and shifted by
the count of all earlier buckets.  A row's bucket is a function of the row
alone, so the counting and the numbering pass agree whatever Spark re-plans
or re-runs.  The boundaries come from a sample and only decide how even the
buckets are, never the result.  Rows with equal sort keys are ordered by a
hash of the whole row, so very many of them are cut into buckets, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_KEYS_PER_BUCKET = 50


def _bucket(key: Column, bounds: list[Column], low: int = 0) -> Column:
    """Number of boundaries at or below the key, by a balanced comparison tree."""
    if not bounds:
        return F.lit(low)
    mid = len(bounds) // 2
    return F.when(key < bounds[mid], _bucket(key, bounds[:mid], low)).otherwise(
        _bucket(key, bounds[mid + 1:], low + mid + 1))


def into_buckets(df: DataFrame, order_cols: list[str | Column], n: int) -> DataFrame:
    """Add ``_key``, the sort key that ends in a hash of the row, and
    ``_bucket``, one of ``n`` ranges of it."""
    cols = [c if isinstance(c, Column) else F.col(c) for c in order_cols]
    rest = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    key = F.struct(*[part for i, c in enumerate(cols) for part in (c.isNull().alias(f"n{i}"), c.alias(f"v{i}"))],
                   F.xxhash64(*rest).alias("rest"))
    keyed = df.withColumn("_key", key)
    total = df.count()
    sample = keyed.select("_key").sample(min(1.0, n * _KEYS_PER_BUCKET / max(total, 1)), seed=1).sort("_key").collect()
    picked = [sample[len(sample) * i // n][0] for i in range(1, n)] if sample else []
    fields = keyed.schema["_key"].dataType.fields
    bounds = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])
              for i, row in enumerate(picked) if i == 0 or row != picked[i - 1]]
    return keyed.withColumn("_bucket", _bucket(F.col("_key"), bounds))


def global_row_number(df: DataFrame, order_cols: list[str | Column], out: str = "row",
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``out``: 1 .. n in the order of ``order_cols`` (ascending, missing
    last).  Rows with equal keys follow each other in the order of a hash of
    their columns (maps left out), which reruns agree on; only rows that are
    equal throughout share a bucket whatever their number."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = into_buckets(df, order_cols, n)
    counts = cut.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_count"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket, at most n
    offsets = F.broadcast(counts.select("_bucket", F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_offset")))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key"))
    return (cut.join(offsets, "_bucket").withColumn(out, F.col("_offset") + inside)
            .drop("_bucket", "_key", "_offset"))
