"""Collapse a text column to one delimited string per key.

Order is by the text value (the source extracts had no ORDER BY, so a value
order is the only reproducible one); missing values are skipped; duplicates
are kept unless ``distinct``.

A key may have very many values, repeated or different:

* (key, value) pairs are counted with a partial aggregation first, so a key
  with millions of repeated values ships one pair per different value;
* the pairs are dealt into ranges of (key, value), so the different values of
  one key are spread over as many tasks as they fill; each range makes one
  string of a key's values, and a key's few strings meet in the last step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_run(value: Column, times: Column, sep: str) -> Column:
    """``value`` written ``times`` times with ``sep`` in between."""
    return F.concat(value, F.repeat(F.concat(F.lit(sep), value), (times - 1).cast("int")))


def into_ranges(pairs: DataFrame, order: list[Column], ranges: int | None = None) -> DataFrame:
    """Deal rows into ranges of ``order`` of about the same size and add
    ``_range``, the number of a row's range.  Rows that are equal by ``order``
    share a range.  Without a number of ranges, small ones are put together
    at run time."""
    dealt = pairs.repartitionByRange(ranges, *order) if ranges else pairs.repartitionByRange(*order)
    return dealt.withColumn("_range", F.spark_partition_id())


def collapse_text(df: DataFrame, keys: list[str], value: str, out: str, sep: str = "|",
                  distinct: bool = False, value_fn=None, ranges: int | None = None) -> DataFrame:
    """``value_fn`` (a column -> column function, e.g. a character whitelist)
    is applied to each distinct raw value after the pre-aggregation instead
    of to every row; the result is the same because the collapsed text is
    ordered by the transformed value.  ``ranges`` fixes the number of ranges
    that the values are dealt into."""
    k = [F.col(f"`{c}`") for c in keys]
    pairs = (df.where(F.col(f"`{value}`").isNotNull())
               .groupBy(*k, F.col(f"`{value}`").alias("_v"))
               .agg(F.count(F.lit(1)).alias("_n")))
    if value_fn is not None:
        pairs = pairs.withColumn("_v", value_fn(F.col("_v"))).where(F.col("_v").isNotNull())
        if distinct:
            pairs = pairs.select(*k, "_v").distinct()
    # each value's run is one string before values meet (a string has no more
    # than 2**31 characters, nor can its repeats)
    run = F.col("_v") if distinct else text_run(F.col("_v"), F.col("_n"), sep)
    runs = F.sort_array(F.collect_list(F.struct(F.col("_v").alias("v"), run.alias("run"))))
    parts = into_ranges(pairs, [*k, F.col("_v")], ranges).groupBy(*k, "_range").agg(
        F.min("_v").alias("_first"), F.array_join(F.transform(runs, lambda r: r["run"]), sep).alias("_text"))
    ordered = F.sort_array(F.collect_list(F.struct("_first", "_text")))
    return parts.groupBy(*k).agg(F.array_join(F.transform(ordered, lambda p: p["_text"]), sep).alias(out))
