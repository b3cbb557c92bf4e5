"""SQL ``NOT IN (subquery)`` with exact null semantics, at any size.

``x NOT IN (S)`` is TRUE only when S is empty, or when x is not null, S has
no null and x is not in S.  Spark plans a single-column ``NOT IN`` as a
null-aware anti join, but only as a *broadcast* hash join, so the subquery
side must fit in memory.  Here the same truth table is rebuilt from parts
that scale: a key-distinct left-anti join (shuffled, or broadcast by AQE
when runtime stats allow) plus a one-row summary of S (row count, null
count) that is safe to broadcast because it is always exactly one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_in(df: DataFrame, probe, sub: DataFrame, sub_col: str) -> DataFrame:
    probe_c = probe if isinstance(probe, Column) else F.col(f"`{probe}`")
    keys = sub.select(F.col(f"`{sub_col}`").alias("_nin_k"))
    stats = keys.agg(F.count(F.lit(1)).alias("_nin_n"),
                     F.count_if(F.col("_nin_k").isNull()).alias("_nin_nulls"))
    distinct_keys = keys.where(F.col("_nin_k").isNotNull()).distinct()
    unmatched = df.join(distinct_keys, probe_c == F.col("_nin_k"), "left_anti")
    return (unmatched.crossJoin(F.broadcast(stats))   # exactly one row
                     .where((F.col("_nin_n") == 0) | ((F.col("_nin_nulls") == 0) & probe_c.isNotNull()))
                     .drop("_nin_n", "_nin_nulls"))


def not_in_literals(c: Column, values: list) -> Column:
    """``c NOT IN (v1, v2, ..)`` on literals (a null ``c`` is dropped by WHERE)."""
    return ~c.isin(*values)
