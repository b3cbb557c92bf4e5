"""Multi-level rollup in one pass.

The dashboard summed every measure once per manager level (six levels x
seventeen measures = 102 group-bys, plus conditional means).  Here one
``GROUPING SETS`` aggregation computes all levels together: Spark expands
each input row once per level and aggregates with map-side combine, so even
a top-level manager that covers every rep is a cheap partial aggregate.
Rows whose manager key is missing are dropped (they belong to no manager).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def level_rollup(df: DataFrame, levels: list[tuple[str, str]], sums: list[str],
                 means: list[tuple[str, Column, str]] | None = None,
                 level_col: str = "level", key_col: str = "manager") -> DataFrame:
    """``levels``: (level name, key column).  ``means``: (output, condition, value column)
    gives ``avg(value)`` over rows where ``condition`` holds (null when none)."""
    key_names = [k for _, k in levels]
    aggs = [F.sum(F.col(f"`{s}`")).alias(s) for s in sums]
    for out, cond, val in (means or []):
        aggs.append(F.avg(F.when(cond, F.col(f"`{val}`"))).alias(out))
    aggs.append(F.grouping_id().alias("_gid"))
    grouped = df.groupingSets([[F.col(f"`{k}`")] for k in key_names], *[F.col(f"`{k}`") for k in key_names]).agg(*aggs)
    # grouping_id bit i (from the left, most significant first) is 1 when column i is aggregated away
    n = len(key_names)
    level_expr = None
    key_expr = None
    for i, (name, k) in enumerate(levels):
        gid = (1 << n) - 1 - (1 << (n - 1 - i))
        cond = F.col("_gid") == F.lit(gid)
        level_expr = F.when(cond, F.lit(name)) if level_expr is None else level_expr.when(cond, F.lit(name))
        key_expr = F.when(cond, F.col(f"`{k}`")) if key_expr is None else key_expr.when(cond, F.col(f"`{k}`"))
    out = grouped.select(level_expr.alias(level_col), key_expr.alias(key_col),
                         *[F.col(f"`{s}`") for s in sums], *[F.col(f"`{m[0]}`") for m in (means or [])])
    return out.where(F.col(key_col).isNotNull())
