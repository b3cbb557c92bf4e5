"""Keep-first and first-match lookup.

Both are written as aggregations (``min_by`` over an explicit ordering
struct, or ``min`` of the packed order) rather than ``row_number()`` windows: an aggregation combines
map-side before the shuffle, so a key that holds a third of all rows is
reduced to one partial row per map task instead of landing whole in one
window task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.operators.packing import pack_order


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(f"`{x}`")


def order_key(order_cols, nulls_last: bool = True) -> Column:
    """Ascending ordering struct; with ``nulls_last`` a missing value sorts after every value."""
    parts = []
    for i, c in enumerate(order_cols):
        c = _c(c)
        if nulls_last:
            parts.append(c.isNull().alias(f"n{i}"))
        parts.append(c.alias(f"v{i}"))
    return F.struct(*parts)


def keep_first(df: DataFrame, keys: list[str], order_cols: list, nulls_last: bool = True) -> DataFrame:
    """One row per ``keys``: the first row in ``order_cols`` order (ascending).

    Deterministic when ``order_cols`` break all ties; unlike ``dropDuplicates``
    (which keeps an arbitrary row).
    """
    others = [c for c in df.columns if c not in keys]
    picked = (df.groupBy(*[_c(k) for k in keys])
                .agg(F.min_by(F.struct(*[_c(c) for c in others]), order_key(order_cols, nulls_last)).alias("_first")))
    return picked.select(*[_c(k) for k in keys], *[F.col(f"_first.`{c}`").alias(c) for c in others]).select(*df.columns)


def lookup_first(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                 value_cols: list[str], order_cols: list, null_safe: bool = False) -> DataFrame:
    """``y$v[match(x$k, y$k)]``: the first matching right row's values, by a stated order.

    The right side is reduced to one row per key first, then left-joined, so
    the join never fans out.  Values that are order columns themselves come
    out of the packed order (a hash aggregation of one number, after one
    narrow pass for its bounds); others ride along in a sorted one.
    """
    packed = pack_order(right, order_cols) if set(value_cols) <= set(order_cols) else None
    if packed is not None:
        least = right.groupBy(_c(right_key).alias("_lk")).agg(F.min(packed.key()).alias("_p"))
        first = least.select("_lk", *[packed.column(F.col("_p"), v).alias(v) for v in value_cols])
        return _left_lookup(left, first, left_key, null_safe)
    first = (right.groupBy(_c(right_key).alias("_lk"))
                  .agg(F.min_by(F.struct(*[_c(v) for v in value_cols]), order_key(order_cols)).alias("_v"))
                  .select("_lk", *[F.col(f"_v.`{v}`").alias(v) for v in value_cols]))
    return _left_lookup(left, first, left_key, null_safe)


def _left_lookup(left: DataFrame, first: DataFrame, left_key: str, null_safe: bool) -> DataFrame:
    cond = _c(left_key).eqNullSafe(F.col("_lk")) if null_safe else (_c(left_key) == F.col("_lk"))
    return left.join(first, cond, "left").drop("_lk")
