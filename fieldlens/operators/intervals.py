"""Subscription intervals: active-on-a-date and renewal labelling.

``label_renewals``
    Within a (practice, ad code) group ordered by (start, order time,
    tie-break), a row is a renewal ``R`` when its order date falls inside the
    *previous* row's [start, end] (time against the start, date against the
    end, both inclusive), else ``H``.  The
    first row of a group, a row whose previous start is missing and a row
    with a missing ad code are ``H``.

    Skew: the previous row is found with ``lag`` inside (group, bucket)
    windows, where the bucket is the start date by default (the order date
    for rows without a start, which sort after all others).  A row that opens
    a bucket takes its predecessor from the last row of the nearest earlier
    bucket of the same group, looked up from a per-bucket summary (one row
    per group and bucket).  A group holding a large share of all rows is
    therefore spread over as many tasks as it has start dates, and the result
    equals the plain group-wide ``lag``.  Rows of one group and one start date
    stay together: a day of one practice's slots of one code.

``label_increment``
    The labels of new rows from a kept state, the last row of each group, so a
    daily run reads the new rows only.  Groups with a late row (one that sorts
    before the kept row, or was ordered no later than the group's latest order)
    are labelled again from their history.

``share_label``
    All rows with the same (practice, ad code, order time) take the label of
    the first of them in (start, tie-break) order: a window over the lines
    of one order time, which one order bounds however hot its group is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(f"`{x}`")


def active_as_of(df: DataFrame, as_of, start: str = "start_date", duration: str = "duration_days",
                 revoked: str | None = "revoked") -> DataFrame:
    """Rows whose subscription covers ``as_of``: started on or before it, at most
    ``duration`` days elapsed (inclusive), and not revoked."""
    d = as_of if isinstance(as_of, Column) else F.to_date(F.lit(str(as_of)))
    cond = (_c(start) <= d) & (F.datediff(d, _c(start)) <= _c(duration))
    if revoked is not None:
        cond = cond & (_c(revoked) == F.lit(0))
    return df.where(cond)


_DEFAULTS = {"string": "", "date": "1970-01-01", "timestamp": "1970-01-01 00:00:00",
             "timestamp_ntz": "1970-01-01 00:00:00", "boolean": False}


def encode_keys(df: DataFrame, cols: list[str], prefix: str) -> tuple[DataFrame, list[str]]:
    """Replace nullable grouping keys by (value-or-default, is-null) pairs.

    Grouping and joining on the encoded columns treats a missing key as its
    own group (like ``eqNullSafe``) while keeping plain equality keys, so a
    window, an aggregation and a join on the same keys share one hash
    partitioning instead of re-shuffling for the null-safe form."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = []
    for i, c in enumerate(cols):
        t = types.get(c, "string")
        default = F.lit(_DEFAULTS.get(t, 0)).cast(t)
        df = df.withColumn(f"{prefix}k{i}", F.coalesce(_c(c), default)).withColumn(f"{prefix}n{i}", _c(c).isNull())
        names += [f"{prefix}k{i}", f"{prefix}n{i}"]
    return df, names


def label_renewals(df: DataFrame, group_cols: list[str], start: str, order_ts: str, end: str,
                   tiebreak: list[str], code_col: str | None = None, label_col: str = "label",
                   bucket: Column | None = None, skew_split: bool = True) -> DataFrame:
    """Add ``label_col`` (``R`` / ``H``) per the rule in the module docstring."""
    order_cols = [_c(start).asc_nulls_last(), _c(order_ts).asc_nulls_last()] + \
                 [_c(t).asc_nulls_last() for t in tiebreak]

    if not skew_split:
        w = Window.partitionBy(*[_c(g) for g in group_cols]).orderBy(*order_cols)
        prev = df.withColumn("_prev_start", F.lag(_c(start)).over(w)).withColumn("_prev_end", F.lag(_c(end)).over(w))
    else:
        # buckets are contiguous ranges of the row order: the start date, and
        # for rows without a start (which sort last, by order time) the order date
        if bucket is None:
            buckets = [_c(start).isNull(), F.to_date(F.coalesce(_c(start), _c(order_ts)))]
        else:
            buckets = [bucket]
        names = [f"_bkt{i}" for i in range(len(buckets))]
        b = df
        for n_, e in zip(names, buckets):
            b = b.withColumn(n_, e)
        enc, allkeys = encode_keys(b, list(group_cols) + names, "_g")
        ng = 2 * len(group_cols)
        bkeys, gkeys = allkeys, allkeys[:ng]      # (group, bucket) keys and group keys
        # bucket order: per bucket column, value ascending with missing last
        border = [F.col(allkeys[i + d]) for i in range(ng, len(allkeys), 2) for d in (1, 0)]
        w = Window.partitionBy(*bkeys).orderBy(*order_cols)
        inner = (enc.withColumn("_ls", F.lag(_c(start)).over(w))
                    .withColumn("_le", F.lag(_c(end)).over(w))
                    .withColumn("_opens", F.lag(F.lit(1)).over(w).isNull())
                    .withColumn("_closes", F.lead(F.lit(1)).over(w).isNull()))
        # the last row of each (group, bucket): one row per bucket, no aggregation
        summary = inner.where(F.col("_closes")).select(
            *bkeys, F.struct(_c(start).alias("s"), _c(end).alias("e")).alias("_last"))
        wb = Window.partitionBy(*gkeys).orderBy(*border)
        carry = summary.select(*bkeys, F.lag(F.col("_last")).over(wb).alias("_pb"))
        joined = inner.join(carry, bkeys, "left")
        prev = joined.select(
            *[F.col(f"`{c}`") for c in df.columns],
            F.when(F.col("_opens"), F.col("_pb.s")).otherwise(F.col("_ls")).alias("_prev_start"),
            F.when(F.col("_opens"), F.col("_pb.e")).otherwise(F.col("_le")).alias("_prev_end"),
        )

    # the order's time against the start, its date against the (inclusive) end
    is_r = (F.col("_prev_start").isNotNull() & (_c(order_ts) >= F.col("_prev_start"))
            & (F.to_date(_c(order_ts)) <= F.to_date(F.col("_prev_end"))))
    if code_col is not None:
        is_r = is_r & _c(code_col).isNotNull()
    return (prev.withColumn(label_col, F.when(F.coalesce(is_r, F.lit(False)), F.lit("R")).otherwise(F.lit("H")))
                .drop("_prev_start", "_prev_end"))


def share_label(df: DataFrame, group_cols: list[str], order_ts: str, start: str, tiebreak: list[str],
                label_col: str = "label", out_col: str = "shared_label") -> DataFrame:
    """Rows sharing (group, order time) take the first label in (start,
    tie-break) order: one window over the rows of one order of a group, so the
    labelled frame is planned once.  A missing key is a key of its own."""
    keys = [_c(g) for g in group_cols] + [_c(order_ts)]
    first = [_c(start).asc_nulls_last()] + [_c(t).asc_nulls_last() for t in tiebreak]
    return df.withColumn(out_col, F.first(_c(label_col)).over(
        Window.partitionBy(*keys).orderBy(*first).rowsBetween(Window.unboundedPreceding, Window.currentRow)))


@dataclass(frozen=True)
class RenewalRule:
    """The columns of ``label_renewals`` and ``share_label``."""
    group_cols: tuple[str, ...]
    start: str
    order_ts: str
    end: str
    tiebreak: tuple[str, ...]
    code_col: str | None = None

    @property
    def columns(self) -> list[str]:
        """Every column that the rule reads, once."""
        return list(dict.fromkeys([*self.group_cols, self.start, self.order_ts, self.end, *self.tiebreak]))

    def place(self) -> Column:
        """A row's place in its group, missing last."""
        parts = [self.start, self.order_ts, *self.tiebreak]
        return F.struct(*[p for c in parts for p in (_c(c).isNull().alias(f"n_{c}"), _c(c).alias(f"v_{c}"))])

    def label(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``label`` and ``shared_label``."""
        groups, ties = list(self.group_cols), list(self.tiebreak)
        labelled = label_renewals(rows, groups, self.start, self.order_ts, self.end, ties, code_col=self.code_col)
        return share_label(labelled, groups, self.order_ts, self.start, ties)


def _by_group(rule: RenewalRule, a: str, b: str) -> Column:
    same = F.lit(True)
    for c in rule.group_cols:
        same = same & F.col(f"{a}.`{c}`").eqNullSafe(F.col(f"{b}.`{c}`"))
    return same


def renewal_state(rows: DataFrame, rule: RenewalRule) -> DataFrame:
    """One row a group: its last row's columns and its latest order time
    (``latest_order``).  ``rows`` may be states, too."""
    latest = F.col("latest_order") if "latest_order" in rows.columns else _c(rule.order_ts)
    rows = rows.select(*[_c(c) for c in rule.columns], latest.alias("latest_order"))
    whole = F.struct(*[_c(c) for c in rule.columns])
    last = rows.groupBy(*[_c(c) for c in rule.group_cols]).agg(F.max_by(whole, rule.place()).alias("_last"), F.max("latest_order").alias("latest_order"))
    return last.select(*[F.col(f"_last.`{c}`").alias(c) for c in rule.columns], "latest_order")


def label_increment(new: DataFrame, state: DataFrame, history: DataFrame, rule: RenewalRule) -> tuple[DataFrame, DataFrame]:
    """(labelled rows, next state) of one run.

    The labelled rows are the new ones, and all rows of groups with a late
    row, whose earlier labels they replace.  ``state`` is that of the rows
    labelled so far (``renewal_state``), ``history`` has those rows; only late
    groups' rows are used of it."""
    columns = new.columns
    first = new.groupBy(*[_c(c) for c in rule.group_cols]).agg(
        F.min(rule.place()).alias("_first"), F.min(F.struct(_c(rule.order_ts).isNull().alias("n"), _c(rule.order_ts).alias("v"))).alias("_ordered"))
    kept = state.withColumn("_place", rule.place())
    late = first.alias("f").join(kept.alias("k"), _by_group(rule, "f", "k")).where(
        (F.col("_first") < F.col("_place")) | F.coalesce(F.col("_ordered.v") <= F.col("latest_order"), F.lit(False))
        | (F.col("_ordered.v").isNull())).select(*[F.col(f"f.`{c}`") for c in rule.group_cols])
    again = history.select(*columns).alias("h").join(late.alias("l"), _by_group(rule, "h", "l"), "left_semi")
    # the kept row stands for its group's rows; late groups have all of theirs
    on_time = state.alias("s").join(late.alias("l"), _by_group(rule, "s", "l"), "left_anti")
    touched = on_time.alias("s").join(first.alias("f"), _by_group(rule, "s", "f"), "left_semi")
    real = new.unionByName(again).withColumn("_kept", F.lit(False))
    stand_in = touched.select(*rule.columns).withColumn("_kept", F.lit(True))
    labelled = rule.label(real.unionByName(stand_in, allowMissingColumns=True)).where(~F.col("_kept")).drop("_kept")
    return labelled, renewal_state(state.unionByName(renewal_state(new, rule)), rule)
