"""Renewal labelling and active-on-a-date fixtures (FIXTURES.md section C)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fieldlens.operators import active_as_of, label_renewals, share_label

SCHEMA = "practice long, code string, order_ts timestamp_ntz, start date, dur int, k long"


def _slots(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("end", F.date_add(F.to_date("order_ts"), F.col("dur")))


def _labels(spark, rows, skew_split=True):
    df = _slots(spark, rows)
    out = label_renewals(df, ["practice", "code"], "start", "order_ts", "end", ["k"], code_col="code",
                         skew_split=skew_split)
    return [r["label"] for r in out.orderBy("k").collect()]


def ts(s):
    return dt.datetime.fromisoformat(s)


def d(s):
    return dt.date.fromisoformat(s)


@pytest.mark.parametrize("skew_split", [True, False])
def test_renewal_basic(spark, skew_split):
    rows = [(1, "A", ts("2016-01-01 10:00:00"), d("2016-01-05"), 30, 1),
            (1, "A", ts("2016-01-31 09:00:00"), d("2016-02-04"), 30, 2),
            (1, "A", ts("2016-12-01 09:00:00"), d("2016-12-05"), 30, 3)]
    assert _labels(spark, rows, skew_split) == ["H", "R", "H"]


def test_renewal_before_start(spark):
    rows = [(1, "A", ts("2016-01-10 00:00:00"), d("2016-01-20"), 30, 1),
            (1, "A", ts("2016-01-15 00:00:00"), d("2016-01-25"), 30, 2)]
    assert _labels(spark, rows) == ["H", "H"]


def test_renewal_time_of_day(spark):
    # end of the first = 2016-01-31; an order at 23:59 that day is still inside
    rows = [(1, "A", ts("2016-01-01 00:00:00"), d("2016-01-05"), 30, 1),
            (1, "A", ts("2016-01-31 23:59:00"), d("2016-02-04"), 30, 2)]
    assert _labels(spark, rows) == ["H", "R"]


def test_renewal_previous_row_only(spark):
    # long interval, then a short one, then an order inside the long one only
    rows = [(1, "A", ts("2016-01-01 00:00:00"), d("2016-01-01"), 300, 1),
            (1, "A", ts("2016-01-02 00:00:00"), d("2016-01-02"), 1, 2),
            (1, "A", ts("2016-06-01 00:00:00"), d("2016-01-03"), 30, 3)]
    assert _labels(spark, rows) == ["H", "R", "H"]


def test_renewal_null_code(spark):
    rows = [(1, None, ts("2016-01-01 00:00:00"), d("2016-01-05"), 30, 1),
            (1, None, ts("2016-01-10 00:00:00"), d("2016-01-20"), 30, 2)]
    assert _labels(spark, rows) == ["H", "H"]


def test_renewal_null_start(spark):
    # missing start sorts last; the row after a missing start is not R
    rows = [(1, "A", ts("2016-01-01 00:00:00"), None, 30, 1),
            (1, "A", ts("2016-01-10 00:00:00"), d("2016-01-05"), 30, 2),
            (1, "A", ts("2016-01-12 00:00:00"), None, 30, 3)]
    # order: k2 (start 01-05), then k1, k3 (missing starts, by order time);
    # k3's order date is inside k1's end but k1 has no start -> H
    assert _labels(spark, rows) == ["H", "H", "H"]


def test_renewal_key_collision(spark):
    # (1,"23A") and (12,"3A") concatenate to the same text but are different groups
    rows = [(1, "23A", ts("2016-01-01 00:00:00"), d("2016-01-01"), 30, 1),
            (12, "3A", ts("2016-01-05 00:00:00"), d("2016-01-05"), 30, 2)]
    assert _labels(spark, rows) == ["H", "H"]


def test_renewal_shared_label(spark):
    rows = [(1, "A", ts("2016-01-01 00:00:00"), d("2016-01-01"), 30, 1),
            (1, "A", ts("2016-03-01 00:00:00"), d("2016-01-02"), 30, 2),   # own H (after k1's end)
            (1, "A", ts("2016-03-01 00:00:00"), d("2016-01-03"), 30, 3)]   # own R (inside k2), same order time
    df = _slots(spark, rows)
    lab = label_renewals(df, ["practice", "code"], "start", "order_ts", "end", ["k"], code_col="code")
    sh = share_label(lab, ["practice", "code"], "order_ts", "start", ["k"])
    got = [(r["label"], r["shared_label"]) for r in sh.orderBy("k").collect()]
    assert got == [("H", "H"), ("H", "H"), ("R", "H")]


def test_skew_split_equals_plain_lag(spark):
    rnd = random.Random(7)
    rows = []
    base = dt.date(2016, 1, 1)
    for k in range(600):
        p = rnd.choice([1, 1, 1, 1, 2, 3])            # practice 1 is hot
        code = rnd.choice(["A", "B", None])
        start = base + dt.timedelta(days=rnd.randint(0, 40)) if rnd.random() > 0.05 else None
        order = dt.datetime.combine(base + dt.timedelta(days=rnd.randint(0, 40)), dt.time(rnd.randint(0, 23)))
        rows.append((p, code, order, start, rnd.randint(1, 20), k))
    assert _labels(spark, rows, True) == _labels(spark, rows, False)


def test_active_as_of(spark):
    rows = [(1, d("2016-06-03"), 30, 0),   # started on D
            (2, d("2016-05-04"), 30, 0),   # expires on D (30 days elapsed)
            (3, d("2016-05-03"), 30, 0),   # expired on D-1
            (4, d("2016-06-04"), 30, 0),   # starts D+1
            (5, d("2016-06-01"), 30, 1)]   # revoked
    df = spark.createDataFrame(rows, "id int, start_date date, duration_days int, revoked int")
    got = sorted(r.id for r in active_as_of(df, "2016-06-03").collect())
    assert got == [1, 2]


def test_skew_split_with_many_missing_starts(spark):
    # a hot group where most starts are missing: those rows are bucketed by order date
    rnd = random.Random(11)
    base = dt.date(2016, 1, 1)
    rows = []
    for k in range(400):
        start = base + dt.timedelta(days=rnd.randint(0, 30)) if rnd.random() < 0.3 else None
        order = dt.datetime.combine(base + dt.timedelta(days=rnd.randint(0, 30)), dt.time(rnd.randint(0, 23)))
        rows.append((1, "A", order if rnd.random() > 0.02 else None, start, rnd.randint(1, 40), k))
    assert _labels(spark, rows, True) == _labels(spark, rows, False)


def test_hot_group_is_split_across_window_partitions(spark):
    # one (practice, code) holds a third of all rows; its window work is spread
    # over one partition per start date instead of one task for the group
    rnd = random.Random(5)
    base = dt.date(2016, 1, 1)
    rows = []
    for k in range(3000):
        hot = k % 3 == 0
        p, code = (1, "A") if hot else (rnd.randint(2, 500), rnd.choice(["A", "B"]))
        start = base + dt.timedelta(days=rnd.randint(0, 99))
        order = dt.datetime.combine(start - dt.timedelta(days=rnd.randint(0, 5)), dt.time(12))
        rows.append((p, code, order, start, rnd.randint(1, 30), k))
    df = _slots(spark, rows)
    per_window = df.groupBy("practice", "code", "start").count().agg(F.max("count")).first()[0]
    assert per_window <= 0.02 * len(rows)          # largest skew-split window: <= 2% of rows
    assert _labels(spark, rows, True) == _labels(spark, rows, False)


def test_start_with_a_time_of_day(spark):
    """An order later on the start's day lies inside the term; one earlier
    that day does not; the end counts by date."""
    rows = [(1, "a", "2016-01-01 08:00:00", "2016-01-01 09:00:00", "2016-01-08 00:00:00", 1),
            (1, "a", "2016-01-01 10:00:00", "2016-01-02 00:00:00", "2016-01-09 00:00:00", 2),
            (2, "a", "2016-01-01 08:00:00", "2016-01-01 09:00:00", "2016-01-08 00:00:00", 3),
            (2, "a", "2016-01-01 08:30:00", "2016-01-02 00:00:00", "2016-01-09 00:00:00", 4),
            (3, "a", "2016-01-01 08:00:00", "2016-01-01 09:00:00", "2016-01-08 00:00:00", 5),
            (3, "a", "2016-01-08 23:00:00", "2016-01-09 00:00:00", "2016-01-19 00:00:00", 6)]
    df = spark.createDataFrame([(p, c, ts(o), ts(s), ts(e), k) for p, c, o, s, e, k in rows],
                               "practice long, code string, order_ts timestamp_ntz, start timestamp_ntz, end timestamp_ntz, k long")
    for split in (True, False):
        out = label_renewals(df, ["practice", "code"], "start", "order_ts", "end", ["k"], code_col="code", skew_split=split)
        assert [r["label"] for r in out.orderBy("k").collect()] == ["H", "R", "H", "H", "H", "R"]


def test_shared_label_of_a_hot_order_time(spark):
    rows = [(1, "a", ts("2016-01-05 00:00:00"), d("2016-01-01"), 10, k) for k in range(500)] + [
        (1, None, ts("2016-01-05 00:00:00"), None, 10, 600), (None, "a", None, None, 1, 601)]
    df = _slots(spark, rows).withColumn("label", F.when(F.col("k") == 0, "H").otherwise("R"))
    got = {r.k: r.shared_label for r in share_label(df, ["practice", "code"], "order_ts", "start", ["k"]).collect()}
    assert got == {**{k: "H" for k in range(500)}, 600: "R", 601: "R"}
