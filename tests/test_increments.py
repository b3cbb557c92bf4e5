"""Renewal labels by increments equal those of all rows at once."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from fieldlens.operators.intervals import RenewalRule, label_increment, renewal_state
from fieldlens.plans import inventory

RULE = RenewalRule(("practice_id", "ad_code"), "start_date", "order_ts", "end_date", ("line",), "ad_code")
SCHEMA = "line int, practice_id int, ad_code string, order_ts timestamp, start_date date, end_date date, note string"


def slots(n, seed):
    rng = random.Random(seed)
    day = lambda: dt.datetime(2016, 1, 1) + dt.timedelta(days=rng.randrange(60), hours=rng.choice([0, 12]))
    rows = []
    for line in range(n):
        order = day()
        start = None if rng.random() < 0.1 else (order + dt.timedelta(days=rng.randrange(4))).date()
        rows.append((line, rng.choice([1, 1, 1, 2, 3, None]), rng.choice(["A", "B", None]), order, start,
                     (order + dt.timedelta(days=rng.randrange(20))).date(), f"n{line}"))
    return rows


def labels(df):
    return {r.line: (r.label, r.shared_label, r.note) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_increments_with_late_rows(spark, seed):
    rows = slots(150, seed)
    late = rows[::17]  # arrive a run too late, in whatever order
    by_time = sorted((r for r in rows if r not in late), key=lambda r: r[3])
    runs = [by_time[:60], by_time[60:100] + late[:4], by_time[100:], late[4:]]
    whole = labels(RULE.label(spark.createDataFrame(rows, SCHEMA)))
    assert {v[0] for v in whole.values()} == {"H", "R"}
    history = spark.createDataFrame([], SCHEMA)
    state, got = renewal_state(history, RULE), {}
    for run in runs:
        new = spark.createDataFrame(run, SCHEMA)
        labelled, state = label_increment(new, state, history, RULE)
        out = labels(labelled)
        assert {r[0] for r in run} <= set(out)
        got.update(out)
        state = spark.createDataFrame(state.collect(), state.schema)
        history = history.union(new)
    assert got == whole
    assert sorted(map(str, state.collect())) == sorted(map(str, renewal_state(history, RULE).collect()))


def test_an_on_time_run_needs_no_history(spark):
    rows = [(i, 1, "A", dt.datetime(2016, 1, i + 1), dt.date(2016, 1, i + 1), dt.date(2016, 1, i + 2), "x") for i in range(10)]
    old, new = spark.createDataFrame(rows[:6], SCHEMA), spark.createDataFrame(rows[6:], SCHEMA)
    labelled, state = label_increment(new, renewal_state(old, RULE), old.limit(0), RULE)
    assert {k: v[0] for k, v in labels(labelled).items()} == {6: "R", 7: "R", 8: "R", 9: "R"}
    assert [(r.line, r.latest_order) for r in state.collect()] == [(9, dt.datetime(2016, 1, 10))]


def test_daily_runs_over_the_stand_ins(spark, tmpdir_path):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    from fieldlens.plans import standins as S
    cols = inventory.SLOT_RULE.columns
    slots = S.slots(spark, sf).select(*cols).distinct()
    base = os.path.join(tmpdir_path, "renewals")
    days = F.col("order_ts") < F.lit("1997-01-01")
    odd = F.col("order_id") % 50 == 0  # arrive late
    inventory.update_renewals(spark, base, slots.where(days & ~odd))
    inventory.update_renewals(spark, base, slots.where(~days & ~odd))
    assert os.path.basename(inventory.update_renewals(spark, base, slots.where(odd))) == "v=3"
    key = lambda df: sorted(map(str, df.select(*cols, "label", "shared_label").collect()))
    assert key(inventory.renewals_so_far(spark, base)) == key(inventory.SLOT_RULE.label(slots))
