"""Scorecard, rollup and roster fixtures (FIXTURES.md section C)."""

import datetime as dt
from decimal import Decimal
import pytest

from pyspark.sql import functions as F

from fieldlens.plans import sales

# plan-class substrings for these fixtures
CLASSES = {"software": "soft", "listing": "list", "ship": "ship", "pro": "pro", "tab": "tab", "emr": "d"}
ROSTER_SCHEMA = ("email string, name string, region string, zone string, city string, cm string, rm string, "
                 "zm string, azm string, am_email string, am_name string, aam string, exp string, level string, "
                 "role string, target int")


def _orders(spark, rows):
    """rows: (email, plan, amount)"""
    df = spark.createDataFrame(rows, "claimed_email string, plan string, amount double")
    return df.select("claimed_email", "plan", F.col("amount").cast("decimal(18,2)").alias("amount_in_inr"),
                     F.lit("INR").alias("currency"))


def _rep(email, role="H", exp="exp", target=1, am="am1", cm="all"):
    return (email, email, "r", "z", "c", cm, "rm1", "zm1", "azm1", am, am, "aam1", exp, "TM", role, target)


def _mgr(email, level):
    return (email, email, None, None, None, None, None, None, None, None, None, None, None, level, None, None)


def _roster(spark, rows):
    return sales.lower_roster(sales.roster_union(spark.createDataFrame([], ROSTER_SCHEMA),
                                                 spark.createDataFrame(rows, ROSTER_SCHEMA)))


def test_plan_classes(spark):
    o = _orders(spark, [("a", p, 1.0) for p in ["Soft Starter", "Soft Pro", "Soft Tab", "Soft Standard", "List Pro"]])
    r = sales.rep_order_stats(o, CLASSES).first()
    assert (r.orders_n, r.starter_n, r.pro_n, r.tab_n, r.emr_n, r.listing_n) == (5, 3, 2, 1, 1, 1)


def test_role_gate(spark):
    reps = _roster(spark, [_rep("h", "H"), _rep("u", "U"), _rep("x", "X")])
    o = _orders(spark, [(e, "Soft Pro", 12000.0) for e in ["h", "u", "x"]])
    got = {r.email: (r.units_h, r.units_u) for r in sales.rep_scorecard(o, reps, CLASSES).collect()}
    assert got == {"h": (1.0, 0.0), "u": (0.0, 1.0), "x": (0.0, 0.0)}


def _rollup(spark, reps, orders):
    t = _roster(spark, reps + [_mgr("am1", "AM"), _mgr("all", "Country")])
    card = sales.rep_scorecard(orders, t.where(F.col("level") == "TM"), CLASSES, exact=True)
    return card, {(r.level, r.email): r for r in sales.leadership_rollup(card, t).collect()}


def test_rollup_ratio_is_recomputed_not_averaged(spark):
    reps = [_rep("a", "H", target=1), _rep("b", "H", target=3)]
    o = _orders(spark, [("a", "Soft Pro", 12000.0)])
    _, roll = _rollup(spark, reps, o)
    assert roll[("AM", "am1")].targ_ach_h == 0.25


def test_rollup_targ_ach_n_units_vs_revenue(spark):
    reps = [_rep("a", "H", target=2)]
    o = _orders(spark, [("a", "Soft Pro", 12000.0)])
    card, roll = _rollup(spark, reps, o)
    assert card.first().targ_ach_n == 6000.0            # rep: revenue / targets
    assert roll[("AM", "am1")].targ_ach_n == 0.5        # manager: units / targets


def test_rollup_mean_over_subset(spark):
    reps = [_rep("a", "H", "exp"), _rep("b", "H", "new"), _rep("c", "U", "exp")]
    o = _orders(spark, [("a", "Soft Pro", 24000.0), ("b", "Soft Pro", 12000.0), ("c", "Soft Pro", 36000.0)])
    _, roll = _rollup(spark, reps, o)
    r = roll[("AM", "am1")]
    assert (r.aupw_exp_h, r.aupw_new_h, r.aupw_exp_u, r.aupw_new_u) == (2.0, 1.0, 3.0, 0.0)


def test_rollup_levels_sum_to_the_same_totals(spark):
    reps = [_rep("a", "H", am="am1"), _rep("b", "U", am="am2"), _rep("c", "H", am="am2")]
    o = _orders(spark, [("a", "Soft Pro", 100.0), ("b", "List x", 50.0), ("c", "Soft Tab", 7.0)])
    t = _roster(spark, reps + [_mgr("am1", "AM"), _mgr("am2", "AM"), _mgr("all", "Country")])
    card = sales.rep_scorecard(o, t.where(F.col("level") == "TM"), CLASSES, exact=True)
    roll = sales.leadership_rollup(card, t)
    for m in ["revenue", "orders_n", "listing_n", "units_h", "units_u"]:
        am = roll.where(F.col("level") == "AM").agg(F.sum(m)).first()[0]
        cm = roll.where(F.col("level") == "Country").agg(F.sum(m)).first()[0]
        reps_total = card.agg(F.sum(m)).first()[0]
        # every level is rounded to 6 digits after summing exact money
        assert abs(am - cm) < 1e-5 and abs(cm - reps_total) < 1e-5, m


def test_roster_order(spark):
    rows = [_mgr("c", "Country"), _rep("t1"), _mgr("r", "Region"), _mgr("a", "AM")]
    rows.append(("t0", "t0", None, "z", "c", "all", "rm1", "zm1", "azm1", "am1", "am1", "aam1", "exp", "TM", "H", 1))
    df = spark.createDataFrame(rows, ROSTER_SCHEMA)
    out = sales.roster_sorted(sales.roster_union(spark.createDataFrame([], ROSTER_SCHEMA), df))
    got = [r.email for r in out.orderBy("row").collect()]
    assert got == ["c", "r", "a", "t1", "t0"]          # missing region last within TM


def test_attribution_share(spark):
    o = _orders(spark, [("a", "Soft", 1.0), ("b", "Soft", 1.0), ("c", "Soft", 1.0), (None, "Soft", 1.0)])
    assert sales.order_scalars(o).first().d == 0.75
    o2 = _orders(spark, [("a", "Soft", 1.0)])
    assert sales.order_scalars(o2).first().d == 1.0


def test_roster_union_drops_placeholders_and_no_zone_reps(spark):
    rows = [_rep("a"), _rep("zz"), ("b", "b", "r", "-", "c", "all", "rm1", "zm1", "azm1", "am1", "am1", "aam1",
                                    "exp", "TM", "H", None)]
    out = sales.roster_union(spark.createDataFrame([_mgr("m", "AM")], ROSTER_SCHEMA),
                             spark.createDataFrame(rows, ROSTER_SCHEMA))
    assert sorted(r.email for r in out.collect()) == ["a", "m"]


def test_metrics_sheet_follows_roster_order(spark):
    import os
    from fieldlens.plans import standins as S
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    sheet = [(r["PSW.Email"], r["Level"]) for r in sales.q_metrics_sheet(spark, sf).collect()]
    union = sales.roster_union(S.roster_managers(spark, sf), S.roster_reps(spark, sf))
    rows = sales.roster_sorted(union).orderBy("row").collect()
    assert sheet == [(r.email.lower(), r.level) for r in rows]


def test_sheet_rows_of_a_person_listed_twice(spark):
    """n roster rows in, n sheet rows out."""
    import os
    from fieldlens.plans import standins as S
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    managers, reps = S.roster_managers(spark, sf), S.roster_reps(spark, sf)
    twice = reps.unionByName(reps.limit(1))
    orders = sales.clean_orders(S.plan_orders(spark, sf))
    one, two = sales.sheet_from(orders, managers, reps).count(), sales.sheet_from(orders, managers, twice).count()
    assert (one, two) == (managers.count() + reps.count(), managers.count() + reps.count() + 1)


def test_reports_follow_the_as_of_date(spark):
    import os
    from fieldlens.plans import inventory
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    june = sales.q_orders_month_published(spark, sf, "1998-06-20").collect()
    may = sales.q_orders_month_published(spark, sf, "1998-05-20").collect()
    assert {(r.placed_date.year, r.placed_date.month) for r in june} <= {(1998, 6)}
    assert {(r.placed_date.year, r.placed_date.month) for r in may} <= {(1998, 5)}
    total = lambda as_of: sum(r["Revenue"] for r in sales.q_metrics_sheet(spark, sf, as_of).where("Level = 'TM'").collect())
    assert total("1998-06-20") == pytest.approx(sum(float(r.amount_in_inr) for r in june if r.claimed_email))
    assert total("1998-06-20") != total("1998-05-20")
    keep = {(r.order_id, r.plan) for r in inventory.slot_inventory(spark, sf, "1998-05-20").collect()}
    orders = sales._month_orders(spark, sf, "1998-05-20").collect()
    assert keep <= {(r.order_id, r.plan) for r in orders}


def test_sale_day_formulas(spark):
    rows = [("widget a", "X", dt.date(2016, 1, d), 100.0, amount) for d, amount in ((14, 1), (15, 300), (16, 420), (17, 1))]
    rows += [("hot ring", "X", dt.date(2016, 1, 29), 1.0, 10), ("hot ring", None, dt.date(2016, 1, 30), 1.0, 5), ("hot ring", "X", dt.date(2016, 1, 31), 1.0, 7)]
    o = spark.createDataFrame([(*r[:4], Decimal(r[4])) for r in rows], "plan string, city string, placed_date date, cost double, amount_in_inr decimal(18,2)")
    r = sales.sale_day_discount(o, "2016-01-14", "2016-01-16").collect()
    assert [(x.city, x.slots, x.mean_cost_x6, x.mean_revenue, x.mean_discount) for x in r] == [("X", 2, 600.0, 360.0, 0.4)]
    r = sales.sale_day_plan_revenue(o, "2016-01-29", "2016-01-30").collect()
    assert [(x.plan, x.orders, x.revenue) for x in r] == [("hot ring", 2, 15.0)]


def test_sale_day_means_leave_out_missing_values(spark):
    d, amount = dt.date(2016, 1, 15), Decimal
    rows = [("widget", "X", d, 100.0, amount(300)), ("widget", "X", d, None, amount(500)), ("widget", "X", d, 200.0, None),
            ("widget", "Y", d, None, amount(9)), ("widget", None, d, 5.0, amount(5)), ("widget", "Z", d, 1.0, amount(1)),
            ("hot widget", "X", dt.date(2016, 2, 1), 1.0, None), ("Hot Shot", "X", dt.date(2016, 2, 1), 1.0, amount(4)),
            ("hot skip", "X", dt.date(2016, 2, 1), 1.0, amount(4))]
    o = spark.createDataFrame(rows, "plan string, city string, placed_date date, cost double, amount_in_inr decimal(18,2)")
    r = sales.sale_day_discount(o, "2016-01-14", "2016-01-16", left_out="Z").sort("city").collect()
    assert [(x.city, x.slots, x.mean_cost_x6, x.mean_revenue) for x in r] == [("X", 3, 900.0, 400.0), ("Y", 1, None, 9.0)]
    assert r[0].mean_discount == pytest.approx(5 / 9) and r[1].mean_discount is None
    r = sales.sale_day_plan_revenue(o, "2016-02-01", "2016-02-01", left_out="hot skip").sort("plan").collect()
    assert [(x.plan, x.orders, x.revenue) for x in r] == [("Hot Shot", 1, 4.0), ("hot widget", 1, None)]


def test_the_sheet_reads_the_month_once(spark):
    """The (rep, currency) counters and the roster are materialised: the
    sheet's own plan reads no table, and has few shuffles."""
    sheet = sales.q_metrics_sheet(spark, "/root/testdata/sf0.001")
    sheet.collect()
    plan = sheet._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert "FileScan" not in plan and plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") <= 9
