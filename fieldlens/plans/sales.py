"""Sales dashboard: order cleanup, roster, rep scorecard, leadership rollup, metrics sheet.

DataFrame-level functions (``clean_orders``, ``rep_scorecard``, ...) take
any order / roster frames with the stand-in column names; the ``q_*``
wrappers bind them to the test tables for the query registry.

Money is carried as ``decimal(18,2)`` and summed exactly; units, targets
achieved and other ratios are one double operation on those exact sums
(so a manager's ratio is recomputed from summed parts, never averaged, and
the value does not depend on summation order or partitioning).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions import (contains_ci, flags_agree, month_label, month_name_label, not_contains_ci,
                                 period_end, period_start, r_paste0, role_gate, safe_ratio, window_start)
from fieldlens.functions.dates import compact_date
from fieldlens.operators import global_row_number, level_rollup, lookup_first, rank_by_mapping
from fieldlens.plans import standins as S
from fieldlens.session import materialised

# Fixed value: revenue per unit.
UNIT_PRICE = 12000
# Roster level -> sort rank.
LEVEL_RANK = {"Country": "A", "Region": "B", "Zone": "C", "AZM": "D", "AM": "E", "AAM": "F", "TM": "G"}
SENTINEL_EMAIL = "zz"
NO_ZONE = "-"

MEASURES = ["orders_h", "revenue", "units_h", "targets_h", "targ_ach_h", "arpu", "aupw_exp_h", "aupw_new_h",
            "units_u", "revenue_u", "targets_u", "targ_ach_u", "aupw_exp_u", "aupw_new_u", "units_n",
            "revenue_n", "targets_n", "targ_ach_n", "orders_n", "starter_n", "pro_n", "tab_n", "emr_n",
            "listing_n", "listing_revenue", "avg_slot_price"]
COUNT_MEASURES = {"orders_h", "orders_n", "starter_n", "pro_n", "tab_n", "emr_n", "listing_n"}
ROSTER_KEYS = ["email", "name", "region", "zone", "city", "cm", "rm", "zm", "azm", "am_email", "am_name",
               "aam", "exp", "level", "role"]
LOWERED = ["email", "cm", "rm", "zm", "azm", "am_email", "aam", "exp"]


# --------------------------------------------------------------------- orders
def clean_orders(po: DataFrame, classes: dict = S.PLAN_CLASSES, currency: str = "INR",
                 excluded_master: str = "Addon") -> DataFrame:
    """Drop shipping plans (missing plan kept), disagreeing payment flags,
    other currencies and add-on plans; revenue becomes ``amount_in_inr``."""
    return (po.where(not_contains_ci(F.col("plan"), classes["ship"]))
              .where(flags_agree(F.col("processed"), F.col("successful")))
              .where(F.col("currency") == currency)
              .where(F.col("master_plan") != excluded_master)
              .select("order_id", "line_no", "part_id", "supp_id", "practice_id", "plan", "cost",
                      "claimed_email", "placed_date", "currency", "city", "discount",
                      F.col("amount").alias("amount_in_inr")))


def in_period(df: DataFrame, as_of: str, col: str = "placed_date", three_months: bool = False) -> DataFrame:
    start = window_start(as_of) if three_months else period_start(as_of)
    return df.where(F.col(col).between(start, period_end(as_of)))


def live_slots(slots: DataFrame, since: str = S.SLOTS_SINCE, service: int = S.SLOT_SERVICE) -> DataFrame:
    """Slots that count: not revoked, payment flags agree, the ad service,
    ordered on or after ``since``."""
    return slots.where((F.col("revoked") == 0) & flags_agree(F.col("processed"), F.col("successful"))
                       & (F.col("service_id") == service) & (F.col("order_date") >= F.lit(since).cast("date")))


def backfill_city(orders: DataFrame, slots: DataFrame, places: DataFrame, classes: dict = S.PLAN_CLASSES) -> DataFrame:
    """Orders with the city of their first live slot that has a keyword (by
    line, part, supplier); listing orders without a city are dropped, other
    orders are kept with or without one.  Slots are reduced to one supplier
    per order before its city is looked up."""
    first = slots.where(F.col("keyword").isNotNull()).select(
        F.col("order_id").alias("slot_order_id"), F.col("line_no").alias("slot_line"), F.col("part_id").alias("slot_part"),
        F.col("supp_id").alias("slot_supp"))
    found = lookup_first(orders.drop("city"), first, "order_id", "slot_order_id", ["slot_supp"],
                         ["slot_line", "slot_part", "slot_supp"])
    city = places.select("place_supp_id", "city")
    placed = found.join(city, found.slot_supp == city.place_supp_id, "left").drop("slot_supp", "place_supp_id")
    listing = F.coalesce(class_flags(F.col("plan"), classes)["is_listing"], F.lit(False))
    return placed.where(~listing | F.col("city").isNotNull())


def month_orders(orders: DataFrame, slots: DataFrame, places: DataFrame, as_of: str) -> DataFrame:
    """The report month's cleaned orders with their city: what the scorecard,
    the rollup, the sheet, the inventory and the published month file use.  A
    slot has its order's date, so only the month's slots are looked at."""
    return backfill_city(in_period(orders, as_of), in_period(slots, as_of, "order_date"), places)


def class_flags(plan: Column, classes: dict = S.PLAN_CLASSES) -> dict[str, Column]:
    soft, lst = contains_ci(plan, classes["software"]), contains_ci(plan, classes["listing"])
    pro = contains_ci(plan, classes["pro"])
    return {
        "is_software": soft, "is_listing": lst, "is_ship": contains_ci(plan, classes["ship"]), "is_pro": pro,
        "is_tab": soft & contains_ci(plan, classes["tab"]), "is_emr": soft & contains_ci(plan, classes["emr"]),
        "is_starter": soft & ~pro,
    }


def sales_plans(orders: DataFrame, classes: dict = S.PLAN_CLASSES) -> DataFrame:
    f = class_flags(F.col("plan"), classes)
    return orders.where(f["is_software"] | f["is_listing"])


def rep_currency_stats(orders: DataFrame, classes: dict = S.PLAN_CLASSES, sales_only: bool = True) -> DataFrame:
    """One pass over the sales-plan orders: every per-rep counter and revenue,
    per (rep, currency), missing rep kept, with map-side combine.  The
    scorecard counters and the sheet-wide scalars are derived from this one
    definition.  (Spark prunes the aggregate differently for each consumer,
    so the consumers do not share one shuffle; each is still a single
    partial-aggregate pass.)"""
    f = class_flags(F.col("plan"), classes)
    amt = F.col("amount_in_inr")
    src = sales_plans(orders, classes) if sales_only else orders
    return src.groupBy("claimed_email", "currency").agg(
        F.count(F.lit(1)).alias("orders_n"),
        F.sum(amt).alias("rev"),
        F.count_if(f["is_starter"]).alias("starter_n"),
        F.count_if(f["is_pro"]).alias("pro_n"),
        F.count_if(f["is_tab"]).alias("tab_n"),
        F.count_if(f["is_emr"]).alias("emr_n"),
        F.count_if(f["is_listing"]).alias("listing_n"),
        F.sum(F.when(f["is_listing"], amt)).alias("listing_rev"),
    )


_COUNTERS = ["orders_n", "starter_n", "pro_n", "tab_n", "emr_n", "listing_n"]


def rep_stats_from(rcs: DataFrame, keep_null_rep: bool = False) -> DataFrame:
    src = rcs if keep_null_rep else rcs.where(F.col("claimed_email").isNotNull())
    z = F.lit(0).cast("decimal(18,2)")
    return src.groupBy("claimed_email").agg(
        *[F.sum(c).alias(c) for c in _COUNTERS[:1]],
        F.coalesce(F.sum("rev"), z).cast("decimal(28,2)").alias("rev"),
        *[F.sum(c).alias(c) for c in _COUNTERS[1:]],
        F.coalesce(F.sum("listing_rev"), z).cast("decimal(28,2)").alias("listing_rev"))


def rep_order_stats(orders: DataFrame, classes: dict = S.PLAN_CLASSES, keep_null_rep: bool = False) -> DataFrame:
    """Per-rep counts and revenue (one pass; see ``rep_currency_stats``)."""
    return rep_stats_from(rep_currency_stats(orders, classes), keep_null_rep)


# --------------------------------------------------------------------- roster
def roster_union(managers: DataFrame, reps: DataFrame) -> DataFrame:
    """Head file plus every zone's file, by column name; placeholder e-mails
    removed, reps of the no-zone marker left out (that zone has no file),
    missing target 0, target split by role."""
    reps = reps.where(F.coalesce(F.col("zone") != NO_ZONE, F.lit(True)))
    allr = managers.unionByName(reps, allowMissingColumns=True)
    allr = allr.where(F.coalesce(F.col("email") != SENTINEL_EMAIL, F.lit(True)))
    tgt = F.coalesce(F.col("target"), F.lit(0))
    return (allr.withColumn("target", tgt)
                .withColumn("targets_h", role_gate(tgt, F.col("role"), "H"))
                .withColumn("targets_u", role_gate(tgt, F.col("role"), "U")))


def next_roster(previous: DataFrame | None, managers: DataFrame, reps: DataFrame, new_zones: tuple[str, ...] = ()) -> DataFrame:
    """The roster that follows the published one: its zones (and any new
    ones) decide which zones' files are taken; without a published roster all
    are.  Sorted and numbered."""
    if previous is not None:
        zones = previous.select("zone").union(reps.sparkSession.createDataFrame([(z,) for z in new_zones], "zone string")).distinct()
        reps = reps.join(zones, "zone", "left_semi")
    return roster_sorted(roster_union(managers, reps))


def roster_sorted(roster: DataFrame) -> DataFrame:
    """Sort by level rank then region, zone, AM, role, exp, target (missing
    last), e-mail as final tie-break, and number the rows."""
    return global_row_number(roster, roster_order_key(), out="row")


# Sort keys of the sheet that lower-casing would change, kept as exported.
AS_EXPORTED = {"am_email": "o_am_email", "exp": "o_exp", "email": "o_email"}
SORT_KEYS = [*AS_EXPORTED.values(), "target"]


def lower_roster(roster: DataFrame) -> DataFrame:
    return roster.select(*[F.lower(F.col(c)).alias(c) if c in LOWERED else F.col(c) for c in roster.columns],
                         *[F.col(c).alias(o) for c, o in AS_EXPORTED.items()])


def _carried(df: DataFrame) -> list[str]:
    """The sort keys that ride along from the roster to the sheet."""
    return [c for c in SORT_KEYS if c in df.columns]


# ------------------------------------------------------------------ scorecard
def _dbl(c: Column) -> Column:
    return c.cast("double")


def rep_scorecard(orders: DataFrame | None, reps: DataFrame, classes: dict = S.PLAN_CLASSES,
                  unit: int = UNIT_PRICE, exact: bool = False, stats: DataFrame | None = None) -> DataFrame:
    """26 measures per rep (rep rows of a lower-cased roster).

    ``exact=True`` also returns the exact decimal revenue split by role
    (``rev_h``, ``rev_u``, ``rev``, ``listing_rev``) for the rollup."""
    stats = stats if stats is not None else rep_order_stats(orders, classes)
    r = reps.join(stats, reps.email == stats.claimed_email, "left").drop("claimed_email")
    z = F.lit(0).cast("decimal(18,2)")
    rev = F.coalesce(F.col("rev"), z)
    role, exp = F.col("role"), F.col("exp")
    rev_h = F.when(role == "H", rev).otherwise(z)
    rev_u = F.when(role == "U", rev).otherwise(z)
    tgt = F.coalesce(F.col("target"), F.lit(0)).cast("double")
    units_h, units_u = _dbl(rev_h) / unit, _dbl(rev_u) / unit
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    orders_h = F.when(role == "H", n("orders_n")).otherwise(F.lit(0).cast("long"))
    targets_h = F.when(role == "H", tgt).otherwise(F.lit(0.0))
    targets_u = F.when(role == "U", tgt).otherwise(F.lit(0.0))
    listing_rev = F.coalesce(F.col("listing_rev"), z)
    m = {
        "orders_h": orders_h,
        "revenue": _dbl(rev),
        "units_h": units_h,
        "targets_h": targets_h,
        "targ_ach_h": safe_ratio(units_h, targets_h),
        "arpu": safe_ratio(units_h, orders_h, scale=1000),
        "aupw_exp_h": F.when(exp == "new", F.lit(0.0)).otherwise(units_h),
        "aupw_new_h": F.when(exp == "exp", F.lit(0.0)).otherwise(units_h),
        "units_u": units_u,
        "revenue_u": _dbl(rev_u),
        "targets_u": targets_u,
        "targ_ach_u": safe_ratio(units_u, targets_u),
        "aupw_exp_u": F.when(exp == "new", F.lit(0.0)).otherwise(units_u),
        "aupw_new_u": F.when(exp == "exp", F.lit(0.0)).otherwise(units_u),
        "units_n": _dbl(rev_h + rev_u) / unit,
        "revenue_n": _dbl(rev),
        "targets_n": targets_h + targets_u,
        # rep level uses revenue (not units) over targets, as the sheet does
        "targ_ach_n": safe_ratio(_dbl(rev), targets_h + targets_u),
        "orders_n": n("orders_n"), "starter_n": n("starter_n"), "pro_n": n("pro_n"), "tab_n": n("tab_n"),
        "emr_n": n("emr_n"), "listing_n": n("listing_n"),
        "listing_revenue": _dbl(listing_rev),
        "avg_slot_price": safe_ratio(_dbl(listing_rev), n("listing_n")),
    }
    cols = [F.col(c) for c in ROSTER_KEYS] + [
        m[k].alias(k) for k in MEASURES]
    if exact:
        cols += [F.col(c) for c in _carried(reps)]
        cols += [rev.alias("rev"), rev_h.alias("rev_h"), rev_u.alias("rev_u"), listing_rev.alias("listing_rev")]
    return r.select(*cols)


def leadership_rollup(card: DataFrame, managers: DataFrame, unit: int = UNIT_PRICE) -> DataFrame:
    """Sum the rep measures for each of the six manager levels in one
    grouping-sets pass, recompute the ratios from the sums, average the four
    AUPW measures over the matching (exp, role) reps, and attach the result
    to each level's own roster rows (missing -> 0)."""
    subsets = {"eh": ("exp", "H", "rev_h"), "nh": ("new", "H", "rev_h"),
               "eu": ("exp", "U", "rev_u"), "nu": ("new", "U", "rev_u")}
    extra = []
    for key, (e, r, rev_col) in subsets.items():
        cond = (F.col("exp") == e) & (F.col("role") == r)
        extra += [cond.cast("int").alias(f"_n_{key}"), F.when(cond, F.col(rev_col)).alias(f"_r_{key}")]
    base = card.select("*", *extra)   # one projection instead of a withColumn chain
    sums = ["orders_h", "targets_h", "targets_u", "targets_n", "orders_n", "starter_n", "pro_n", "tab_n",
            "emr_n", "listing_n", "rev", "rev_h", "rev_u", "listing_rev",
            "_n_eh", "_n_nh", "_n_eu", "_n_nu", "_r_eh", "_r_nh", "_r_eu", "_r_nu"]
    agg = level_rollup(base, S.MANAGER_LEVELS, sums, level_col="level", key_col="mgr")
    z = F.lit(0).cast("decimal(18,2)")
    rev, rev_h, rev_u = F.coalesce(F.col("rev"), z), F.coalesce(F.col("rev_h"), z), F.coalesce(F.col("rev_u"), z)
    units_h, units_u, units_n = _dbl(rev_h) / unit, _dbl(rev_u) / unit, _dbl(rev_h + rev_u) / unit
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    d = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")

    def mean_units(r, k):
        return safe_ratio(_dbl(F.col(r)) / unit, F.col(k), digits=None)
    listing_rev = F.coalesce(F.col("listing_rev"), z)
    m = {
        "orders_h": n("orders_h"), "revenue": _dbl(rev), "units_h": units_h, "targets_h": d("targets_h"),
        "targ_ach_h": safe_ratio(units_h, d("targets_h")),
        "arpu": safe_ratio(units_h, n("orders_h"), scale=1000),
        "aupw_exp_h": mean_units("_r_eh", "_n_eh"), "aupw_new_h": mean_units("_r_nh", "_n_nh"),
        "units_u": units_u, "revenue_u": _dbl(rev_u), "targets_u": d("targets_u"),
        "targ_ach_u": safe_ratio(units_u, d("targets_u")),
        "aupw_exp_u": mean_units("_r_eu", "_n_eu"), "aupw_new_u": mean_units("_r_nu", "_n_nu"),
        "units_n": units_n, "revenue_n": _dbl(rev), "targets_n": d("targets_n"),
        # manager level uses units over targets
        "targ_ach_n": safe_ratio(units_n, d("targets_n")),
        "orders_n": n("orders_n"), "starter_n": n("starter_n"), "pro_n": n("pro_n"), "tab_n": n("tab_n"),
        "emr_n": n("emr_n"), "listing_n": n("listing_n"), "listing_revenue": _dbl(listing_rev),
        "avg_slot_price": safe_ratio(_dbl(listing_rev), n("listing_n")),
    }
    measured = agg.select("level", "mgr", *[m[k].alias(k) for k in MEASURES])
    mgr_rows = managers.where(F.col("level") != "TM")
    j = mgr_rows.alias("m").join(measured.alias("a"), (F.col("m.level") == F.col("a.level")) &
                                 (F.col("m.email") == F.col("a.mgr")), "left")
    zero = lambda k: F.lit(0).cast("long") if k in COUNT_MEASURES else F.lit(0.0)
    return j.select(*[F.col(f"m.{c}").alias(c) for c in ROSTER_KEYS + _carried(managers)],
                    *[F.coalesce(F.col(f"a.{k}"), zero(k)).alias(k) for k in MEASURES])


# Published column names of the metrics sheet, in sheet order.
SHEET_NAMES = {
    "email": "PSW.Email", "name": "PSW.Name", "region": "Region", "zone": "Zone", "city": "City", "cm": "CM",
    "rm": "RM", "zm": "ZM", "azm": "AZM", "am_email": "AM.Email", "am_name": "AM.Name", "aam": "AAM",
    "exp": "Exp.", "level": "Level", "role": "Role", "orders_h": "Orders(H)", "revenue": "Revenue",
    "units_h": "UnitsH", "targets_h": "TargetsH", "targ_ach_h": "TargAchH", "arpu": "ARPU",
    "aupw_exp_h": "AUPWExpH", "aupw_new_h": "AUPWNewH", "units_u": "UnitsU", "revenue_u": "RevenueU",
    "targets_u": "TargetsU", "targ_ach_u": "TargAchU", "aupw_exp_u": "AUPWExpU", "aupw_new_u": "AUPWNewU",
    "units_n": "UnitsN", "revenue_n": "RevenueN", "targets_n": "TargetsN", "targ_ach_n": "TargAchN",
    "orders_n": "Orders(N)", "starter_n": "StarterN", "pro_n": "ProN", "tab_n": "TabN", "emr_n": "EMRN",
    "listing_n": "ReachN", "listing_revenue": "ReachRevenue", "avg_slot_price": "AvgSlotPrice",
}
SHEET_ORDER = ["PSW.Email", "PSW.Name", "Region", "Zone", "City", "CM", "RM", "ZM", "AZM", "AM.Email",
               "AM.Name", "AAM", "Exp.", "Level", "Role", "Gap1", "Orders(H)", "Revenue", "Gap2", "UnitsH",
               "TargetsH", "TargAchH", "ARPU", "AUPWExpH", "AUPWNewH", "Gap3", "UnitsU", "RevenueU",
               "TargetsU", "TargAchU", "AUPWExpU", "AUPWNewU", "Gap4", "UnitsN", "RevenueN", "TargetsN",
               "TargAchN", "Orders(N)", "StarterN", "ProN", "TabN", "EMRN", "ReachN", "ReachRevenue",
               "AvgSlotPrice", "TDRev", "Conc", "c", "d", "Gap5"]


def order_scalars(orders: DataFrame | None = None, rcs: DataFrame | None = None) -> DataFrame:
    """One row: ``c`` = revenue of the first currency (alphabetical) and
    ``d`` = share of orders with a claimed rep."""
    rcs = rcs if rcs is not None else rep_currency_stats(orders, sales_only=False)
    by_cur = rcs.groupBy("currency").agg(F.sum("rev").alias("_s"))
    c = by_cur.agg(F.min_by("_s", "currency").alias("_c"))
    d = rcs.agg(F.sum(F.when(F.col("claimed_email").isNotNull(), F.col("orders_n"))).alias("_k"),
                F.sum("orders_n").alias("_t"))
    return c.crossJoin(d).select(_dbl(F.col("_c")).alias("c"),
                                 safe_ratio(F.coalesce(F.col("_k"), F.lit(0)), F.col("_t")).alias("d"))


ROSTER_ORDER = ["region", "zone", "am_email", "role", "exp", "target", "email"]


def roster_order_key() -> list[Column]:
    """The roster sort: level rank, then region, zone, AM, role, exp, target,
    e-mail, each ascending with missing last (on the roster's own casing)."""
    return [rank_by_mapping(F.col("level"), LEVEL_RANK)] + [F.col(c) for c in ROSTER_ORDER]


def metrics_sheet(card: DataFrame, rollup: DataFrame, scalars: DataFrame) -> DataFrame:
    """All levels stacked, in roster order, with the fixed 50-column layout.

    Rows carry the roster's sort keys, so a person listed twice is two rows
    and nothing is joined back."""
    cols = ROSTER_KEYS + SORT_KEYS + MEASURES
    stacked = card.select(*cols).unionByName(rollup.select(*cols))
    s = stacked.crossJoin(F.broadcast(scalars))  # one row
    rank = rank_by_mapping(F.col("level"), LEVEL_RANK)
    order = [rank] + [F.col(AS_EXPORTED.get(c, c)) for c in ROSTER_ORDER]
    out = s.orderBy(*[c.asc_nulls_last() for c in order]).select(
        *[F.col(k).alias(v) for k, v in SHEET_NAMES.items()], "c", "d", F.lit(0.0).alias("TDRev"),
        r_paste0(F.col("email"), F.col("level")).alias("Conc"), *[F.lit(0).alias(f"Gap{i}") for i in range(1, 6)])
    return out.select(*[F.col(f"`{c}`") for c in SHEET_ORDER])


# ------------------------------------------------------------ query wrappers
def _cleaned(spark, sf):
    return clean_orders(S.plan_orders(spark, sf))


def _month_orders(spark, sf, as_of):
    return month_orders(_cleaned(spark, sf), live_slots(S.slots(spark, sf)), S.slot_places(spark, sf), as_of)


def _teams(spark, sf):
    return lower_roster(roster_union(S.roster_managers(spark, sf), S.roster_reps(spark, sf)))


def q_orders_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    return _cleaned(spark, sf).drop("currency", "city", "discount")


def q_orders_month_window(spark: SparkSession, sf: str, as_of: str = S.AS_OF) -> DataFrame:
    return in_period(_cleaned(spark, sf), as_of).drop("currency", "city", "discount")


def q_orders_three_month_window(spark: SparkSession, sf: str, as_of: str = S.AS_OF) -> DataFrame:
    return in_period(_cleaned(spark, sf), as_of, three_months=True).drop("currency", "city", "discount")


def q_reporting_period(spark: SparkSession, sf: str) -> DataFrame:
    """The report period for every distinct order date taken as the as-of date."""
    from fieldlens.sources.tables import read_table
    d = read_table(spark, sf, "orders", ["o_orderdate"]).select(F.col("o_orderdate").cast("date").alias("as_of")).distinct()
    ps = period_start(F.col("as_of"))
    return d.select("as_of", ps.alias("period_start"), window_start(F.col("as_of")).alias("window_start"),
                    F.last_day(ps).alias("period_end"), month_label(ps).alias("month_label"),
                    month_name_label(ps).alias("file_label"), compact_date(ps).alias("compact_start"))


def q_plan_class_flags(spark: SparkSession, sf: str) -> DataFrame:
    po = S.plan_orders(spark, sf)
    f = class_flags(F.col("plan"))
    return po.select("order_id", "line_no", "part_id", "supp_id", "plan",
                     *[f[k].alias(k) for k in ["is_software", "is_listing", "is_ship", "is_pro", "is_tab", "is_emr", "is_starter"]])


def q_plan_class_counts(spark: SparkSession, sf: str) -> DataFrame:
    st = rep_order_stats(_cleaned(spark, sf), keep_null_rep=True)
    return st.select("claimed_email", "orders_n", "starter_n", "pro_n", "tab_n", "emr_n", "listing_n",
                     _dbl(F.col("listing_rev")).alias("listing_revenue"))


def q_count_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """Row count per claimed rep, the missing rep being its own group."""
    return sales_plans(_cleaned(spark, sf)).groupBy("claimed_email").agg(F.count(F.lit(1)).alias("freq"))


def q_revenue_by_rep(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue per rep; rows with a missing rep or amount are left out."""
    o = sales_plans(_cleaned(spark, sf)).where(F.col("claimed_email").isNotNull() & F.col("amount_in_inr").isNotNull())
    return o.groupBy("claimed_email").agg(_dbl(F.sum("amount_in_inr")).alias("revenue"))


def q_role_gates(spark: SparkSession, sf: str) -> DataFrame:
    t = _teams(spark, sf)
    return t.select("email", "level", "role", "target", "targets_h", "targets_u")


def q_safe_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Units sold over target per rep, 0 where undefined."""
    t = _teams(spark, sf).where(F.col("level") == "TM")
    rv = q_revenue_by_rep(spark, sf)
    j = t.join(rv, t.email == rv.claimed_email, "left")
    units = F.coalesce(F.col("revenue"), F.lit(0.0)) / UNIT_PRICE
    return j.select("email", units.alias("units"), "target",
                    safe_ratio(units, F.col("target")).alias("units_per_target"))


def q_orders_month_published(spark: SparkSession, sf: str, as_of: str = S.AS_OF) -> DataFrame:
    """The published month file: the month's cleaned sales-plan orders with
    their city."""
    return sales_plans(_month_orders(spark, sf, as_of)).drop("currency", "discount")


def q_scorecard(spark: SparkSession, sf: str, as_of: str = S.AS_OF) -> DataFrame:
    t = _teams(spark, sf)
    return rep_scorecard(_month_orders(spark, sf, as_of), t.where(F.col("level") == "TM"))


def q_leadership_rollup(spark: SparkSession, sf: str, as_of: str = S.AS_OF) -> DataFrame:
    t = _teams(spark, sf)
    card = rep_scorecard(_month_orders(spark, sf, as_of), t.where(F.col("level") == "TM"), exact=True)
    return leadership_rollup(card, t).select("level", "email", *MEASURES)


def sheet_from(orders: DataFrame, managers: DataFrame, reps: DataFrame) -> DataFrame:
    """The metrics sheet of one month's orders and a roster.

    The (rep, currency) counters (a few rows a rep) and the roster are
    computed once; scorecard, rollup and scalars read those, so the month's
    order lines are scanned once."""
    t = materialised(lower_roster(roster_union(managers, reps)))
    rcs = materialised(rep_currency_stats(orders))
    card = rep_scorecard(None, t.where(F.col("level") == "TM"), exact=True, stats=rep_stats_from(rcs))
    return metrics_sheet(card, leadership_rollup(card, t), order_scalars(rcs=rcs))


def q_metrics_sheet(spark: SparkSession, sf: str, as_of: str = S.AS_OF) -> DataFrame:
    return sheet_from(_month_orders(spark, sf, as_of), S.roster_managers(spark, sf), S.roster_reps(spark, sf))


def q_attribution_share(spark: SparkSession, sf: str) -> DataFrame:
    po = S.plan_orders(spark, sf)
    a = po.agg(F.count("claimed_email").alias("claimed"), F.count(F.lit(1)).alias("total"))
    return a.select("claimed", "total", safe_ratio(F.col("claimed"), F.col("total")).alias("share"))


def q_team_roster_union(spark: SparkSession, sf: str) -> DataFrame:
    return roster_union(S.roster_managers(spark, sf), S.roster_reps(spark, sf))


def q_roster_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return roster_sorted(roster_union(S.roster_managers(spark, sf), S.roster_reps(spark, sf)))


SALE_DAY_AFTER, SALE_DAY_UNTIL, SALE_CITY_LEFT_OUT = "1998-05-31", "1998-06-14", "NATION_7"
TAB_DAY_FROM, TAB_DAY_UNTIL, TAB_PLAN_LEFT_OUT = "1998-06-01", "1998-06-20", "hot plate LARGE"


def sale_day_discount(orders: DataFrame, after: str, until: str, classes: dict = S.PLAN_CLASSES,
                      left_out: str | None = None) -> DataFrame:
    """Per city over the listing sale days (after, until]: slots sold, mean
    cost x 6, mean revenue, and the discount that the two means imply.

    A mean is over the rows that have a value (none: missing, and so is the
    discount); ``left_out`` names a city that is not reported, and neither is a
    missing one."""
    listing = class_flags(F.col("plan"), classes)["is_listing"]
    days = orders.where(listing & (F.col("placed_date") > F.lit(after).cast("date"))
                        & (F.col("placed_date") <= F.lit(until).cast("date")) & F.col("city").isNotNull())
    if left_out is not None:
        days = days.where(F.col("city") != left_out)
    # exact sums, one division: the same double on every engine and run
    def total(c: str) -> Column:
        return _dbl(F.sum(F.col(c).cast("decimal(18,2)")))
    per_city = days.groupBy("city").agg(
        F.count(F.lit(1)).alias("slots"),
        (total("cost") * 6 / F.nullif(F.count("cost"), F.lit(0))).alias("mean_cost_x6"),
        (total("amount_in_inr") / F.nullif(F.count("amount_in_inr"), F.lit(0))).alias("mean_revenue"))
    known = F.col("mean_cost_x6").isNotNull() & F.col("mean_revenue").isNotNull()
    discount = safe_ratio(F.col("mean_cost_x6") - F.col("mean_revenue"), F.col("mean_cost_x6"))
    return per_city.withColumn("mean_discount", F.when(known, discount))


def sale_day_plan_revenue(orders: DataFrame, first: str, last: str, classes: dict = S.PLAN_CLASSES,
                          left_out: str | None = None) -> DataFrame:
    """Per plan with the tab substring (software or not) over the sale days
    [first, last]: orders and revenue (missing if no order has an amount);
    ``left_out`` names a plan that is not reported."""
    days = orders.where(contains_ci(F.col("plan"), classes["tab"])
                        & F.col("placed_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    if left_out is not None:
        days = days.where(F.col("plan") != left_out)
    return days.groupBy("plan").agg(F.count(F.lit(1)).alias("orders"), _dbl(F.sum("amount_in_inr")).alias("revenue"))


def q_sale_day_discount(spark: SparkSession, sf: str, as_of: str = S.AS_OF) -> DataFrame:
    return sale_day_discount(_month_orders(spark, sf, as_of), SALE_DAY_AFTER, SALE_DAY_UNTIL, left_out=SALE_CITY_LEFT_OUT)


def q_sale_day_plan_revenue(spark: SparkSession, sf: str, as_of: str = S.AS_OF) -> DataFrame:
    return sale_day_plan_revenue(_month_orders(spark, sf, as_of), TAB_DAY_FROM, TAB_DAY_UNTIL, left_out=TAB_PLAN_LEFT_OUT)


def orders_with_contact(orders: DataFrame, contacts: DataFrame, since: str) -> DataFrame:
    """Orders placed since a date (before cleanup) with their practice's
    contact; ``contacts`` has one (practice_id, contact_name) a practice, an
    order without one keeps a missing name."""
    recent = orders.where(F.col("placed_date") >= F.lit(since).cast("date"))
    named = contacts.select(F.col("practice_id").alias("_practice"), "contact_name")
    return recent.join(named, recent.practice_id == F.col("_practice"), "left").select(
        "order_id", "line_no", "part_id", "supp_id", "practice_id", "plan", "placed_date", "contact_name")


def q_orders_with_contact(spark: SparkSession, sf: str, since: str = "1995-01-01") -> DataFrame:
    from fieldlens.sources.tables import read_table
    contacts = read_table(spark, sf, "customer", ["c_custkey", "c_name"]).toDF("practice_id", "contact_name")
    return orders_with_contact(S.plan_orders(spark, sf), contacts, since)


def q_orders_city_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """City back-fill over all cleaned orders (see ``backfill_city``)."""
    placed = backfill_city(_cleaned(spark, sf), live_slots(S.slots(spark, sf)), S.slot_places(spark, sf))
    return placed.select("order_id", "line_no", "part_id", "supp_id", "plan", "claimed_email", "city")


REVENUE_SINCE = "1998-01-01"


def q_rep_revenue_since(spark: SparkSession, sf: str, since: str = REVENUE_SINCE) -> DataFrame:
    """Revenue per rep over cleaned sales-plan orders placed on or after a date."""
    o = sales_plans(_cleaned(spark, sf)).where((F.col("placed_date") >= F.lit(since).cast("date"))
                                  & F.col("claimed_email").isNotNull())
    return o.groupBy("claimed_email").agg(_dbl(F.sum("amount_in_inr")).alias("revenue_since"))
