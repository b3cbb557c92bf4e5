"""Ad-slot inventory reports.

* ``renewal_label`` / ``renewal_label_shared`` / ``slot_inventory``: sold ad
  slots with renewals removed (a renewal is an order placed while the
  previous subscription of the same practice and ad code was running).
* ``active_as_of`` / ``available_inventory``: plans still free on a date,
  i.e. not held by any subscription active on that date (SQL ``NOT IN``).
* ``ad_catalog``: the sellable catalogue (plan x city x zone x keyword).
* ``first_slot_city``: first-match city lookup per order.
* ``orders_two_roles``: the same dimension joined under two roles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.operators import (active_as_of as _active, label_renewals, lookup_first, not_in,
                                 not_in_literals, share_label)
from fieldlens.operators.intervals import RenewalRule, label_increment, renewal_state
from fieldlens.plans import standins as S
from fieldlens.session import materialised
from fieldlens.sinks.writers import finished_versions, update_version
from fieldlens.sources.tables import read_table

LABEL_COLS = ["order_id", "line_no", "part_id", "supp_id", "practice_id", "ad_code", "order_date",
              "start_date", "end_date"]


def renewal_label(spark: SparkSession, sf: str) -> DataFrame:
    s = S.slots(spark, sf)
    lab = label_renewals(s, ["practice_id", "ad_code"], "start_date", "order_ts", "end_date",
                         S.SLOT_TIEBREAK, code_col="ad_code")
    return lab.select(*LABEL_COLS, "label")


def renewal_label_shared(spark: SparkSession, sf: str) -> DataFrame:
    # exactly the columns the labeller reads
    s = S.slots(spark, sf).select(*S.SLOT_TIEBREAK, "practice_id", "ad_code", "order_ts", "start_date", "end_date")
    lab = label_renewals(s, ["practice_id", "ad_code"], "start_date", "order_ts", "end_date",
                         S.SLOT_TIEBREAK, code_col="ad_code")
    sh = share_label(lab, ["practice_id", "ad_code"], "order_ts", "start_date", S.SLOT_TIEBREAK)
    return sh.withColumn("order_date", F.to_date("order_ts")).select(*LABEL_COLS, "label", "shared_label")


#: the stand-ins' renewal rule
SLOT_RULE = RenewalRule(("practice_id", "ad_code"), "start_date", "order_ts", "end_date", tuple(S.SLOT_TIEBREAK), "ad_code")


def update_renewals(spark: SparkSession, base: str, new: DataFrame, rule: RenewalRule = SLOT_RULE) -> str:
    """Label a day's new slots and publish them as the next version below
    ``base``: the rows labelled in this run (``kind = 'label'``) and the state
    for the next one (``kind = 'state'``).  Of two runs on one version one
    raises ``VersionConflict``."""
    new = materialised(new)  # the source is read once
    columns = new.columns

    def change(before: DataFrame | None) -> DataFrame:
        if before is None:
            labels, state = rule.label(new), renewal_state(new, rule)
        else:
            kept = before.where("kind = 'state'").select(*rule.columns, "latest_order")
            labels, state = label_increment(new, kept, renewals_so_far(spark, base, rule).select(*columns), rule)
        return labels.withColumn("kind", F.lit("label")).unionByName(state.withColumn("kind", F.lit("state")), allowMissingColumns=True)

    return update_version(spark, base, change)


def renewals_so_far(spark: SparkSession, base: str, rule: RenewalRule = SLOT_RULE) -> DataFrame:
    """All labelled slots of the published versions: a row's group takes its
    rows from the run that labelled them last."""
    runs = finished_versions(spark, base)
    paths = [f"{base.rstrip('/')}/v={n}" for n in runs]
    rows = spark.read.option("basePath", base).parquet(*paths).where("kind = 'label'").drop("kind", "latest_order")
    # a row is known by its group and its place in it
    place = [*rule.group_cols, rule.start, rule.order_ts, *rule.tiebreak]
    last = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in dict.fromkeys(place)]).agg(F.max("v").alias("_v"))
    same = F.col("v") == F.col("_v")
    for c in dict.fromkeys(place):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(last, same, "left_semi").drop("v")


def kept_slots(slots: DataFrame) -> DataFrame:
    """Slots whose shared label is not a renewal."""
    lab = label_renewals(slots, ["practice_id", "ad_code"], "start_date", "order_ts", "end_date",
                         S.SLOT_TIEBREAK, code_col="ad_code")
    return share_label(lab, ["practice_id", "ad_code"], "order_ts", "start_date", S.SLOT_TIEBREAK).where(
        F.col("shared_label") != "R")


def slot_inventory_from(slots: DataFrame, orders: DataFrame, places: DataFrame) -> DataFrame:
    """Kept slots of a month's orders: renewals are judged on all live slots,
    then the month's order lines are merged in and slots without a keyword
    go."""
    mine = kept_slots(slots).where(F.col("keyword").isNotNull()).select(
        *S.SLOT_TIEBREAK, "duration_months", "keyword")
    sold = mine.join(orders.select(*S.SLOT_TIEBREAK, "plan", "cost", "claimed_email", "amount_in_inr"), S.SLOT_TIEBREAK)
    return sold.join(places, sold.supp_id == places.place_supp_id, "left").select(
        "order_id", "duration_months", "plan", "cost", "claimed_email", "keyword", "zone", "city", "amount_in_inr")


def slot_inventory(spark: SparkSession, sf: str, as_of: str = S.AS_OF) -> DataFrame:
    from fieldlens.plans import sales
    slots, places = sales.live_slots(S.slots(spark, sf)), S.slot_places(spark, sf)
    orders = sales.month_orders(sales.clean_orders(S.plan_orders(spark, sf)), slots, places, as_of)
    return slot_inventory_from(slots, orders, places)


def active_as_of(spark: SparkSession, sf: str, as_of: str = S.AS_OF) -> DataFrame:
    return (_active(S.slots(spark, sf), as_of)
            .select("order_id", "line_no", "part_id", "ad_code", "start_date", "duration_days"))


# Cities that are not sold, and the price from which a plan can
# be bought.
UNSOLD_CITIES, BUYABLE_FROM = [3, 77, 777], 905


def available_inventory_from(plans: DataFrame, zone_plans: DataFrame, zones: DataFrame, cities: DataFrame,
                             keywords: DataFrame, held_codes: DataFrame, unsold: list[int]) -> DataFrame:
    """Buyable plans of sold cities without a category whose ad code is NOT IN
    the held ones (a missing code is only free if nothing is held, and nothing
    is free if a held code is missing), in the order of the report."""
    j = (plans.where(F.col("buyable") == 1).join(zone_plans.where(F.col("category").isNull()), "plan_id")
              .join(zones.where(not_in_literals(F.col("city_id"), unsold)), "zone_id")
              .join(cities, "city_id").join(keywords, "keyword_id"))
    free = not_in(j, "ad_code", held_codes, "ad_code")
    return free.select(F.col("plan_id").alias("plan"), F.lower("city_name").alias("city"), F.lower("zone_name").alias("zone"),
                       F.lower("keyword_name").alias("keyword"), "cost").distinct().orderBy("city", "zone", "keyword", "cost", "plan")


def available_inventory(spark: SparkSession, sf: str, as_of: str = S.AS_OF) -> DataFrame:
    p = read_table(spark, sf, "part", ["p_partkey", "p_brand", "p_size", "p_retailprice"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf, "region", ["r_regionkey", "r_name"])
    code = F.when(F.col("p_size") <= 45, F.concat(F.lit("A"), F.col("p_partkey").cast("string")))
    plans = p.select(F.col("p_partkey").alias("plan_id"), F.col("p_retailprice").alias("cost"),
                     F.when(F.col("p_retailprice") >= BUYABLE_FROM, 1).otherwise(0).alias("buyable"))
    zone_plans = p.select(F.col("p_partkey").alias("plan_id"), (F.col("p_partkey") % 25).cast("int").alias("zone_id"),
                          F.col("p_brand").alias("keyword_id"), code.alias("ad_code"),
                          F.when(F.col("p_size") == 44, "bundle").alias("category"))
    zones = n.select(F.col("n_nationkey").alias("zone_id"), F.col("n_name").alias("zone_name"), F.col("n_regionkey").alias("city_id"))
    cities = r.select(F.col("r_regionkey").alias("city_id"), F.col("r_name").alias("city_name"))
    keywords = p.select(F.col("p_brand").alias("keyword_id"), F.col("p_brand").alias("keyword_name")).distinct()
    # only the held plans' keys and terms are read from the order lines
    li = read_table(spark, sf, "lineitem", ["l_partkey", "l_quantity", "l_shipdate", "l_returnflag"])
    terms = li.where(F.col("l_returnflag") != "R").select(
        "l_partkey", F.col("l_shipdate").cast("date").alias("start_date"), (F.col("l_quantity").cast("int") * 7).alias("duration_days"))
    held = _active(terms, as_of, revoked=None).select("l_partkey").distinct()
    held_codes = held.join(p.where(F.col("p_size") <= 45), held.l_partkey == p.p_partkey).select(code.alias("ad_code"))
    return available_inventory_from(plans, zone_plans, zones, cities, keywords, held_codes, UNSOLD_CITIES)


def ad_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Five-way inner join, distinct, lower-cased names."""
    p = read_table(spark, sf, "part", ["p_partkey", "p_type", "p_retailprice"])
    li = read_table(spark, sf, "lineitem", ["l_partkey", "l_suppkey"])
    s = read_table(spark, sf, "supplier", ["s_suppkey", "s_nationkey"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf, "region", ["r_regionkey", "r_name"])
    j = (p.join(li, p.p_partkey == li.l_partkey).join(s, li.l_suppkey == s.s_suppkey)
          .join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey))
    return j.select(F.col("p_partkey").alias("plan"), F.lower("n_name").alias("city"),
                    F.lower("r_name").alias("zone"), F.lower("p_type").alias("keyword"),
                    F.col("p_retailprice").alias("cost")).distinct()


def first_slot_city(spark: SparkSession, sf: str) -> DataFrame:
    """Each order's city = the city of its first slot line (by line, part,
    supplier); lines are reduced to that supplier before any dimension join."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    places = S.slot_places(spark, sf).select("place_supp_id", "city")
    first = lookup_first(o, li, "o_orderkey", "l_orderkey", ["l_suppkey"], ["l_linenumber", "l_partkey", "l_suppkey"])
    out = first.join(places, first.l_suppkey == places.place_supp_id, "left")
    return out.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("practice_id"), "city")


def orders_two_roles(spark: SparkSession, sf: str) -> DataFrame:
    """Nation joined twice: the customer's and the supplier's."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    s = read_table(spark, sf, "supplier", ["s_suppkey", "s_nationkey"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    cn, sn = n.alias("cn"), n.alias("sn")
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
           .join(s, li.l_suppkey == s.s_suppkey)
           .join(cn, F.col("c_nationkey") == F.col("cn.n_nationkey"), "left")
           .join(sn, F.col("s_nationkey") == F.col("sn.n_nationkey"), "left"))
    return j.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
                    F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supp_id"),
                    F.col("cn.n_name").alias("customer_nation"), F.col("sn.n_name").alias("supplier_nation"))
