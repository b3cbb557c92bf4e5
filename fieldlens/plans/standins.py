"""Stand-in views: the reference's domain mapped onto the driver's tables.

The reports were written against order, subscription, roster and
field-coverage tables that are not available here, so each report runs on a
fixed mapping of the TPC-H-like test tables.  The same mapping is written in
SQL in ``plans/oracle_views.py``; keep the two in step.

Fixed values (domain mapping, shared with the SQL oracle):

* slots: lineitem x orders x part.  order = l_orderkey, practice = o_custkey,
  ad code = p_type, order date = o_orderdate, start = l_shipdate,
  duration = int(l_quantity) * 7 days (in months of 28 days: whole ones), end =
  order date + duration, revoked = 1 when l_returnflag = 'R', processed and
  successful as for plan orders, service = 8 for p_size up to 40 else 9,
  keyword = p_brand; slots count for the reports if they are not revoked, the
  payment flags agree, the service is 8 and the order is not older than
  1992-06-01.  Tie-break: l_orderkey, l_linenumber,
  l_partkey, l_suppkey.
* plan orders: plan = p_name || ' ' || p_type; plan-class substrings
  software -> 'ring', listing -> 'widget', ship -> 'old', pro -> 'promo',
  tab -> 'hot', EMR -> 'd'; rep e-mail = lower(s_name), missing when
  l_linenumber = 7; amount = l_extendedprice; processed = (l_linestatus = 'F');
  successful = (l_returnflag <> 'N'); currency = 'USD' when l_tax = 0 else
  'INR'; master plan = 'Addon' when p_size > 45 else 'Base'.
* roster: one rep per supplier; Role H for even s_suppkey else U; Exp 'new'
  when s_suppkey % 3 = 0 else 'exp'; Target = s_suppkey % 7; managers
  AM = n_name, AAM = 'AAM' || n_nationkey % 10, AZM = r_name || n_nationkey % 2,
  ZM = r_name, RM = 'RM' || n_regionkey % 2, CM = 'ALL'.
* establishments: customer (deleted when c_acctbal < 0); segment rows =
  its orders with segment = first digit of o_orderpriority and visit status
  'PC' for o_orderstatus 'F', 'WIP' for 'O', missing for 'P'; establishment
  visit status by c_mktsegment: BUILDING 'PC', MACHINERY 'NI',
  FURNITURE 'NF', HOUSEHOLD 'XX', others missing; city = nation (module and
  city ids = n_nationkey, country id = n_regionkey); locality = supplier
  (city id = s_nationkey); a practice's
  sales locality = c_custkey / 15 (whole part; there are as many localities
  per practice at every size).  A locality with an odd key has a territory,
  its nation; the territories of nations 3, 10, 17 and 24 are deleted; a
  region's owner is its first supplier with a balance.
* sellable ads: one per part; ad code = 'A' || p_partkey, missing for p_size
  over 45 (plans of another type); zone = nation p_partkey % 25, city = its
  region; keyword = p_brand; buyable if p_retailprice is 905 or more; category
  'bundle' for p_size 44, else missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.sources.tables import read_table

# Plan-class substrings of the stand-in plan names.
PLAN_CLASSES = {"software": "ring", "listing": "widget", "ship": "old", "pro": "promo", "tab": "hot", "emr": "d"}
# Segment-visit status codes counted as coverage.
COVERAGE_CODES = ["PC", "NI", "WIP", "NF"]
PLATINUM_CODE = "PC"
PRACTICES_PER_LOCALITY = 15
AS_OF = "1998-06-03"
# Which slots the reports count.
SLOTS_SINCE, SLOT_SERVICE = "1992-06-01", 8
SLOT_TIEBREAK = ["order_id", "line_no", "part_id", "supp_id"]


def _t(spark, sf, name, cols):
    return read_table(spark, sf, name, cols)


def slots(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                    "l_quantity", "l_shipdate", "l_returnflag", "l_linestatus"])
    o = _t(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    p = _t(spark, sf, "part", ["p_partkey", "p_type", "p_size", "p_brand"])
    dur = F.col("l_quantity").cast("int") * F.lit(7)
    return (li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
              .select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
                      F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supp_id"),
                      F.col("o_custkey").alias("practice_id"), F.col("p_type").alias("ad_code"),
                      F.col("o_orderdate").alias("order_ts"),
                      F.col("o_orderdate").cast("date").alias("order_date"),
                      F.col("l_shipdate").cast("date").alias("start_date"),
                      dur.alias("duration_days"),
                      F.date_add(F.col("o_orderdate").cast("date"), dur).alias("end_date"),
                      F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("revoked"),
                      F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("processed"),
                      F.when(F.col("l_returnflag") != "N", 1).otherwise(0).alias("successful"),
                      F.when(F.col("p_size") <= 40, 8).otherwise(9).alias("service_id"),
                      F.col("p_brand").alias("keyword"),
                      F.floor(dur / 28).cast("int").alias("duration_months")))


def slot_places(spark: SparkSession, sf: str) -> DataFrame:
    """City and zone of a slot's supplier."""
    sup = _t(spark, sf, "supplier", ["s_suppkey", "s_nationkey"])
    g = _geo(spark, sf)
    return sup.join(g, sup.s_nationkey == g.n_nationkey).select(
        F.col("s_suppkey").alias("place_supp_id"), F.col("r_name").alias("zone"), F.col("n_name").alias("city"))


def plan_orders(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                                    "l_discount", "l_tax", "l_returnflag", "l_linestatus"])
    o = _t(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    p = _t(spark, sf, "part", ["p_partkey", "p_name", "p_type", "p_size", "p_retailprice"])
    s = _t(spark, sf, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    n = _t(spark, sf, "nation", ["n_nationkey", "n_name"])
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
           .join(s, li.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey))
    return j.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supp_id"),
        F.col("o_custkey").alias("practice_id"),
        F.concat_ws(" ", "p_name", "p_type").alias("plan"),
        F.col("p_retailprice").alias("cost"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.col("l_discount").alias("discount"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string")).otherwise(F.lower("s_name")).alias("claimed_email"),
        F.col("o_orderdate").cast("date").alias("placed_date"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("processed"),
        F.when(F.col("l_returnflag") != "N", 1).otherwise(0).alias("successful"),
        F.when(F.col("l_tax") == 0, "USD").otherwise("INR").alias("currency"),
        F.when(F.col("p_size") > 45, "Addon").otherwise("Base").alias("master_plan"),
        F.col("n_name").alias("city"),
    )


# Manager levels (level name, roster column) in rollup order.
MANAGER_LEVELS = [("AM", "am_email"), ("AAM", "aam"), ("AZM", "azm"), ("Zone", "zm"), ("Region", "rm"), ("Country", "cm")]


def _geo(spark, sf):
    n = _t(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = _t(spark, sf, "region", ["r_regionkey", "r_name"])
    return n.join(r, n.n_regionkey == r.r_regionkey)


def _manager_cols():
    return {
        "am": F.col("n_name"),
        "aam": F.concat(F.lit("AAM"), (F.col("n_nationkey") % 10).cast("string")),
        "azm": F.concat(F.col("r_name"), (F.col("n_nationkey") % 2).cast("string")),
        "zm": F.col("r_name"),
        "rm": F.concat(F.lit("RM"), (F.col("n_regionkey") % 2).cast("string")),
        "cm": F.lit("ALL"),
    }


def roster_reps(spark: SparkSession, sf: str) -> DataFrame:
    """Rep (TM) rows of the team roster, as exported (not yet lower-cased)."""
    s = _t(spark, sf, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    g = _geo(spark, sf)
    m = _manager_cols()
    return s.join(g, s.s_nationkey == g.n_nationkey).select(
        F.col("s_name").alias("email"), F.col("s_name").alias("name"), F.col("r_name").alias("region"),
        m["zm"].alias("zone"), F.col("n_name").alias("city"), m["cm"].alias("cm"), m["rm"].alias("rm"),
        m["zm"].alias("zm"), m["azm"].alias("azm"), m["am"].alias("am_email"), m["am"].alias("am_name"),
        m["aam"].alias("aam"),
        F.when(F.col("s_suppkey") % 3 == 0, "new").otherwise("exp").alias("exp"),
        F.lit("TM").alias("level"),
        F.when(F.col("s_suppkey") % 2 == 0, "H").otherwise("U").alias("role"),
        (F.col("s_suppkey") % 7).cast("int").alias("target"))


def roster_managers(spark: SparkSession, sf: str) -> DataFrame:
    """Manager rows: one per distinct value of each manager column over all nations."""
    g = _geo(spark, sf)
    m = _manager_cols()
    per_level = F.explode(F.array(*[F.struct(F.lit(lvl).alias("level"), m[col.split("_")[0]].alias("key"))
                                    for lvl, col in MANAGER_LEVELS]))
    keys = g.select(per_level.alias("x")).select("x.level", "x.key").distinct()
    nul = F.lit(None).cast("string")
    return keys.select(
        F.col("key").alias("email"), F.col("key").alias("name"), nul.alias("region"), nul.alias("zone"),
        nul.alias("city"), nul.alias("cm"), nul.alias("rm"), nul.alias("zm"), nul.alias("azm"),
        nul.alias("am_email"), nul.alias("am_name"), nul.alias("aam"), nul.alias("exp"), F.col("level"),
        nul.alias("role"), F.lit(None).cast("int").alias("target"))


def establishments(spark: SparkSession, sf: str) -> DataFrame:
    c = _t(spark, sf, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    status = (F.when(F.col("c_mktsegment") == "BUILDING", "PC").when(F.col("c_mktsegment") == "MACHINERY", "NI")
               .when(F.col("c_mktsegment") == "FURNITURE", "NF").when(F.col("c_mktsegment") == "HOUSEHOLD", "XX"))
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                    F.col("c_nationkey").alias("module_id"), F.col("c_acctbal").alias("balance"),
                    F.col("c_mktsegment").alias("software"), status.alias("visit_status"),
                    F.when(F.col("c_acctbal") < 0, F.lit("deleted")).alias("deleted_at"))


def segments(spark: SparkSession, sf: str) -> DataFrame:
    o = _t(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])
    return o.select(F.col("o_custkey").alias("establishment_id"), F.col("o_orderkey").alias("segment_row_id"),
                    F.substring("o_orderpriority", 1, 1).cast("int").alias("segment_id"),
                    F.when(F.col("o_orderstatus") == "F", "PC").when(F.col("o_orderstatus") == "O", "WIP").alias("visit_status"))


def cities(spark: SparkSession, sf: str) -> DataFrame:
    n = _t(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    return n.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
                    F.col("n_regionkey").alias("country_id"), F.col("n_regionkey").alias("state_id"))


def modules(spark: SparkSession, sf: str) -> DataFrame:
    n = _t(spark, sf, "nation", ["n_nationkey"])
    return n.select(F.col("n_nationkey").alias("id"), F.col("n_nationkey").alias("city_id"))


def localities(spark: SparkSession, sf: str) -> DataFrame:
    s = _t(spark, sf, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    return s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("city_id"))


def states(spark: SparkSession, sf: str) -> DataFrame:
    r = _t(spark, sf, "region", ["r_regionkey", "r_name"])
    return r.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))


def per_locality(key: str):
    """The locality (or practice) key of a customer: grows with the data."""
    return F.floor(F.col(key) / PRACTICES_PER_LOCALITY).cast("long")


def locality_territories(spark: SparkSession, sf: str) -> DataFrame:
    s = _t(spark, sf, "supplier", ["s_suppkey", "s_nationkey"])
    return s.where(F.col("s_suppkey") % 2 == 1).select(F.col("s_suppkey").alias("locality_id"), F.col("s_nationkey").alias("territory_id"))


def territories(spark: SparkSession, sf: str) -> DataFrame:
    n = _t(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    return n.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("parent_id"),
                    F.when(F.col("n_nationkey") % 7 == 3, F.lit("deleted")).alias("deleted_at"))


def territory_owners(spark: SparkSession, sf: str) -> DataFrame:
    s = _t(spark, sf, "supplier", ["s_suppkey", "s_nationkey", "s_acctbal"])
    return s.where(F.col("s_acctbal") >= 0).groupBy(F.col("s_nationkey").alias("region_id")).agg(F.min("s_suppkey").alias("user_id"))


def practices(spark: SparkSession, sf: str) -> DataFrame:
    c = _t(spark, sf, "customer", ["c_custkey", "c_name"])
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                    per_locality("c_custkey").alias("sales_localities_id"))
