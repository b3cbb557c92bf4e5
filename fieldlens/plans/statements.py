"""Reports as SQL text over qualified table names.

``NAMES`` gives the stand-in tables the names that such text uses; the mapping
is that of ``plans/standins.py``.  Qualified and bare names mix: bare ones
belong to the database that the statement runs in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldlens.plans import standins as S
from fieldlens.sources.named import publish_names, run_statement

NAMES = {
    "fieldlens_geo.zone": "SELECT r_regionkey AS id, r_name AS name FROM {region}",
    "fieldlens_geo.city": "SELECT n_nationkey AS id, n_name AS name, n_regionkey AS zone_id FROM {nation}",
    "fieldlens_geo.locality": "SELECT s_suppkey AS id, s_name AS name, s_nationkey AS city_id FROM {supplier}",
    "fieldlens_ads.plan": "SELECT p_partkey AS id, p_type AS keyword, p_retailprice AS cost FROM {part}",
    "fieldlens_sales.practice": "SELECT c_custkey AS id, c_nationkey AS city_id FROM {customer}",
    "fieldlens_sales.purchase": "SELECT o_orderkey AS id, o_custkey AS practice_id FROM {orders}",
    "fieldlens_sales.slot": """
        SELECT l_orderkey AS purchase_id, l_linenumber AS line_no, l_partkey AS plan_id, l_suppkey AS locality_id,
               CAST(l_shipdate AS date) AS start_date, CAST(l_quantity AS int) * 7 AS duration_days,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS revoked
        FROM {lineitem}""",
}

#: what is on sale where: five tables, names of three databases
AD_CATALOG = """
SELECT DISTINCT p.id AS plan, lower(c.name) AS city, lower(z.name) AS zone, lower(p.keyword) AS keyword, p.cost
FROM fieldlens_ads.plan p
JOIN slot s ON s.plan_id = p.id
JOIN fieldlens_geo.locality l ON l.id = s.locality_id
JOIN fieldlens_geo.city c ON c.id = l.city_id
JOIN fieldlens_geo.zone z ON z.id = c.zone_id
"""

#: one dimension in two roles, both optional
TWO_ROLES = """
SELECT s.purchase_id AS order_id, s.line_no, s.plan_id AS part_id, s.locality_id AS supp_id,
       buyer.name AS customer_nation, seller.name AS supplier_nation
FROM slot s
JOIN purchase o ON o.id = s.purchase_id
JOIN fieldlens_sales.practice p ON p.id = o.practice_id
JOIN fieldlens_geo.locality l ON l.id = s.locality_id
LEFT JOIN fieldlens_geo.city buyer ON buyer.id = p.city_id
LEFT JOIN fieldlens_geo.city seller ON seller.id = l.city_id
"""

#: plans by city that run on a date, with the share of all slots that do
RUNNING_SLOTS = """
SELECT c.name AS city, count(*) AS slots,
       count(CASE WHEN s.revoked = 0 AND s.start_date <= :as_of AND datediff(:as_of, s.start_date) <= s.duration_days THEN 1 END) AS running,
       count(DISTINCT CASE WHEN s.revoked = 0 AND s.start_date <= :as_of AND datediff(:as_of, s.start_date) <= s.duration_days
                           THEN s.plan_id END) AS running_plans
FROM fieldlens_sales.slot s
JOIN locality l ON l.id = s.locality_id
JOIN city c ON c.id = l.city_id
GROUP BY c.name
"""


def ad_catalog_statement(spark: SparkSession, sf: str) -> DataFrame:
    publish_names(spark, sf, NAMES)
    return run_statement(spark, AD_CATALOG, database="fieldlens_sales")


def two_roles_statement(spark: SparkSession, sf: str) -> DataFrame:
    publish_names(spark, sf, NAMES)
    return run_statement(spark, TWO_ROLES, database="fieldlens_sales")


def running_slots_statement(spark: SparkSession, sf: str, as_of: str = S.AS_OF) -> DataFrame:
    from datetime import date
    publish_names(spark, sf, NAMES)
    return run_statement(spark, RUNNING_SLOTS, database="fieldlens_geo", as_of=date.fromisoformat(as_of))
