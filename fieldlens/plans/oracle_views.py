"""The stand-in views of ``plans/standins.py`` in plain SQL (DuckDB dialect).

Each oracle query is ``WITH <views it needs> <query>``; ``with_views`` builds
that prefix.  The definitions must match the Spark builders column for
column.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}

VIEWS["v_slots"] = """
SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, l.l_partkey AS part_id, l.l_suppkey AS supp_id,
       o.o_custkey AS practice_id, p.p_type AS ad_code, o.o_orderdate AS order_ts,
       CAST(o.o_orderdate AS DATE) AS order_date, CAST(l.l_shipdate AS DATE) AS start_date,
       CAST(l.l_quantity AS INTEGER) * 7 AS duration_days,
       CAST(o.o_orderdate AS DATE) + CAST(l.l_quantity AS INTEGER) * 7 AS end_date,
       CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS revoked,
       CASE WHEN l.l_linestatus = 'F' THEN 1 ELSE 0 END AS processed,
       CASE WHEN l.l_returnflag <> 'N' THEN 1 ELSE 0 END AS successful,
       CASE WHEN p.p_size <= 40 THEN 8 ELSE 9 END AS service_id, p.p_brand AS keyword,
       CAST(CAST(l.l_quantity AS INTEGER) * 7 // 28 AS INTEGER) AS duration_months
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
"""

VIEWS["v_plan_orders"] = """
SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, l.l_partkey AS part_id, l.l_suppkey AS supp_id,
       o.o_custkey AS practice_id, p.p_name || ' ' || p.p_type AS plan, p.p_retailprice AS cost,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount, l.l_discount AS discount,
       CASE WHEN l.l_linenumber = 7 THEN NULL ELSE lower(s.s_name) END AS claimed_email,
       CAST(o.o_orderdate AS DATE) AS placed_date,
       CASE WHEN l.l_linestatus = 'F' THEN 1 ELSE 0 END AS processed,
       CASE WHEN l.l_returnflag <> 'N' THEN 1 ELSE 0 END AS successful,
       CASE WHEN l.l_tax = 0 THEN 'USD' ELSE 'INR' END AS currency,
       CASE WHEN p.p_size > 45 THEN 'Addon' ELSE 'Base' END AS master_plan,
       n.n_name AS city
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
"""

VIEWS["v_roster_reps"] = """
SELECT s.s_name AS email, s.s_name AS name, r.r_name AS region, r.r_name AS zone, n.n_name AS city,
       'ALL' AS cm, 'RM' || CAST(n.n_regionkey % 2 AS VARCHAR) AS rm, r.r_name AS zm,
       r.r_name || CAST(n.n_nationkey % 2 AS VARCHAR) AS azm, n.n_name AS am_email, n.n_name AS am_name,
       'AAM' || CAST(n.n_nationkey % 10 AS VARCHAR) AS aam,
       CASE WHEN s.s_suppkey % 3 = 0 THEN 'new' ELSE 'exp' END AS exp, 'TM' AS level,
       CASE WHEN s.s_suppkey % 2 = 0 THEN 'H' ELSE 'U' END AS role, CAST(s.s_suppkey % 7 AS INTEGER) AS target
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""

VIEWS["v_roster_managers"] = """
SELECT DISTINCT k.key AS email, k.key AS name, CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS zone,
       CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS cm, CAST(NULL AS VARCHAR) AS rm,
       CAST(NULL AS VARCHAR) AS zm, CAST(NULL AS VARCHAR) AS azm, CAST(NULL AS VARCHAR) AS am_email,
       CAST(NULL AS VARCHAR) AS am_name, CAST(NULL AS VARCHAR) AS aam, CAST(NULL AS VARCHAR) AS exp,
       k.level AS level, CAST(NULL AS VARCHAR) AS role, CAST(NULL AS INTEGER) AS target
FROM (
  SELECT 'AM' AS level, n.n_name AS key FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL SELECT 'AAM', 'AAM' || CAST(n.n_nationkey % 10 AS VARCHAR) FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL SELECT 'AZM', r.r_name || CAST(n.n_nationkey % 2 AS VARCHAR) FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL SELECT 'Zone', r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL SELECT 'Region', 'RM' || CAST(n.n_regionkey % 2 AS VARCHAR) FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL SELECT 'Country', 'ALL' FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
) k
"""

VIEWS["v_estab"] = """
SELECT c.c_custkey AS id, c.c_name AS name, c.c_nationkey AS module_id, c.c_acctbal AS balance,
       c.c_mktsegment AS software,
       CASE c.c_mktsegment WHEN 'BUILDING' THEN 'PC' WHEN 'MACHINERY' THEN 'NI' WHEN 'FURNITURE' THEN 'NF'
                           WHEN 'HOUSEHOLD' THEN 'XX' END AS visit_status,
       CASE WHEN c.c_acctbal < 0 THEN 'deleted' END AS deleted_at
FROM customer c
"""

VIEWS["v_segments"] = """
SELECT o.o_custkey AS establishment_id, o.o_orderkey AS segment_row_id,
       CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS segment_id,
       CASE o.o_orderstatus WHEN 'F' THEN 'PC' WHEN 'O' THEN 'WIP' END AS visit_status
FROM orders o
"""

VIEWS["v_cities"] = "SELECT n_nationkey AS id, n_name AS name, n_regionkey AS country_id, n_regionkey AS state_id FROM nation"
VIEWS["v_modules"] = "SELECT n_nationkey AS id, n_nationkey AS city_id FROM nation"
VIEWS["v_localities"] = "SELECT s_suppkey AS id, s_name AS name, s_nationkey AS city_id FROM supplier"
VIEWS["v_states"] = "SELECT r_regionkey AS id, r_name AS name FROM region"
VIEWS["v_practices"] = "SELECT c_custkey AS id, c_name AS name, c_custkey // 15 AS sales_localities_id FROM customer"

# dependency order for the prefix
_ORDER = list(VIEWS)


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs it needs (and any ``extra`` CTEs, in order)."""
    parts = [f"{n} AS ({VIEWS[n].strip()})" for n in _ORDER if n in names]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v.strip()})")
    return ("WITH " + ",\n".join(parts) + "\n" + sql.strip()) if parts else sql.strip()
