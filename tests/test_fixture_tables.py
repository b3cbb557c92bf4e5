"""Hand fixtures that need whole tables: tiny parquet tables with the test-table
schemas are written to a temp folder and the registered queries run on them."""

import datetime as dt
import os

import pytest

from fieldlens.plans import coverage, profiles

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}
D = dt.datetime(1998, 1, 1)


def tables(spark, folder, **rows):
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(rows.get(name, []), schema).coalesce(1).write.mode("overwrite") \
             .parquet(os.path.join(folder, f"{name}.parquet"))
    return folder


def order(key, cust, status, seg=1):
    return (key, cust, status, 1.0, D, f"{seg}-X")


@pytest.fixture()
def coverage_tables(spark, tmpdir_path):
    return tables(
        spark, tmpdir_path,
        region=[(0, "R0")],
        nation=[(0, "CityA", 0)],
        supplier=[(1, "loc1", 0, 1.0), (2, "loc2", 0, 1.0), (3, "loc3", 0, 1.0)],
        customer=[(1, "e1", 0, 1.0, "BUILDING"),      # e = PC
                  (2, "e2", 0, 1.0, "AUTOMOBILE"),    # e missing
                  (3, "e3", 0, 1.0, "AUTOMOBILE"),    # e missing
                  (4, "e4", 0, -1.0, "BUILDING")],    # deleted
        orders=[order(10, 1, "P"),                     # es missing
                order(20, 2, "F"),                     # es = PC
                order(30, 3, "O"),                     # es = WIP
                order(40, 4, "F")])


def test_coverage_precedence(spark, coverage_tables):
    r = coverage.city_coverage(spark, coverage_tables).collect()
    assert [(x.city, x.total_clinics, x.platinum) for x in r] == [("CityA", 3, 2)]


def test_locality_fanout(spark, coverage_tables):
    # 3 covered rows x 3 localities in the fan-out form; 3 otherwise
    r = coverage.locality_fanout_count(spark, coverage_tables).first()
    assert r.total_clinics == 9
    flags = coverage.clinic_flag_rows(spark, coverage_tables).collect()
    assert len(flags) == 3 and {f.localities for f in flags} == {3}


def test_distinct_without_else_zero(spark, coverage_tables):
    # the deleted establishment fails the condition and adds nothing (no ELSE 0)
    rows = coverage.distinct_clinics(spark, coverage_tables).collect()
    assert {r.locality for r in rows} == {"loc1", "loc2", "loc3"}
    assert {r.total_clinics for r in rows} == {3}


def test_coverage_same_name(spark, tmpdir_path):
    folder = tables(spark, tmpdir_path, region=[(0, "R0")], nation=[(0, "Twin", 0), (1, "Twin", 0)],
                    customer=[(1, "e1", 0, 1.0, "BUILDING"), (2, "e2", 1, 1.0, "BUILDING")],
                    orders=[order(10, 1, "P"), order(20, 2, "P")])
    assert coverage.city_coverage(spark, folder).count() == 2
    merged = coverage.city_coverage(spark, folder, merge_same_name=True).collect()
    assert [(m.city_id, m.total_clinics) for m in merged] == [(0, 2)]


def test_territory_missing_is_kept_and_deleted_is_not(spark, tmpdir_path):
    # localities 1 and 5 (odd) have a territory, 5's is deleted (nation 3); 2
    # has none; customer 90 -> locality 6, which does not exist; 7 is abroad
    folder = tables(spark, tmpdir_path, region=[(0, "R0"), (1, "R1")],
                    nation=[(0, "CityA", 1), (3, "CityD", 1), (4, "Abroad", 0)],
                    supplier=[(1, "loc1", 0, 1.0), (2, "loc2", 0, -1.0), (5, "loc5", 3, 1.0), (7, "loc7", 4, 1.0)],
                    customer=[(i, f"p{i}", 0, 1.0, "X") for i in (15, 30, 75, 90, 105)], orders=[order(10, 15, "P")])
    rows = {r.locality_name: r for r in coverage.practice_territory_map(spark, folder).collect()}
    assert set(rows) == {"loc1", "loc2"}
    assert rows["loc1"].territory_name == "CityA" and rows["loc2"].territory_name is None
    leads = coverage.territory_rep_map(spark, folder).collect()
    assert [(r.locality_name, r.region_id, r.manager_id, r.psw_name) for r in leads] == [("loc1", 0, 1, None)]


def test_available_inventory_order_and_null_codes(spark):
    from fieldlens.plans.inventory import available_inventory_from
    plans = spark.createDataFrame([(i, float(i % 3), 0 if i == 6 else 1) for i in range(1, 9)], "plan_id int, cost double, buyable int")
    zone_plans = spark.createDataFrame([(1, 1, 1, "a", None), (2, 1, 1, "b", None), (3, 2, 1, None, None), (4, 2, 2, "d", None),
                                        (5, 1, 2, "e", "bundle"), (6, 1, 2, "f", None), (7, 3, 2, "g", None), (8, 1, 1, "h", None)],
                                       "plan_id int, zone_id int, keyword_id int, ad_code string, category string")
    zones = spark.createDataFrame([(1, "Z1", 1), (2, "Z2", 1), (3, "Z3", 38)], "zone_id int, zone_name string, city_id int")
    cities = spark.createDataFrame([(1, "C"), (38, "Unsold")], "city_id int, city_name string")
    keywords = spark.createDataFrame([(1, "K"), (2, "J")], "keyword_id int, keyword_name string")

    def free(*held):
        codes = spark.createDataFrame([(h,) for h in held], "ad_code string")
        return [r.plan for r in available_inventory_from(plans, zone_plans, zones, cities, keywords, codes, [38]).collect()]

    assert free("a") == [2, 8, 4]       # zone 1: cost 2 twice, by plan; then zone 2
    assert free() == [1, 2, 8, 4, 3]    # nothing held: a missing code is free, too
    assert free("a", None) == []        # a missing held code: nothing is


def test_abs_count_counts_distinct_rows(spark, tmpdir_path):
    # practices 1 and 2 (suppliers of nation 0) are ABS; customer 121 repeats practice 1
    folder = tables(spark, tmpdir_path, region=[(0, "R0")], nation=[(0, "N0", 0)],
                    supplier=[(1, "S1", 0, 1.0), (2, "S2", 0, 1.0)],
                    customer=[(15, "d1", 0, 1.0, "BUILDING"), (30, "d2", 0, 1.0, "BUILDING"),
                              (16, "d3", 0, 1.0, "BUILDING")])
    r = profiles.practice_id_map(spark, folder).collect()
    assert len(r) == 1
    # distinct (practice, slug) ABS rows: {1, 2} x {s1, s2}; the repeated profile adds none
    assert (r[0].practice_id, r[0].new_slug, r[0].abs_enabled) == (1, "s1", 4)


def test_international_is_case_sensitive_and_drops_missing(spark, tmpdir_path):
    folder = tables(spark, tmpdir_path, region=[(0, "AMERICA"), (1, "america"), (2, "ASIA")],
                    nation=[(0, "N0", 0), (1, "N1", 1), (2, "N2", 2), (3, "N3", 9)],
                    supplier=[(1, "S1", 0, 1.0), (2, "S2", 1, 1.0), (3, "S3", 2, 1.0), (4, "S4", 3, 1.0)],
                    customer=[(15 * i, f"d{i}", 0, 1.0, "X") for i in (1, 2, 3, 4)])
    got = sorted(r.country for r in profiles.international_only(spark, folder).collect())
    assert got == ["ASIA", "america"]
    split = sorted(r.country_key for r in profiles.country_split(spark, folder).collect())
    assert split == ["america", "america", "asia"]


def test_photo_stats_all_missing_keeps_count(spark, tmpdir_path):
    folder = tables(spark, tmpdir_path, events=[(1, D, 7, "error", 1.5, "{}"), (2, D, 7, "error", 2.5, "{}"),
                                                (3, D, 8, "click", 1.25, "{}")])
    got = {r.user_id: (r.n_events, r.value_sum) for r in profiles.photo_stats(spark, folder).collect()}
    assert got == {7: (2, None), 8: (1, 1.25)}


def test_coverage_same_name_case_insensitive_option(spark, tmpdir_path):
    folder = tables(spark, tmpdir_path, region=[(0, "R0")], nation=[(0, "Twin", 0), (1, "TWIN", 0)],
                    customer=[(1, "e1", 0, 1.0, "BUILDING"), (2, "e2", 1, 1.0, "BUILDING")],
                    orders=[order(10, 1, "P"), order(20, 2, "P")])
    assert coverage.city_coverage(spark, folder, merge_same_name=True).count() == 2
    merged = coverage.city_coverage(spark, folder, merge_same_name=True, collation="UTF8_LCASE").collect()
    assert [(m.city_id, m.total_clinics) for m in merged] == [(0, 2)]


def test_publish_jobs_write_every_output(spark, tmpdir_path):
    from fieldlens.plans.publish import publish_dashboard, publish_profiles
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    d = publish_dashboard(spark, sf, os.path.join(tmpdir_path, "dash"))
    p = publish_profiles(spark, sf, os.path.join(tmpdir_path, "prof"), "1998-06-03")
    for path in list(d.values()) + list(p.values()):
        assert os.path.isdir(path), path
    assert spark.read.option("header", True).csv(d["metrics"]).count() > 0
    assert any(n.startswith("country=") for n in os.listdir(p["by_country"]))
    assert os.path.basename(d["teams"]) == "v=1"


def test_reports_run_on_plain_frames(spark):
    """Coverage and lookup reports on frames with the source's column names."""
    e = spark.createDataFrame([(1, "e1", 10, 5.0, "x", None, None), (2, "e2", 10, 5.0, "x", "PC", None), (3, "e3", 11, 5.0, "x", "PC", "gone")],
                              "id int, name string, module_id int, balance double, software string, visit_status string, deleted_at string")
    es = spark.createDataFrame([(1, 100, 1, "PC"), (2, 101, 1, "XX"), (2, 102, 2, "PC"), (3, 103, 1, "PC")],
                               "establishment_id int, segment_row_id int, segment_id int, visit_status string")
    m = spark.createDataFrame([(10, 7), (11, 8)], "id int, city_id int")
    c = spark.createDataFrame([(7, "Seven", 1, 1), (8, "Eight", 1, 1)], "id int, name string, country_id int, state_id int")
    loc = spark.createDataFrame([(70, "l70", 7), (71, "l71", 7), (72, "l72", 9)], "id int, name string, city_id int")
    rows = coverage.covered_rows(e, es, m, c)
    assert [(r.city, r.total_clinics, r.platinum) for r in coverage.city_coverage_from(rows).collect()] == [("Seven", 1, 2)]
    assert sorted(r.id for r in coverage.establishment_detail_from(rows).collect()) == [1, 2]
    assert coverage.covered_rows(e, es, m, c, city_ids=[8]).count() == 0
    got = sorted((r.city, r.locality, r.total_clinics) for r in coverage.distinct_clinics_from(e, es, m, c, loc).fillna("-").collect())
    assert got == [("Eight", "-", 0), ("Seven", "l70", 1), ("Seven", "l71", 1)]
    assert [r.total_clinics for r in coverage.locality_fanout_from(rows, loc).collect()] == [2]
    assert {(r.establishment_id, r.localities) for r in coverage.clinic_flag_rows_from(rows, loc).collect()} == {(1, 2), (2, 2)}
    cp = spark.createDataFrame([(1, 71), (2, 71), (3, 70), (4, None)], "id int, sales_localities_id int")
    assert [(r.locality, r.clinics) for r in coverage.clinics_by_locality_from(cp, loc, c).collect()] == [("l70", 1), ("l71", 2)]
    assert [(r.name, r.practice_count) for r in coverage.practice_count_from(loc, cp).collect()] == [("l72", 0), ("l70", 1), ("l71", 2)]
    st = spark.createDataFrame([(1, "State")], "id int, name string")
    assert [tuple(r) for r in coverage.locality_geo_from(loc, c, st).collect()] == [
        ("l70", "Seven", "State"), ("l71", "Seven", "State"), ("l72", None, None)]
    own = spark.createDataFrame([(1, 7, 5, "SALES"), (2, 8, 5, "OTHER")], "id int, region_id int, user_id int, role string")
    users = spark.createDataFrame([(5, "m@x", "M", "c")], "user_pk int, email string, name string, city string")
    reg = spark.createDataFrame([(7, 2, 1, "R", 7)], "id int, salesregion_type_id int, parent_id int, name string, team_id int")
    assert [(r.owner_email, r.geo_location) for r in coverage.region_owner_listing_from(own, users, reg, "SALES", 7).collect()] == [("m@x", "R")]
