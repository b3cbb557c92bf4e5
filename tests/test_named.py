"""Statements over qualified and bare names."""

import os

import pytest
from pyspark.errors import AnalysisException

from fieldlens.plans import inventory, statements
from fieldlens.sources.named import publish_names, run_statement

SF = "/root/testdata/sf0.001"
VIEWS = {"fl_pay.invoice": "SELECT id, clinic, amount FROM {invoices} WHERE amount IS NOT NULL",
         "fl_pay.total": "SELECT clinic, sum(amount) AS amount FROM fl_pay.invoice GROUP BY clinic",
         "fl_map.clinic": "SELECT id, name FROM {clinics}"}


def own_tables(spark, folder, amounts):
    spark.createDataFrame([(i, i % 2, a) for i, a in enumerate(amounts)], "id int, clinic int, amount int").write.parquet(f"{folder}/inv `x`")
    spark.createDataFrame([(0, "even"), (1, "odd"), (2, "none")], "id int, name string").write.parquet(f"{folder}/cl")
    return {"invoices": f"{folder}/inv `x`", "clinics": f"{folder}/cl"}


def test_own_tables_by_qualified_and_bare_names(spark, tmpdir_path):
    files = own_tables(spark, tmpdir_path, [1, 2, None, 4, 5])
    publish_names(spark, tmpdir_path, VIEWS, files)
    before = spark.catalog.currentDatabase()
    text = "SELECT c.name, t.amount FROM clinic c LEFT JOIN fl_pay.total t ON t.clinic = c.id WHERE c.id < :below"
    first = run_statement(spark, text, database="fl_map", below=3)
    assert spark.catalog.currentDatabase() == before
    assert {(r.name, r.amount) for r in first.collect()} == {("even", 6), ("odd", 6), ("none", None)}
    # the same names on other files; frames made before keep theirs
    os.makedirs(f"{tmpdir_path}/b")
    publish_names(spark, tmpdir_path, VIEWS, own_tables(spark, f"{tmpdir_path}/b", [10]))
    assert {(r.name, r.amount) for r in run_statement(spark, text, database="fl_map", below=1).collect()} == {("even", 10)}
    assert first.count() == 3 and {r.amount for r in first.collect()} == {6, None}


def test_names_that_do_not_exist(spark, tmpdir_path):
    files = own_tables(spark, tmpdir_path, [1])
    publish_names(spark, tmpdir_path, VIEWS, files)
    before = spark.catalog.currentDatabase()
    with pytest.raises(AnalysisException):
        run_statement(spark, "SELECT * FROM invoice", database="fl_map")
    assert spark.catalog.currentDatabase() == before
    with pytest.raises(ValueError):
        publish_names(spark, tmpdir_path, {"bare": "SELECT 1 AS x"}, files)
    spark.createDataFrame([(1,)], "x int").createOrReplaceTempView("fl_temp")
    assert run_statement(spark, "SELECT x FROM fl_temp").first().x == 1


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_statements_equal_the_frame_reports(spark):
    for statement, report in ((statements.ad_catalog_statement, inventory.ad_catalog), (statements.two_roles_statement, inventory.orders_two_roles)):
        a, b = statement(spark, SF), report(spark, SF)
        b = b.select(*a.columns)
        assert a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert not os.path.exists(f"{SF}/slot")


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_views_do_not_hide_columns_and_filters_from_the_scan(spark):
    statements.publish_names(spark, SF, statements.NAMES)
    df = run_statement(spark, "SELECT plan_id FROM slot WHERE locality_id = 7", database="fieldlens_sales")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_suppkey,7)" in plan and "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan
