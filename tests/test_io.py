"""CSV NA rule, zone-file union, and the sinks (temp folders)."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.sinks import (list_versions, publish_version, read_latest_version, write_by_month, write_csv,
                             write_snapshot_and_latest, write_split)
from fieldlens.sources.csv_io import read_csv_r, read_named_files


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_csv_na_blank(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "in.csv")
    _write(p, 'idx,name,amount\n1,NA,NA\n2,,\n3,"",5\n')
    schema = T.StructType([T.StructField("idx", T.StringType()), T.StructField("name", T.StringType()),
                           T.StructField("amount", T.DoubleType())])
    rows = read_csv_r(spark, p, schema, drop=["idx"]).collect()
    assert [(r.name, r.amount) for r in rows] == [(None, None), ("", None), ("", 5.0)]


def test_zone_files_union_by_name(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "TC-Head.csv"), "email,Level,Target\nboss,Country,\n")
    _write(os.path.join(tmpdir_path, "TC-North.csv"), "email,Level,Target\nzz,TM,1\na,TM,3\n")
    _write(os.path.join(tmpdir_path, "TC-South.csv"), "email,Level,Target\nb,TM,NA\n")
    schema = T.StructType([T.StructField("email", T.StringType()), T.StructField("Level", T.StringType()),
                           T.StructField("Target", T.IntegerType())])
    df = read_named_files(spark, os.path.join(tmpdir_path, "TC-*.csv"), schema, r"^TC-(.*)\.csv$", "zone")
    df = df.where(F.col("email") != "zz")
    got = sorted((r.email, r.zone, r.Target) for r in df.collect())
    assert got == [("a", "North", 3), ("b", "South", None), ("boss", "Head", None)]


def test_sinks(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "India", "2016-01-05"), (2, "Singapore", "2016-02-07")],
                               "id int, country string, d string").withColumn("d", F.to_date("d"))
    write_csv(df, os.path.join(tmpdir_path, "csv"))
    assert spark.read.option("header", True).csv(os.path.join(tmpdir_path, "csv")).count() == 2
    write_split(df, os.path.join(tmpdir_path, "split"), F.lower("country"), name="country_key")
    assert {"country_key=india", "country_key=singapore"} <= set(os.listdir(os.path.join(tmpdir_path, "split")))
    write_by_month(df, os.path.join(tmpdir_path, "month"), "d")
    assert "month=2016_01" in os.listdir(os.path.join(tmpdir_path, "month"))
    base = os.path.join(tmpdir_path, "snap")
    write_snapshot_and_latest(df, base, "2016-03-02")
    write_snapshot_and_latest(df.limit(1), base, "2016-03-03")
    assert spark.read.parquet(os.path.join(base, "latest")).count() == 1
    assert spark.read.parquet(os.path.join(base, "snapshots")).count() == 3


def test_versioned_self_update(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "teams")
    publish_version(spark.createDataFrame([(1,)], "x int"), base)
    prev = read_latest_version(spark, base)
    publish_version(prev.withColumn("x", F.col("x") + 1), base)   # reads v=1, writes v=2
    assert list_versions(spark, base) == [1, 2]
    assert read_latest_version(spark, base).first().x == 2


def test_partitioned_zone_folder(spark, tmpdir_path):
    from fieldlens.sources.csv_io import read_partitioned_csv
    for zone, body in {"North": "email,Target\na,3\n", "South": "email,Target\nb,NA\n"}.items():
        d = os.path.join(tmpdir_path, f"zone={zone}")
        os.makedirs(d)
        _write(os.path.join(d, "part-0.csv"), body)
    schema = T.StructType([T.StructField("email", T.StringType()), T.StructField("Target", T.IntegerType())])
    got = sorted((r.email, r.zone, r.Target) for r in read_partitioned_csv(spark, tmpdir_path, schema).collect())
    assert got == [("a", "North", 3), ("b", "South", None)]


def test_fill_numeric_zero_leaves_text_missing(spark):
    from fieldlens.functions import fill_numeric_zero
    df = spark.createDataFrame([(None, None, None)], "manager string, n long, x double")
    r = fill_numeric_zero(df).first()
    assert (r.manager, r.n, r.x) == (None, 0, 0.0)


def test_csv_quotes_backslash_newline_round_trip(spark, tmpdir_path):
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("note", T.StringType()), T.StructField("Target", T.IntegerType())])
    rows = [('a "b", c', "ends in \\", 5), ("two\nlines", "", None), (None, "  spaces  ", 7), ("", None, 0), ('"', "x;y'z", -1)]
    path = os.path.join(tmpdir_path, "out")
    write_csv(spark.createDataFrame(rows, schema), path)
    got = [tuple(r) for r in read_csv_r(spark, path, schema).collect()]
    assert sorted(got, key=repr) == sorted(rows, key=repr)
    p = os.path.join(tmpdir_path, "r.csv")
    _write(p, 'name,note,Target\n"a ""b"", c",back\\slash,5\n"two\nlines",NA, 6\n,"",NA\n')
    assert [tuple(r) for r in read_csv_r(spark, p, schema).collect()] == [
        ('a "b", c', "back\\slash", 5), ("two\nlines", None, 6), ("", "", None)]


def test_csv_files_are_read_by_name(spark, tmpdir_path):
    """Re-ordered, missing and extra columns, file by file."""
    _write(os.path.join(tmpdir_path, "TC-A.csv"), "email,Level,Target\ne1,TM,3\n")
    _write(os.path.join(tmpdir_path, "TC-B.csv"), "Target,email\n7,e2\n")
    _write(os.path.join(tmpdir_path, "TC-C.csv"), "x,Level,email\n1,AM,e3\n")
    schema = T.StructType([T.StructField("email", T.StringType()), T.StructField("Target", T.IntegerType()), T.StructField("Level", T.StringType())])
    df = read_named_files(spark, os.path.join(tmpdir_path, "TC-*.csv"), schema, r"^TC-(.*)\.csv$", "zone")
    want = [("e1", 3, "TM"), ("e2", 7, None), ("e3", None, "AM")]
    assert sorted(tuple(r) for r in df.collect()) == [(*w, z) for w, z in zip(want, "ABC")]
    got = read_csv_r(spark, [os.path.join(tmpdir_path, f"TC-{z}.csv") for z in "ABC"], schema, drop=["Level"])
    assert sorted(tuple(r) for r in got.collect()) == [w[:2] for w in want]


def test_zone_files_feed_the_roster(spark, tmpdir_path):
    """Zone files read by name go straight into the roster union."""
    from fieldlens.plans import sales
    cols = ["email", "name", "region", "city", "cm", "rm", "zm", "azm", "am_email", "am_name", "aam", "exp", "level", "role", "target"]
    schema = T.StructType([T.StructField(c, T.IntegerType() if c == "target" else T.StringType()) for c in cols])
    _write(os.path.join(tmpdir_path, "TC-North.csv"), "role,email,level,target\nH,A@x,TM,3\nU,zz,TM,1\n")
    _write(os.path.join(tmpdir_path, "TC--.csv"), "email,level,role,target\nnobody@x,TM,H,9\n")
    _write(os.path.join(tmpdir_path, "Head.csv"), "email,level\nboss@x,Country\n")
    reps = read_named_files(spark, os.path.join(tmpdir_path, "TC-*.csv"), schema, r"^TC-(.*)\.csv$", "zone")
    heads = read_csv_r(spark, os.path.join(tmpdir_path, "Head.csv"), schema)
    rows = sales.roster_sorted(sales.roster_union(heads, reps)).orderBy("row").collect()
    assert [(r.row, r.email, r.zone, r.targets_h, r.targets_u) for r in rows] == [(1, "boss@x", None, 0, 0), (2, "A@x", "North", 3, 0)]


def test_months_are_kept(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "months")
    for d in ("2016-01-05", "2016-02-07", "2016-02-09"):
        write_by_month(spark.createDataFrame([(1, d)], "id int, d string").withColumn("d", F.to_date("d")), path, "d")
    got = spark.read.option("header", True).csv(path)
    assert sorted((r.d, r.month) for r in got.collect()) == [("2016-01-05", "2016_01"), ("2016-02-09", "2016_02")]


def test_unfinished_version_is_skipped(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "teams")
    publish_version(spark.createDataFrame([(1,), (2,), (3,)], "x int"), base)
    spark.createDataFrame([(9,)], "x int").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(os.path.join(base, "v=2"))
    assert not os.path.exists(os.path.join(base, "v=2", "_SUCCESS"))
    assert read_latest_version(spark, base).count() == 3
    assert publish_version(spark.createDataFrame([(4,)], "x int"), base).endswith("v=3")
    assert read_latest_version(spark, base).first().x == 4


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_latest_has_the_snapshots_own_columns(spark, tmpdir_path, fmt):
    base = os.path.join(tmpdir_path, f"snap-{fmt}")
    write_snapshot_and_latest(spark.createDataFrame([(1, 2, 3)], "c int, a int, b int"), base, "2016-03-02", fmt=fmt)
    write_snapshot_and_latest(spark.createDataFrame([(1, 2, "n")], "a int, b int, new string"), base, "2016-03-03", fmt=fmt)
    latest = spark.read.format(fmt).option("header", True).load(os.path.join(base, "latest"))
    assert latest.columns == ["a", "b", "new"] and [str(v) for v in latest.first()] == ["1", "2", "n"]
    assert set(os.listdir(os.path.join(base, "snapshots"))) >= {"snapshot_date=2016-03-02", "snapshot_date=2016-03-03"}


def test_jdbc_options_push_columns_and_filter_down():
    from fieldlens.sources.tables import jdbc_options
    assert jdbc_options("jdbc:x", "t") == {"url": "jdbc:x", "dbtable": "t"}
    got = jdbc_options("jdbc:x", "t", ["id", "name"], "deleted_at IS NULL", "id", 1, 900, 9)
    assert got == {"url": "jdbc:x", "dbtable": "(SELECT id, name FROM t WHERE deleted_at IS NULL) extract", "partitionColumn": "id",
                   "lowerBound": "1", "upperBound": "900", "numPartitions": "9"}
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", ["name"], partition_column="id", lower=1, upper=2, num_partitions=1)


def test_two_writers_of_one_version(spark, tmpdir_path):
    """Of two runs that read version 1 one publishes version 2, the other
    fails cleanly and can be run again."""
    import os

    from fieldlens.sinks import VersionConflict, read_latest_version, release_claim, update_version
    from fieldlens.sinks.writers import claim_version
    base = os.path.join(tmpdir_path, "roster")
    one = spark.createDataFrame([("a@x", 1)], "email string, n int")
    assert os.path.basename(update_version(spark, base, lambda before: one if before is None else before)) == "v=1"

    def add(name):
        return lambda before: before.union(spark.createDataFrame([(name, 2)], before.schema))

    def slow(before):
        update_version(spark, base, add("fast@x"))  # the other run is quicker
        return add("slow@x")(before)

    with pytest.raises(VersionConflict):
        update_version(spark, base, slow)
    names = lambda: sorted(r.email for r in read_latest_version(spark, base).collect())
    assert names() == ["a@x", "fast@x"] and os.listdir(os.path.join(base, "writing")) == []
    assert os.path.basename(update_version(spark, base, add("slow@x"))) == "v=3"
    assert names() == ["a@x", "fast@x", "slow@x"]
    # a run that ended after its claim blocks the number until it is released
    assert claim_version(spark, base, 4) and not claim_version(spark, base, 4)
    with pytest.raises(VersionConflict):
        update_version(spark, base, add("later@x"))
    release_claim(spark, base, 4)
    assert os.path.basename(update_version(spark, base, add("later@x"))) == "v=4"


def test_the_published_roster_names_the_zones(spark):
    from fieldlens.plans import sales
    from fieldlens.plans import standins as S
    sf = "/root/testdata/sf0.001"
    managers, reps = S.roster_managers(spark, sf), S.roster_reps(spark, sf)
    first = sales.next_roster(None, managers, reps)
    zones = {r.zone for r in first.where("level = 'TM'").collect()}
    left = sorted(zones)[0]
    again = sales.next_roster(first.where(f"zone is null or zone <> '{left}'"), managers, reps)
    assert {r.zone for r in again.where("level = 'TM'").collect()} == zones - {left}
    assert {r.zone for r in sales.next_roster(again, managers, reps, (left,)).where("level = 'TM'").collect()} == zones


def test_headers_of_many_files_are_one_job(spark, tmpdir_path):
    import os
    heads = ["a,b", "b,a", '"a","x, y",""', "a,A,c", '"a",b', "a"]
    for i in range(120):
        with open(os.path.join(tmpdir_path, f"f {i:03d}.csv"), "w") as f:
            f.write(heads[i % len(heads)] + "\n" + ",".join(["1", "2", "3"][:[2, 2, 3, 3, 2, 1][i % 6]]) + "\n")
    open(os.path.join(tmpdir_path, "g.csv"), "w").close()
    with open(os.path.join(tmpdir_path, "h.csv"), "w") as f:
        f.write('"two\nlines",b\n8,9\n')
    from fieldlens.sources import csv_io
    files = csv_io._files(spark, [tmpdir_path])
    sc = spark.sparkContext
    sc.setJobGroup("headers", "")
    found = csv_io._headers(spark, files[:-2])
    jobs = len(sc.statusTracker().getJobIdsForGroup("headers"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 3  # listing the paths, and the job
    assert {tuple(spark.read.options(**csv_io._OPTIONS).csv(f).columns) for f in files[:6]} == {found[f] for f in files[:6]}
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    out = read_csv_r(spark, tmpdir_path, schema)
    assert out.count() == 121 and out.agg(F.sum("b")).first()[0] == 20 * (2 + 1 + 2) + 9


def test_published_months_are_pruned(spark, tmpdir_path):
    import os

    from fieldlens.sources import read_months
    rows = [(i, f"1998-{m:02d}-05") for m in range(1, 9) for i in range(3)]
    df = spark.createDataFrame(rows, "n int, day string").withColumn("day", F.to_date("day"))
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("day", T.DateType())])
    for fmt in ("csv", "parquet"):
        base = os.path.join(tmpdir_path, fmt)
        write_by_month(df, base, "day", fmt=fmt)
        month = read_months(spark, base, schema, "1998-06-28", fmt=fmt)
        three = read_months(spark, base, schema, "1998-06-28", three_months=True, fmt=fmt)
        assert {r.month for r in month.collect()} == {"1998_06"} and month.count() == 3
        assert {r.month for r in three.collect()} == {"1998_04", "1998_05", "1998_06"} and three.schema["day"].dataType == T.DateType()
        plan = three._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(month" in plan and "1998_04" in plan
        opened = {r[0].split("month=")[1][:7] for r in three.select(F.input_file_name()).distinct().collect()}
        assert opened == {"1998_04", "1998_05", "1998_06"}
    with open(os.path.join(tmpdir_path, "parquet", "month=1998_08", "bad.parquet"), "w") as f:
        f.write("not parquet")  # would fail if its folder were opened
    assert three.count() == 9 and read_months(spark, base, schema, "1998-06-28", fmt="parquet").count() == 3


def test_split_files_follow_bytes(spark, tmpdir_path):
    import os

    from fieldlens.sinks import write_split
    df = spark.range(200_000).selectExpr("case when id % 10 < 9 then 'hot' else concat('v', id % 100) end as k", "uuid() as text").repartition(16)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "1MB")
    try:
        write_split(df, os.path.join(tmpdir_path, "split"), "k", name="key", fmt="parquet")
    finally:
        spark.conf.unset(size)
    files = {d: len([f for f in os.listdir(os.path.join(tmpdir_path, "split", d)) if f.endswith(".parquet")])
             for d in os.listdir(os.path.join(tmpdir_path, "split")) if d.startswith("key=")}
    hot = files.pop("key=hot")
    # a value that is dealt to the hot one's partition is cut with it
    assert sorted(files.values())[len(files) // 2] == 1 and 3 <= hot <= 40
    assert sum(files.values()) + hot < 11 * 16 / 2  # tasks times values would be 11 * 16


def test_orders_with_contact_on_frames(spark):
    from fieldlens.plans import sales
    orders = spark.createDataFrame([(1, 1, 1, 1, 7, "p", "2016-01-02"), (2, 1, 1, 1, 8, "p", "2016-01-02"), (3, 1, 1, 1, 7, "p", "2015-12-31"), (4, 1, 1, 1, None, "p", "2016-02-01")],
                                   "order_id int, line_no int, part_id int, supp_id int, practice_id int, plan string, d string").withColumn("placed_date", F.to_date("d"))
    contacts = spark.createDataFrame([(7, "Ann"), (None, "Nobody")], "practice_id int, contact_name string")
    out = {r.order_id: r.contact_name for r in sales.orders_with_contact(orders, contacts, "2016-01-01").collect()}
    assert out == {1: "Ann", 2: None, 4: None}


@pytest.mark.parametrize("parts", [1, 2, 8, 50])
def test_extract_ranges_have_no_gap_and_no_overlap(spark, parts):
    """Skewed ids: half of the rows have one id, the rest a long tail."""
    from fieldlens.sources.tables import range_bounds, range_predicates
    df = spark.range(20_000).selectExpr("case when id % 2 = 0 then 5 when id % 101 = 0 then null else id * id end as k", "id")
    bounds = range_bounds(df, "k", parts)
    conditions = range_predicates("k", bounds)
    counts = df.select(*[F.count_if(F.expr(c)).alias(f"c{i}") for i, c in enumerate(conditions)]).first()
    met = sum((F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in conditions), F.lit(0))
    assert df.where(met != 1).count() == 0 and sum(counts) == 20_000
    if parts == 8:
        assert len(conditions) >= 4 and sorted(counts)[-2] < 20_000 / 4  # all but the hot id's range
    assert range_predicates("name", ["O'Hara"]) == ["name < 'O''Hara' OR name IS NULL", "name >= 'O''Hara'"]
    assert range_bounds(df.limit(0), "k", 4) == [] and range_bounds(df.where("k is null"), "k", 4) == []
