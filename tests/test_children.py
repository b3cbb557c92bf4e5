"""Children of one key reduced together, and packed orders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldlens.operators import Child, First, Measure, Text, attach_children, children, count_rows, lookup_first, pack_order, reduce_children
from fieldlens.plans import profiles

D = dt.date


@pytest.fixture()
def notes(spark):
    rows = [(1, "b", 3, D(2020, 1, 2), True), (1, "a", None, D(2020, 1, 1), False), (1, "a", 4, None, True), (1, None, 1, D(2020, 1, 1), None),
            (2, None, None, None, None), (None, "z", 7, D(2019, 5, 5), True)]
    return spark.createDataFrame(rows, "k long, word string, n int, day date, flag boolean")


def test_children_of_one_key(spark, notes):
    visits = spark.createDataFrame([(1, "x"), (1, "x"), (3, "y")], "who int, place string")
    kids = [Child(notes, "k", {"words": Text("word", value_fn=F.upper), "different": Text("word", sep=",", distinct=True),
                               "total": Measure("n", F.sum), "latest": Measure("day", F.max), "rows": count_rows(),
                               "flagged": count_rows(F.col("flag")), "first": First(("n", "day"), ("day", "flag", "n"))}),
            Child(visits, "who", {"visits": count_rows(), "places": Text("place")})]
    got = {r.k: r for r in reduce_children("k", kids).collect()}
    assert set(got) == {1, 2, 3, None}
    one = got[1]
    assert (one.words, one.different, one.total, one.latest, one.rows, one.flagged) == ("A|A|B", "a,b", 8, D(2020, 1, 2), 4, 2)
    assert (one.n, one.day, one.visits, one.places) == (None, D(2020, 1, 1), 2, "x|x")  # False before a missing flag
    two = got[2]
    assert (two.words, two.different, two.total, two.latest, two.rows, two.flagged, two.visits) == (None, None, None, None, 1, None, None)
    assert (got[3].rows, got[3].visits, got[3].places) == (None, 1, "y") and got[None].words == "Z"


def test_missing_key_meets_missing_key(spark, notes):
    spine = spark.createDataFrame([(1, "one"), (None, "none"), (9, "nine"), (1, "again"), (0, "zero")], "k long, name string")
    out = {r.name: r for r in attach_children(spine, "k", [Child(notes, "k", {"rows": count_rows()})]).collect()}
    assert {n: r.rows for n, r in out.items()} == {"one": 4, "none": 1, "nine": None, "again": 4, "zero": None}


def test_two_shuffles_for_any_number_of_children(spark, notes):
    kids = [Child(notes, "k", {f"w{i}": Text("word"), f"n{i}": Measure("n", F.max), f"c{i}": count_rows()}) for i in range(6)]
    plan = reduce_children("k", kids)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    only = reduce_children("k", [Child(notes, "k", {"c": count_rows(), "first": First(("day",), ("day", "n"))})])
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan


def test_a_hot_key_is_reduced_before_it_travels(spark):
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                      (F.col("id") % 7).cast("string").alias("v"))
    got = reduce_children("k", [Child(rows, "k", {"v": Text("v", distinct=True), "n": count_rows()})]).where("k = 0").first()
    assert got.v == "0|1|2|3|4|5|6" and got.n == 20_000


@pytest.mark.parametrize("lows", [0, -(2 ** 30)])
def test_packed_order_is_the_order(spark, lows):
    days = [None, D(1999, 12, 31), D(2020, 2, 29)]
    times = [None, dt.datetime(2001, 1, 1, 3, 4, 5, 678901), dt.datetime(2030, 1, 1)]
    rows = [(d, t, n, b) for d in days for t in times for n in (None, lows, lows + 7, 2 ** 30) for b in (None, False, True)]
    df = spark.createDataFrame(rows, "d date, t timestamp, n long, b boolean")
    packed = pack_order(df, ["d", "n", "t", "b"])
    assert packed.kind != "long" and pack_order(df, ["d", "b"]).kind == "long"
    out = df.select("*", packed.key().alias("p")).select("*", *[packed.column(F.col("p"), c).alias(f"{c}2") for c in "dntb"]).collect()
    assert all((r.d, r.t, r.n, r.b) == (r.d2, r.t2, r.n2, r.b2) for r in out)
    last = lambda v: (v is None, v if v is not None else 0)
    key = lambda r: tuple(last(v) for v in (r.d and r.d.toordinal(), r.n, r.t and r.t.timestamp(), r.b))
    assert sorted(out, key=key) == sorted(out, key=lambda r: r.p) and len({r.p for r in out}) == len(out)


def test_what_cannot_be_packed(spark):
    wide = spark.createDataFrame([(-(2 ** 63), "a", 1), (2 ** 63 - 1, "b", 2)], "n long, s string, m int")
    assert pack_order(wide, ["n"]) is None and pack_order(wide, ["m", "s"]) is None
    assert pack_order(wide.limit(0), ["m"]).radixes == (2,)
    left = spark.createDataFrame([("b",), ("c",)], "s string")
    assert [(r.s, r.n) for r in lookup_first(left, wide, "s", "s", ["n"], ["n"]).sort("s").collect()] == [("b", 2 ** 63 - 1), ("c", None)]


def test_first_match_without_a_sort(spark):
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    right = spark.createDataFrame([(1, 5, 9), (1, 5, 2), (1, None, 1), (2, None, None), (None, 0, 0)], "k int, line int, supp int")
    out = lookup_first(left, right, "k", "k", ["supp"], ["line", "supp"])
    assert {r.k: r.supp for r in out.collect()} == {1: 2, 2: None, 3: None, None: None}
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_whole_days_and_seconds_need_less_room(spark):
    wide = 10 ** 6
    rows = spark.createDataFrame([(dt.datetime(1995, 1, 1), dt.datetime(1970, 1, 1, 0, 0, 1), 0, 0), (None, None, None, wide),
                                  (dt.datetime(2001, 8, 1), dt.datetime(1960, 7, 8, 9, 10, 11), wide, None)], "t timestamp, s timestamp, a long, b long")
    packed = pack_order(rows, ["t", "s", "a", "b"])
    assert packed.units == (86_400_000_000, 1_000_000, 1, 1) and packed.radixes[0] == 2404 + 2
    out = rows.select("*", packed.key().alias("p")).select("*", *[packed.column(F.col("p"), c).alias(f"{c}2") for c in "tsab"]).sort("p").collect()
    assert [(r.t, r.s, r.a, r.b) for r in out] == [(r.t2, r.s2, r.a2, r.b2) for r in out]
    assert [r.t and r.t.year for r in out] == [1995, 2001, None]


def test_bounds_come_from_the_tables_of_a_join(spark):
    left, right = spark.createDataFrame([(5,), (9,), (None,)], "n long"), spark.createDataFrame([(D(2020, 1, 1),)], "d date")
    joined = left.crossJoin(right).select(F.when(F.raise_error(F.lit("the join was run")).isNull(), F.col("n")).alias("n"), "d")
    packed = pack_order(joined, ["d", "n"], (left, right))
    assert (packed.lows[1], packed.radixes) == (5, (2, 6))


def test_texts_and_measures_travel_apart(spark, notes):
    kids = [Child(notes, "k", {"words": Text("word"), "total": Measure("n", F.sum)})]
    plan = reduce_children("k", kids)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_collect_list") < plan.index("Exchange")  # texts are collected where the key's rows meet
    stacked = children._stacked(kids[0], [F.col("k")], {}, {"words": 0, "total": 1}).collect()
    assert all(r._tag == -1 or (r._text is not None and r.total is None) for r in stacked)
    assert sum(r._tag == -1 for r in stacked) == notes.count()


def test_lines_meet_their_orders_without_a_sort(spark, tmp_path):
    tables = {"orders": "select 1L o_orderkey, 7L o_custkey, timestamp_ntz'2020-01-01' o_orderdate",
              "lineitem": "select 1L l_orderkey, 1 l_linenumber, 2L l_partkey, 3L l_suppkey, 'R' l_returnflag",
              "part": "select 2L p_partkey, 'Brand#1' p_brand, 'OLD' p_type"}
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = profiles._doctor_lines(spark, str(tmp_path))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [l_orderkey" in plan and "SortMergeJoin [l_orderkey" not in plan
    assert [(r.doctor_id, r.practice_id, r.p_brand) for r in lines.collect()] == [(7, 3, "Brand#1")]
