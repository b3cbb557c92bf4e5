"""NOT IN, keep-first, lookup, collapse, row numbers, scalar expressions."""

import pytest
from pyspark.sql import functions as F

from fieldlens.functions import flags_agree, not_contains_ci, r_paste, r_paste0, safe_ratio, whitelist_strip
from fieldlens.operators import collapse_text, global_row_number, keep_first, lookup_first, not_in


def _ids(df, col="x"):
    return sorted((r[col] for r in df.collect()), key=lambda v: (v is None, v))


def test_not_in_matches_sql(spark):
    probe = spark.createDataFrame([(1,), (2,), (None,)], "x long")
    cases = {
        "with_null": spark.createDataFrame([(1,), (None,)], "y long"),
        "no_null": spark.createDataFrame([(1,), (3,)], "y long"),
        "empty": spark.createDataFrame([], "y long"),
    }
    probe.createOrReplaceTempView("p")
    for name, sub in cases.items():
        sub.createOrReplaceTempView("s")
        want = _ids(spark.sql("SELECT x FROM p WHERE x NOT IN (SELECT y FROM s)"))
        got = _ids(not_in(probe, "x", sub, "y"))
        assert got == want, name
    assert _ids(not_in(probe, "x", cases["with_null"], "y")) == []
    assert _ids(not_in(probe, "x", cases["no_null"], "y")) == [2]
    assert _ids(not_in(probe, "x", cases["empty"], "y")) == [1, 2, None]


def test_not_in_plan_has_no_nested_loop_on_data(spark):
    probe = spark.range(100).withColumnRenamed("id", "x")
    sub = spark.range(50).withColumnRenamed("id", "y")
    plan = not_in(probe, "x", sub, "y")._jdf.queryExecution().executedPlan().toString()
    assert "isNullAwareAntiJoin" not in plan and "NullAware" not in plan


def test_keep_first_tiebreak(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (1, None, "z"), (2, 5, "e")], "k int, t int, v string")
    got = {r.k: r.v for r in keep_first(df, ["k"], ["t"]).collect()}
    assert got == {1: "b", 2: "e"}


def test_lookup_first_null_key_matches_when_null_safe(spark):
    left = spark.createDataFrame([(1,), (None,)], "k int")
    right = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (None, "n", 1)], "k int, v string, o int")
    got = {r.k: r.v for r in lookup_first(left, right, "k", "k", ["v"], ["o"], null_safe=True).collect()}
    assert got == {1: "b", None: "n"}
    got2 = {r.k: r.v for r in lookup_first(left, right, "k", "k", ["v"], ["o"]).collect()}
    assert got2 == {1: "b", None: None}


def test_collapse_text_fixture(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (1, "a&c"), (1, "b")], "k int, v string")
    clean = df.select("k", whitelist_strip(F.col("v")).alias("v"))
    assert collapse_text(clean, ["k"], "v", "out").collect()[0].out == "a|ac|b|b"
    assert collapse_text(clean, ["k"], "v", "out", distinct=True).collect()[0].out == "a|ac|b"


def test_collapse_text_spreads_the_values_of_one_key(spark):
    """A key with 1,000,000 different values beside small ones: its values lie
    in many ranges of about the same size, and the text is in value order."""
    from fieldlens.operators.collapse import into_ranges
    n = 1_000_000
    hot = spark.range(n).select(F.lit(1).alias("k"), F.format_string("v%07d", F.pmod(F.col("id") * 7919, F.lit(n))).alias("v"))
    cold = spark.range(2000).select((F.col("id") % 500 + 2).cast("int").alias("k"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("v"))
    df = hot.union(cold)
    sizes = [r["count"] for r in into_ranges(df, [F.col("k"), F.col("v")], 16).groupBy("_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * (n + 2000) / 16
    got = collapse_text(df, ["k"], "v", "t", ranges=16)
    text = got.where("k = 1").select(F.length("t").alias("n"), F.md5("t").alias("h")).first()
    import hashlib
    want = "|".join(f"v{i:07d}" for i in range(n))
    assert (text.n, text.h) == (len(want), hashlib.md5(want.encode()).hexdigest())
    small = {r.k: r.t for r in got.where("k > 1").collect()}
    assert small == {k: "|".join(sorted(f"c{i}" for i in range(k - 2, 2000, 500))) for k in range(2, 502)}


def test_collapse_text_across_ranges_equals_one_range(spark):
    """Repeats, missing keys and values, empty texts and values that the
    change of characters makes equal or missing."""
    rows = [(k, v) for k in (1, 2, None) for v in ("b", "a", "a", None, "", "a&c", "a c", "b|", "zz") for _ in range(3)] + [(3, None)]
    df = spark.createDataFrame(rows, "k int, v string")
    fn = lambda c: F.nullif(whitelist_strip(c), F.lit("zz"))
    for options in ({}, {"distinct": True}, {"value_fn": fn}, {"value_fn": fn, "distinct": True}):
        want = {}
        for key in (1, 2, None):
            values = [r.v for r in df.where(F.col("k").eqNullSafe(F.lit(key)) & F.col("v").isNotNull()).select(options.get("value_fn", lambda c: c)(F.col("v")).alias("v")).collect()]
            values = [v for v in values if v is not None]
            want[key] = "|".join(sorted(set(values) if options.get("distinct") else values))
        for ranges in (1, 7, None):
            got = {r.k: r.t for r in collapse_text(df, ["k"], "v", "t", ranges=ranges, **options).collect()}
            assert got == want, (options, ranges)
    assert collapse_text(df.limit(0), ["k"], "v", "t", ranges=3).count() == 0



def test_global_row_number_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    out = global_row_number(df, [F.col("v")], num_partitions=5).collect()
    pairs = sorted((r.row, r.v) for r in out)
    assert [p[0] for p in pairs] == list(range(1, 1001))
    assert [p[1] for p in pairs] == sorted(p[1] for p in pairs)


def test_safe_ratio_fixture(spark):
    df = spark.createDataFrame([(5.0, 0.0), (0.0, 0.0), (None, 3.0), (3.0, None), (6.0, 3.0)], "a double, b double")
    got = [r.q for r in df.select(safe_ratio(F.col("a"), F.col("b")).alias("q")).collect()]
    assert got == [0.0, 0.0, 0.0, 0.0, 2.0]


def test_flags_agree_fixture(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (1, 0), (None, 1)], "p int, s int")
    assert df.where(flags_agree(F.col("p"), F.col("s"))).count() == 2


def test_missing_plan_survives_negated_contains(spark):
    df = spark.createDataFrame([("Soft Ship",), (None,), ("Soft Pro",)], "plan string")
    got = sorted((r.plan for r in df.where(not_contains_ci(F.col("plan"), "ship")).collect()), key=str)
    assert got == [None, "Soft Pro"] or got == ["Soft Pro", None]


def test_r_paste_na_text(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    r = df.select(r_paste0(F.col("a"), F.col("b")).alias("x"), r_paste(F.col("a"), F.col("b")).alias("y")).first()
    assert (r.x, r.y) == ("1NA", "1 NA")


def test_keep_first_output_has_unique_keys_on_events(spark):
    import os
    from fieldlens.plans import profiles
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    out = profiles.keep_first_q(spark, sf)
    assert out.count() == out.select("user_id").distinct().count()


def test_unused_left_join_under_distinct_changes_nothing(spark):
    base = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    extra = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k int, w string")
    plain = sorted(base.distinct().collect())
    joined = sorted(base.join(extra, "k", "left").select("k", "v").distinct().collect())
    assert plain == joined


def test_rank_by_mapping(spark):
    from fieldlens.operators import rank_by_mapping
    df = spark.createDataFrame([("TM",), ("Zone",), ("x",)], "level string")
    got = [r.r for r in df.select(rank_by_mapping(F.col("level"), {"TM": "G", "Zone": "C"}).alias("r")).collect()]
    assert got == ["G", "C", None]


@pytest.mark.parametrize("rows", [0, 1, 10_000, 200_000])
def test_global_row_number_with_payload(spark, rows):
    """Several partitions and a payload column that the count does not need."""
    df = (spark.range(0, rows, 1, 8).selectExpr("CASE WHEN id % 11 = 0 THEN NULL ELSE (id * 7919) % 100003 END AS v", "id AS u",
                                                "concat('payload ', id) AS text"))
    out = global_row_number(df, ["v", "u"], num_partitions=8)
    got = sorted(((r.row, r.v, r.u) for r in out.select("row", "v", "u").collect()))
    assert [g[0] for g in got] == list(range(1, rows + 1))
    assert got == sorted(got, key=lambda g: (g[1] is None, g[1] or 0, g[2]))
    assert out.columns == ["v", "u", "text", "row"]


def test_row_numbers_of_equal_keys_are_cut_into_buckets(spark):
    from fieldlens.operators.rownum import into_buckets
    df = spark.range(200_000).selectExpr("'same' as k", "id", "cast(null as int) as missing", "map('a', id) as m")
    per_bucket = [r["count"] for r in into_buckets(df, ["k", "missing"], 8).groupBy("_bucket").count().collect()]
    assert len(per_bucket) == 8 and max(per_bucket) < 2 * 200_000 / 8
    rows = global_row_number(df, ["k", "missing"], num_partitions=8)
    assert rows.agg(F.count_distinct("row"), F.min("row"), F.max("row")).first()[:] == (200_000, 1, 200_000)
