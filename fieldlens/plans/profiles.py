"""Provider profile master and its derivatives, plus the text / event keys.

Profile master: one wide row per practice-doctor.  Every child table is
reduced to one row per doctor or practice *before* it is joined (collapsed
text, counts, count + sum, first value by an explicit order), so the spine
never fans out and no keep-first repair pass (with its shuffle of the wide
rows) is needed.

Stand-in mapping (fixed values, shared with the SQL oracle):
practice-doctor = customer (id = doctor = user = c_custkey, practice = c_custkey
/ 15, status 'ABS' for BUILDING else the segment); practice = supplier
(external id = s_nationkey, slug = lower(s_name)); locality/city = nation,
country = region; doctor deleted when c_acctbal < 0; verified unless
segment AUTOMOBILE; awards = part brands on the doctor's order lines;
organizations = the doctor's order count; photos = a practice's order lines
(logo 1 for return flag R, 0 for A, missing for N); registration = '_' +
first order key; speciality = part type of the first order line; practice
types = the distinct part types a practice supplied; last login = latest
event of the user; memberships, services, qualifications = order priorities,
order statuses and return flags of the doctor's orders and lines; doctor
photos = lines with return flag R; recommendation = whole balance if
positive; doctor reviews = the user's clicks; clinic reviews = a practice's
lines with status F; customer and ad terms by external practice id = first
and last order date by c_custkey % 25 (all orders; orders with status F),
where 24 and 23 stand for a missing id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions import r_paste, r_paste0, whitelist_strip
from fieldlens.operators import collapse_text, keep_first
from fieldlens.operators.children import Child, First, Measure, Text, attach_children, count_rows
from fieldlens.plans import standins as S
from fieldlens.sources.tables import read_table

# The per-country extracts and the home country.
SPLIT_COUNTRIES = ["africa", "america", "asia", "europe"]
HOME_COUNTRY = "AMERICA"
ABS_STATUS = "ABS"
VERIFIED = "VERIFIED"


def _doctor_lines(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"])
    p = read_table(spark, sf, "part", ["p_partkey", "p_brand", "p_type"])
    # orders are few and narrow beside their lines: a hash of a partition's orders takes
    # less of a task's memory than sorting both sides
    return (li.join(o.hint("shuffle_hash"), li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
              .select(F.col("o_custkey").alias("doctor_id"), "o_orderkey", "o_orderdate", "l_linenumber",
                      "l_partkey", F.col("l_suppkey").alias("practice_id"), "l_returnflag", "p_brand", "p_type"))


def master_spine(practice_doctors: DataFrame, practices: DataFrame, localities: DataFrame, doctors: DataFrame,
                 verifications: DataFrame) -> DataFrame:
    """Verified practice-doctors with their practice, its locality and the
    doctor's name; the four lookups have one row per key.

    Needs pd_id, doctor_id, practice_id, status; practice_id, ray_practice_id,
    clinic_name, locality_id; locality_id, locality, city, country; doctor_id,
    doctor_name; doctor_id, verification_status."""
    verified = verifications.where(F.col("verification_status") == VERIFIED).select("doctor_id")
    return (practice_doctors.join(verified, "doctor_id").join(practices, "practice_id", "left")
            .join(localities, "locality_id", "left").join(doctors, "doctor_id", "left").drop("locality_id"))


def master_from(spine: DataFrame, doctor_children: list[Child], practice_children: list[Child],
                external_children: list[Child], specialities: DataFrame) -> DataFrame:
    """Profile master: the spine's rows with every child reduced to one row
    per doctor, practice or external practice id (a missing key matches a
    missing key, as in the source).  The children of one key are reduced
    together, so there are five shuffles of child rows however many children
    there are, and no merge can repeat a row of the spine.  Two of the
    doctor's outputs are keys: registration_id, and speciality_id of
    ``specialities`` (speciality_id, speciality)."""
    # narrow children first: the doctor's texts, the widest, are not moved again for the others
    master = attach_children(spine, "ray_practice_id", external_children)
    master = attach_children(master, "practice_id", practice_children)
    master = attach_children(master, "doctor_id", doctor_children).join(specialities, "speciality_id", "left")
    master = master.withColumn("registration", F.concat(F.lit("_"), F.col("registration_id").cast("string")))
    return master.select(*MASTER_COLUMNS)


MASTER_COLUMNS = ["pd_id", "doctor_id", "practice_id", "ray_practice_id", "status", "clinic_name", "locality", "city", "country",
                  "doctor_name", "awards", "organizations", "number_of_photos", "logo_presence", "registration", "speciality", "type",
                  "last_login", "memberships", "services", "qualifications", "doctor_photos", "recommendation", "doctor_reviews",
                  "clinic_reviews", "ray_start", "ray_end", "reach_start", "reach_end"]


def profile_master(spark: SparkSession, sf: str) -> DataFrame:
    """The master of the stand-in tables (see the module docstring)."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"])
    doctor = F.col("c_custkey").alias("doctor_id")
    sup = read_table(spark, sf, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf, "region", ["r_regionkey", "r_name"])
    spine = master_spine(
        c.select(F.col("c_custkey").alias("pd_id"), doctor, S.per_locality("c_custkey").alias("practice_id"),
                 F.when(F.col("c_mktsegment") == "BUILDING", ABS_STATUS).otherwise(F.col("c_mktsegment")).alias("status")),
        sup.select(F.col("s_suppkey").alias("practice_id"), F.col("s_nationkey").alias("ray_practice_id"),
                   F.col("s_name").alias("clinic_name"), F.col("s_nationkey").alias("locality_id")),
        n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
            F.col("n_nationkey").alias("locality_id"), F.col("n_name").alias("locality"), F.col("n_name").alias("city"),
            F.col("r_name").alias("country")),
        c.where(~(F.col("c_acctbal") < 0)).select(doctor, F.col("c_name").alias("doctor_name")),
        c.select(doctor, F.when(F.col("c_mktsegment") != "AUTOMOBILE", VERIFIED).otherwise("PENDING").alias("verification_status")))

    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"])
    events = read_table(spark, sf, "events", ["user_id", "ts", "event_type"])
    li = read_table(spark, sf, "lineitem", ["l_suppkey", "l_partkey", "l_returnflag", "l_linestatus"])
    parts = read_table(spark, sf, "part", ["p_partkey", "p_type"])
    lines = _doctor_lines(spark, sf).select(
        "doctor_id", "p_brand", "l_returnflag", F.col("o_orderdate").cast("timestamp").alias("o_time"), F.col("o_orderkey").alias("registration_id"),
        "l_linenumber", F.col("l_partkey").alias("speciality_id"), "practice_id")
    text = lambda c: Text(c, value_fn=whitelist_strip)
    ordered = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"]).select(
        F.col("o_orderdate").cast("timestamp").alias("o_time"), F.col("o_orderkey").alias("registration_id"))
    sold = read_table(spark, sf, "lineitem", ["l_linenumber", "l_partkey", "l_suppkey"]).select(
        "l_linenumber", F.col("l_partkey").alias("speciality_id"), F.col("l_suppkey").alias("practice_id"))
    first_line = First(("registration_id", "speciality_id"), ("o_time", "registration_id", "l_linenumber", "speciality_id", "practice_id"),
                       found_in=(ordered, sold))
    doctor_children = [
        Child(lines, "doctor_id", {"awards": text("p_brand"), "qualifications": text("l_returnflag"),
                                   "doctor_photos": count_rows(F.col("l_returnflag") == "R"), "first_line": first_line}),
        Child(orders, "o_custkey", {"memberships": text("o_orderpriority"), "services": text("o_orderstatus"),
                                    "organizations": count_rows()}),
        Child(events, "user_id", {"last_login": Measure("ts", F.max), "doctor_reviews": count_rows(F.col("event_type") == "click")}),
        Child(c.where(F.col("c_acctbal") > 0), "c_custkey", {"recommendation": Measure(F.floor("c_acctbal").cast("long"), F.max)}),
    ]
    logo = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0)
    practice_lines = li.join(parts, li.l_partkey == parts.p_partkey)
    practice_children = [Child(practice_lines, "l_suppkey", {
        "type": Text("p_type", distinct=True), "number_of_photos": count_rows(), "logo_presence": Measure(logo, F.sum),
        "clinic_reviews": count_rows(F.col("l_linestatus") == "F")})]

    def terms(rows: DataFrame, missing: int, first: str, last: str) -> Child:
        group, day = (F.col("o_custkey") % 25).cast("int"), F.col("o_orderdate").cast("date")
        return Child(rows, F.when(group != missing, group), {first: Measure(day, F.min), last: Measure(day, F.max)})

    external_children = [terms(orders, 24, "ray_start", "ray_end"),
                         terms(orders.where(F.col("o_orderstatus") == "F"), 23, "reach_start", "reach_end")]
    return master_from(spine, doctor_children, practice_children, external_children,
                       parts.select(F.col("p_partkey").alias("speciality_id"), F.col("p_type").alias("speciality")))


def mapping_from(master: DataFrame) -> DataFrame:
    return master.select("pd_id", "doctor_id", "practice_id", "ray_practice_id", "speciality", "locality", "city", "country",
                         "number_of_photos")


def profile_mapping(spark: SparkSession, sf: str) -> DataFrame:
    return mapping_from(profile_master(spark, sf))


def split_from(master: DataFrame, countries: list[str] = SPLIT_COUNTRIES) -> DataFrame:
    """Rows of the listed countries (case-folded), tagged for a partitioned write."""
    key = F.lower(F.col("country"))
    return master.where(key.isin(*countries)).withColumn("country_key", key)


def country_split(spark: SparkSession, sf: str) -> DataFrame:
    return split_from(profile_master(spark, sf))


def international_from(master: DataFrame, home: str = HOME_COUNTRY) -> DataFrame:
    """Every country but home: case-sensitive, a missing country is dropped."""
    return master.where(F.col("country") != home)


def international_only(spark: SparkSession, sf: str) -> DataFrame:
    return international_from(profile_master(spark, sf))


def practice_id_map(spark: SparkSession, sf: str) -> DataFrame:
    return id_map_from(profile_master(spark, sf), slugged_practices(spark, sf))


def slugged_practices(spark: SparkSession, sf: str) -> DataFrame:
    sup = read_table(spark, sf, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf, "region", ["r_regionkey", "r_name"])
    return (sup.join(n, sup.s_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
               .select(F.col("s_nationkey").alias("ray_practice_id"), F.lower("s_name").alias("new_slug"),
                       F.col("n_name").alias("locality"), F.col("r_name").alias("city")))


def id_map_from(master: DataFrame, practices: DataFrame) -> DataFrame:
    """External practice id -> first practice, slug, locality, city, ABS count, specialities.

    The source right-joins profile rows to practice rows on the external id
    (both sides repeat it), dedupes, counts ABS rows and keeps the first row.
    Those results are computed per id from each side without forming the
    pairs: the first pair is (smallest practice id, first practice row by
    slug); the number of distinct ABS pairs is the product of the distinct
    ABS practice ids and the distinct practice rows.
    """
    prac = practices.where(F.col("ray_practice_id").isNotNull()).distinct()
    prac_first = keep_first(prac, ["ray_practice_id"], ["new_slug", "locality", "city"])
    prac_n = prac.groupBy("ray_practice_id").agg(F.count(F.lit(1)).alias("_rows"))
    # one pass over the profile rows per external id: first practice, distinct
    # ABS practices, distinct specialities (a set: bounded by distinct values)
    prof_agg = master.where(F.col("ray_practice_id").isNotNull()).groupBy("ray_practice_id").agg(
        F.min("practice_id").alias("practice_id"),
        F.count_distinct(F.when(F.col("status") == ABS_STATUS, F.col("practice_id"))).alias("_abs"),
        F.array_join(F.sort_array(F.collect_set("speciality")), "|").alias("_spec"))
    j = (prac_first.join(prac_n, "ray_practice_id").join(prof_agg, "ray_practice_id", "left")
                   .withColumn("speciality", F.when(F.col("_spec") != "", F.col("_spec"))))
    abs_n = F.when(F.col("_abs") > 0, F.col("_abs") * F.col("_rows"))
    return j.select("ray_practice_id", "practice_id", "new_slug", "locality", "city",
                    abs_n.alias("abs_enabled"), "speciality")


# ------------------------------------------------------------ text / events
def collapse_text_q(spark: SparkSession, sf: str) -> DataFrame:
    """Brands on each customer's order lines, whitelist-stripped, '|'-joined in value order."""
    lines = _doctor_lines(spark, sf).select(F.col("doctor_id").alias("practice_id"), F.col("p_brand").alias("brand"))
    return collapse_text(lines, ["practice_id"], "brand", "brands", value_fn=whitelist_strip)


def collapse_text_distinct_q(spark: SparkSession, sf: str) -> DataFrame:
    lines = _doctor_lines(spark, sf).select(F.col("doctor_id").alias("practice_id"), F.col("p_brand").alias("brand"))
    return collapse_text(lines, ["practice_id"], "brand", "brands", distinct=True)


def text_whitelist(spark: SparkSession, sf: str) -> DataFrame:
    d = read_table(spark, sf, "documents", ["doc_id", "text"])
    return d.select("doc_id", whitelist_strip(F.col("text")).alias("clean_text"))


def keep_first_q(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    return keep_first(ev, ["user_id"], ["ts", "event_id"])


def photo_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Count and sum at one grain; a group whose values are all missing keeps
    its count and gets a missing sum."""
    ev = read_table(spark, sf, "events", ["user_id", "event_type", "value"])
    v = F.when(F.col("event_type") != "error", F.col("value").cast("decimal(18,2)"))
    return ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"),
                                     F.sum(v).cast("double").alias("value_sum"))


def key_concat(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    k = r_paste0(F.col("o_custkey"), F.col("o_orderstatus"))
    return o.select(F.col("o_orderkey").alias("order_id"), k.alias("practice_code"),
                    r_paste(F.col("o_orderdate").cast("date"), k).alias("order_practice_code"))

