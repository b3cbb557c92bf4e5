"""Field coverage, territory and lookup reports.

* ``city_coverage`` / ``establishment_detail``: clinics covered per city and
  the establishment rows behind the counts.
* ``distinct_clinics`` / ``clinic_flag_rows`` / ``locality_fanout_count``:
  the locality variants.  The source joins localities on the *city* id, which
  repeats each establishment once per locality of its city; the counts are
  computed at city grain and then attached or multiplied by the locality
  count, which gives the same numbers without materialising the fan-out.
* ``clinics_by_locality`` / ``practice_count_all_localities``: practices
  per sales locality (inner, and all localities with zero counts).
* ``territory_rep_map`` / ``practice_territory_map``: practice -> locality ->
  territory -> rep chains within one country; a locality without a territory
  is kept (the deletion test is on the right side of a left join).
* ``region_owner_listing`` and its three component listings.
* ``literal_in_filters`` / ``regex_name_lookup`` / ``scan_active_rows`` /
  ``top_sources``: master-data lookups.

The ``*_from`` functions take frames with the reports' own column names; the
others bind them to the stand-in views.

Grouping is by id *and* name (two cities sharing a name stay apart); pass
``merge_same_name=True`` to merge them under the smallest id instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions import collated
from fieldlens.plans import standins as S
from fieldlens.sources.tables import read_table


def covered_rows(establishments: DataFrame, segments: DataFrame, modules: DataFrame, cities: DataFrame,
                 city_ids: list[int] | None = None, country_ids: list[int] | None = None,
                 codes: list[str] = S.COVERAGE_CODES) -> DataFrame:
    """Establishment x segment rows that pass the coverage WHERE clause, with their city.

    The segment and city joins are written as left joins in the source but
    the WHERE clause rejects missing segments, so the segment join is inner.
    """
    cond = ((F.col("e.visit_status").isin(*codes) | F.col("e.visit_status").isNull()
             | F.col("es.visit_status").isin(*codes)) & F.col("e.deleted_at").isNull())
    if city_ids is not None:
        cond = cond & F.col("c.id").isin(*city_ids)
    if country_ids is not None:
        cond = cond & F.col("c.country_id").isin(*country_ids)
    return _first_segments(establishments, segments, modules, cities).where(cond)


def _first_segments(establishments, segments, modules, cities) -> DataFrame:
    e, es, m, c = establishments.alias("e"), segments.alias("es"), modules.alias("m"), cities.alias("c")
    return (e.join(es, F.col("e.id") == F.col("es.establishment_id"))
             .join(m, F.col("e.module_id") == F.col("m.id"), "left")
             .join(c, F.col("c.id") == F.col("m.city_id"), "left").where(F.col("es.segment_id") == 1))


def _sources(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return S.establishments(spark, sf), S.segments(spark, sf), S.modules(spark, sf), S.cities(spark, sf)


def _covered_rows(spark: SparkSession, sf: str, cities: list[int] | None = None,
                  countries: list[int] | None = None) -> DataFrame:
    return covered_rows(*_sources(spark, sf), city_ids=cities, country_ids=countries)


def _total_flag(codes=S.COVERAGE_CODES) -> Column:
    return F.when((F.col("es.visit_status").isNull() | F.col("es.visit_status").isin(*codes))
                  & (F.col("es.segment_id") == 1) & F.col("e.deleted_at").isNull(), 1).otherwise(0)


def _platinum_flag() -> Column:
    # e IN ('PC') OR (es = 'PC' AND not deleted AND segment 1): AND binds tighter than OR
    return F.when(F.col("e.visit_status").isin(S.PLATINUM_CODE)
                  | ((F.col("es.visit_status") == S.PLATINUM_CODE) & F.col("e.deleted_at").isNull()
                     & (F.col("es.segment_id") == 1)), 1).otherwise(0)


def _city_keys(merge_same_name: bool, collation: str | None = None):
    name = collated(F.col("c.name"), collation)
    return ([name.alias("city")], [F.min("c.id").alias("city_id")]) if merge_same_name else \
           ([F.col("c.id").alias("city_id"), F.col("c.name").alias("city")], [])


def city_coverage_from(rows: DataFrame, merge_same_name: bool = False, collation: str | None = None) -> DataFrame:
    """``merge_same_name`` groups by name only (smallest id shown); with
    ``collation='UTF8_LCASE'`` names differing only in case merge too."""
    keys, extra = _city_keys(merge_same_name, collation)
    return rows.groupBy(*keys).agg(*extra, F.sum(_total_flag()).alias("total_clinics"),
                                   F.sum(_platinum_flag()).alias("platinum")) \
               .select("city_id", "city", "total_clinics", "platinum")


def city_coverage(spark: SparkSession, sf: str, cities: list[int] | None = None,
                  merge_same_name: bool = False, collation: str | None = None) -> DataFrame:
    return city_coverage_from(_covered_rows(spark, sf, cities), merge_same_name, collation)


def establishment_detail_from(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("c.id").alias("city_id"), F.col("c.name").alias("city"), F.col("e.id").alias("id"),
                       F.col("e.name").alias("name"), F.col("e.balance").alias("balance"),
                       F.col("e.software").alias("software"), F.col("e.visit_status").alias("visit_status"))


def establishment_detail(spark: SparkSession, sf: str, cities: list[int] | None = None) -> DataFrame:
    return establishment_detail_from(_covered_rows(spark, sf, cities))


def distinct_clinics_from(establishments: DataFrame, segments: DataFrame, modules: DataFrame, cities: DataFrame,
                          localities: DataFrame) -> DataFrame:
    """Distinct covered establishments per city, shown on each of the city's localities."""
    j = _first_segments(establishments, segments, modules, cities)
    # count(distinct case when p then id end): no ELSE, so failing rows add nothing
    per_city = j.groupBy(F.col("c.id").alias("city_id"), F.col("c.name").alias("city")).agg(
        F.count_distinct(F.when(_total_flag() == 1, F.col("e.id"))).alias("total_clinics"))
    out = per_city.join(localities, per_city.city_id == localities.city_id, "left")
    return out.select(per_city.city_id, "city", F.col("name").alias("locality"), "total_clinics")


def distinct_clinics(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_clinics_from(*_sources(spark, sf), S.localities(spark, sf))


def clinic_flag_rows_from(rows: DataFrame, localities: DataFrame) -> DataFrame:
    """Row-level coverage flag per covered establishment segment.

    The source repeats every row once per locality of the city (the
    locality join is on the city id) and shows that locality's name.  Those
    repeats are all pairs of (establishment row, locality) within a city, so
    here each row carries its city's locality count and the first locality
    name instead; the repeated rows are recoverable by joining localities on
    the city id."""
    nloc = localities.groupBy(F.col("city_id").alias("_cid")).agg(
        F.count(F.lit(1)).alias("localities"), F.min("name").alias("first_locality"))
    j = rows.join(nloc, F.col("c.id") == F.col("_cid"), "left")
    return j.select(F.col("e.id").alias("establishment_id"), F.col("es.segment_row_id").alias("segment_row_id"),
                    F.col("c.id").alias("city_id"), F.col("c.name").alias("city"),
                    F.coalesce(F.col("localities"), F.lit(0)).alias("localities"), "first_locality",
                    _total_flag().alias("total_clinics"))


def clinic_flag_rows(spark: SparkSession, sf: str, countries: list[int] | None = None) -> DataFrame:
    return clinic_flag_rows_from(_covered_rows(spark, sf, countries=countries), S.localities(spark, sf))


def locality_fanout_from(rows: DataFrame, localities: DataFrame) -> DataFrame:
    """City totals as the fan-out join produces them: each covered row counted
    once per locality of its city (once when the city has none)."""
    per_city = rows.groupBy(F.col("c.id").alias("city_id"), F.col("c.name").alias("city")).agg(
        F.sum(_total_flag()).alias("_t"))
    nloc = localities.groupBy(F.col("city_id").alias("_cid")).agg(F.count(F.lit(1)).alias("_n"),
                                                                  F.min("name").alias("locality"))
    j = per_city.join(nloc, per_city.city_id.eqNullSafe(nloc._cid), "left")
    return j.select("city_id", "city", "locality",
                    (F.col("_t") * F.greatest(F.coalesce(F.col("_n"), F.lit(0)), F.lit(1))).alias("total_clinics"))


def locality_fanout_count(spark: SparkSession, sf: str, countries: list[int] | None = None) -> DataFrame:
    return locality_fanout_from(_covered_rows(spark, sf, countries=countries), S.localities(spark, sf))


def clinics_by_locality_from(practices: DataFrame, localities: DataFrame, cities: DataFrame) -> DataFrame:
    """Practices per sales locality, by locality name."""
    cp, sml, mc = practices.alias("cp"), localities.alias("sml"), cities.alias("mc")
    j = (cp.join(sml, F.col("cp.sales_localities_id") == F.col("sml.id"))
           .join(mc, F.col("mc.id") == F.col("sml.city_id")))
    return j.groupBy(F.col("mc.id").alias("city_id"), F.col("mc.name").alias("city"),
                     F.col("sml.id").alias("locality_id"), F.col("sml.name").alias("locality")) \
            .agg(F.count(F.col("cp.id")).alias("clinics")).orderBy("locality", "locality_id")


def clinics_by_locality(spark: SparkSession, sf: str) -> DataFrame:
    return clinics_by_locality_from(S.practices(spark, sf), S.localities(spark, sf), S.cities(spark, sf))


def practice_count_from(localities: DataFrame, practices: DataFrame) -> DataFrame:
    """Practices of every locality, fewest first; practices are counted before
    the join, so nothing fans out."""
    csl = localities.alias("csl")
    cp = practices.groupBy("sales_localities_id").agg(F.count("id").alias("_n")).alias("cp")
    j = csl.join(cp, F.col("csl.id") == F.col("cp.sales_localities_id"), "left")
    return j.select(F.coalesce(F.col("cp._n"), F.lit(0)).alias("practice_count"),
                    F.col("csl.city_id").alias("city_id"), F.col("csl.id").alias("locality_id"),
                    F.col("csl.name").alias("name")).orderBy("practice_count", "locality_id")


def practice_count_all_localities(spark: SparkSession, sf: str) -> DataFrame:
    return practice_count_from(S.localities(spark, sf), S.practices(spark, sf))


# Fixed value: the country of the territory maps.
MAP_COUNTRY = 1


def _interactions(spark: SparkSession, sf: str) -> DataFrame:
    """Practice -> rep contacts: the suppliers on each customer's order lines."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_suppkey"])
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .select(F.col("o_custkey").alias("practice_id"), F.col("l_suppkey").alias("user_id")).distinct())


def _locality_reps(practices: DataFrame, interactions: DataFrame) -> DataFrame:
    """Distinct (locality, rep) ids: a practice without contacts keeps its
    locality, one without a locality its reps.  Names come later, so text
    columns never ride through the large join."""
    return (practices.join(interactions, practices.id == interactions.practice_id, "left")
            .select(F.col("sales_localities_id").alias("locality"), F.col("user_id").alias("rep")).distinct())


def territory_rows(pairs: DataFrame, localities: DataFrame, locality_territories: DataFrame, cities: DataFrame,
                   territories: DataFrame, countries: DataFrame, users: DataFrame, owners: DataFrame | None,
                   country: int) -> DataFrame:
    """Names of (locality, rep) pairs of one country.

    The country test rejects missing cities; a locality without a territory is
    kept, one whose territory is deleted is not."""
    sml, smc, smco = localities.alias("sml"), cities.alias("smc"), countries.where(F.col("id") == country).alias("smco")
    cltm, cs, epi = locality_territories.alias("cltm"), territories.alias("cs"), users.alias("epi")
    j = (pairs.join(sml, F.col("locality") == F.col("sml.id"))
              .join(smc, F.col("smc.id") == F.col("sml.city_id"))
              .join(smco, F.col("smco.id") == F.col("smc.country_id"))
              .join(cltm, F.col("cltm.locality_id") == F.col("sml.id"), "left")
              .join(cs, F.col("cs.id") == F.col("cltm.territory_id"), "left")
              .where(F.col("cs.deleted_at").isNull())
              .join(epi, F.col("rep") == F.col("epi.id"), "left"))
    return j if owners is None else j.join(owners.alias("cso"), F.col("cso.region_id") == F.col("cs.id"), "left")


def _territory_rows(spark: SparkSession, sf: str, practices: DataFrame, owners: bool, country: int) -> DataFrame:
    users = read_table(spark, sf, "supplier", ["s_suppkey", "s_name"]).select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return territory_rows(_locality_reps(practices, _interactions(spark, sf)), S.localities(spark, sf),
                          S.locality_territories(spark, sf), S.cities(spark, sf), S.territories(spark, sf), S.states(spark, sf),
                          users, S.territory_owners(spark, sf) if owners else None, country)


def territory_rep_map(spark: SparkSession, sf: str, country: int = MAP_COUNTRY) -> DataFrame:
    """Practices with a lead -> locality -> territory, its owner, city and rep."""
    leads = read_table(spark, sf, "orders", ["o_custkey"]).select(F.col("o_custkey").alias("id"))
    j = _territory_rows(spark, sf, S.practices(spark, sf).join(leads, "id", "left_semi"), True, country)
    return j.select(F.col("cltm.territory_id").alias("territory_id"), F.col("smc.id").alias("city_id"),
                    F.col("cso.region_id").alias("region_id"), F.col("cs.parent_id").alias("parent_id"),
                    F.col("cso.user_id").alias("manager_id"), F.col("smc.name").alias("city_name"),
                    F.col("sml.name").alias("locality_name"), F.col("cs.name").alias("territory_name"),
                    F.col("epi.name").alias("psw_name"), F.lower(F.col("epi.name")).alias("psw_email")).distinct()


def practice_territory_map(spark: SparkSession, sf: str, country: int = MAP_COUNTRY) -> DataFrame:
    """Every practice -> locality -> territory -> city / country -> rep."""
    j = _territory_rows(spark, sf, S.practices(spark, sf), False, country)
    return j.select(F.col("smc.id").alias("city_id"), F.col("smco.name").alias("country_name"),
                    F.col("smc.name").alias("city_name"), F.col("sml.name").alias("locality_name"),
                    F.col("cs.name").alias("territory_name"), F.col("epi.name").alias("psw_name"),
                    F.lower(F.col("epi.name")).alias("psw_email")).distinct()


def locality_geo_from(localities: DataFrame, cities: DataFrame, states: DataFrame, locality_pattern: str | None = None,
                      state_pattern: str | None = None) -> DataFrame:
    """Localities with city and state, by locality name."""
    sml, smc, sms = localities.alias("sml"), cities.alias("smc"), states.alias("sms")
    j = (sml.join(smc, F.col("smc.id") == F.col("sml.city_id"), "left")
            .join(sms, F.col("sms.id") == F.col("smc.state_id"), "left"))
    if locality_pattern:
        j = j.where(F.col("sml.name").rlike(locality_pattern))
    if state_pattern:
        j = j.where(F.col("sms.name").rlike(state_pattern))
    return j.select(F.col("sml.name").alias("locality"), F.col("smc.name").alias("city"),
                    F.col("sms.name").alias("state")).orderBy("locality")


def locality_geo(spark: SparkSession, sf: str, locality_pattern: str | None = None,
                 state_pattern: str | None = None) -> DataFrame:
    return locality_geo_from(S.localities(spark, sf), S.cities(spark, sf), S.states(spark, sf), locality_pattern, state_pattern)


# The owner role and team the hierarchy listing is for.
OWNER_ROLE, OWNER_TEAM = "SALES", 7


def _owners(spark, sf):
    s = read_table(spark, sf, "supplier", ["s_suppkey", "s_nationkey", "s_acctbal"])
    return s.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("region_id"),
                    F.col("s_suppkey").alias("user_id"),
                    F.when(F.col("s_acctbal") >= 0, "SALES").otherwise("SUPPORT").alias("role"))


def _users(spark, sf):
    s = read_table(spark, sf, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    return s.select(F.col("s_suppkey").alias("user_pk"), F.lower("s_name").alias("email"),
                    F.col("s_name").alias("name"), F.col("s_nationkey").alias("city"))


def _salesregions(spark, sf):
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    return n.select(F.col("n_nationkey").alias("id"), F.lit(2).alias("salesregion_type_id"),
                    F.col("n_regionkey").alias("parent_id"), F.col("n_name").alias("name"),
                    F.when(F.col("n_regionkey") < 4, F.lit(7)).otherwise(F.lit(9)).alias("team_id"))


def region_owner_listing_from(owners: DataFrame, users: DataFrame, regions: DataFrame, role: str, team: int) -> DataFrame:
    """Who owns which region.  The source selects two columns twice under one
    name; the second copy gets a ``_ref`` suffix so the result can be written."""
    cso, eu, csr = owners.alias("cso"), users.alias("eu"), regions.alias("csr")
    j = (cso.join(eu, F.col("cso.user_id") == F.col("eu.user_pk"), "left")
            .join(csr, F.col("csr.id") == F.col("cso.region_id"), "left")
            .where((F.col("cso.role") == role) & (F.col("csr.team_id") == team)))
    return j.select(F.col("cso.id").alias("id"), F.col("cso.region_id").alias("region_id"),
                    F.col("csr.id").alias("region_id_ref"), F.col("csr.name").alias("geo_location"),
                    F.col("cso.user_id").alias("owner_id"), F.col("eu.user_pk").alias("owner_id_ref"),
                    F.col("eu.email").alias("owner_email"), F.col("cso.role").alias("role"),
                    F.col("csr.parent_id").alias("parent_geo_location"), F.col("csr.team_id").alias("team"))


def region_owner_listing(spark: SparkSession, sf: str, role: str = OWNER_ROLE, team: int = OWNER_TEAM) -> DataFrame:
    return region_owner_listing_from(_owners(spark, sf), _users(spark, sf), _salesregions(spark, sf), role, team)


def salesregion_listing(spark: SparkSession, sf: str, team: int = OWNER_TEAM) -> DataFrame:
    return _salesregions(spark, sf).where(F.col("team_id") == team)


def sales_owner_listing(spark: SparkSession, sf: str, role: str = OWNER_ROLE) -> DataFrame:
    return _owners(spark, sf).where(F.col("role") == role)


def user_listing(spark: SparkSession, sf: str) -> DataFrame:
    return _users(spark, sf)


# The city-id list of the locality lookup.
LOOKUP_CITY_IDS = [2, 3, 5, 7, 11, 13, 17, 19, 23]
# Fixed value: the name pattern of the regex lookup (case-insensitive).
LOOKUP_PATTERN = "(?i)^(red|small) "


def literal_in_filters(spark: SparkSession, sf: str, city_ids: list[int] = LOOKUP_CITY_IDS) -> DataFrame:
    """Localities of a list of cities (an OR chain of equalities = IN)."""
    sml = S.localities(spark, sf).alias("sml")
    smc = S.cities(spark, sf).alias("smc")
    j = sml.join(smc, F.col("sml.city_id") == F.col("smc.id"), "left").where(F.col("sml.city_id").isin(*city_ids))
    return j.select(F.col("sml.city_id").alias("city_id"), F.col("smc.name").alias("city_name"),
                    F.col("sml.name").alias("locality_name"))


def regex_name_lookup(spark: SparkSession, sf: str, pattern: str = LOOKUP_PATTERN) -> DataFrame:
    p = read_table(spark, sf, "part", ["p_partkey", "p_name", "p_type"])
    return p.where(F.col("p_name").rlike(pattern)).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                                                          F.col("p_type").alias("type"))


def scan_active_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that are not deleted.  The stand-in's deletion mark is a negative
    balance, tested on the base column so that the reader can skip."""
    live = F.col("balance").isNull() | (F.col("balance") >= 0)
    return S.establishments(spark, sf).where(live).select("id", "name", "module_id")


def top_sources(spark: SparkSession, sf: str, source: str = "click", k: int = 10) -> DataFrame:
    """Top-k ids by row count for one source, ties broken by id."""
    ev = read_table(spark, sf, "events", ["user_id", "event_type"])
    return (ev.where(F.col("event_type") == source).groupBy(F.col("user_id").alias("id"))
              .agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("id").asc()).limit(k))
