"""Registry of named queries: ``QUERIES[name](spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from functools import wraps

from fieldlens.plans import coverage, inventory, profiles, sales, statements
from fieldlens.sources.tables import shared_reads


def _shared(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with shared_reads():
            return fn(spark, sf_dir)
    return run


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "renewal_label": inventory.renewal_label,
    "renewal_label_shared": inventory.renewal_label_shared,
    "slot_inventory": inventory.slot_inventory,
    "active_as_of": inventory.active_as_of,
    "available_inventory": inventory.available_inventory,
    "ad_catalog": inventory.ad_catalog,
    "first_slot_city": inventory.first_slot_city,
    "orders_two_roles": inventory.orders_two_roles,
    "orders_cleanup": sales.q_orders_cleanup,
    "orders_month_window": sales.q_orders_month_window,
    "orders_month_published": sales.q_orders_month_published,
    "orders_three_month_window": sales.q_orders_three_month_window,
    "reporting_period": sales.q_reporting_period,
    "plan_class_flags": sales.q_plan_class_flags,
    "plan_class_counts": sales.q_plan_class_counts,
    "count_by_key": sales.q_count_by_key,
    "revenue_by_rep": sales.q_revenue_by_rep,
    "role_gates": sales.q_role_gates,
    "safe_ratio": sales.q_safe_ratio,
    "scorecard": sales.q_scorecard,
    "leadership_rollup": sales.q_leadership_rollup,
    "metrics_sheet": sales.q_metrics_sheet,
    "attribution_share": sales.q_attribution_share,
    "team_roster_union": sales.q_team_roster_union,
    "roster_sorted": sales.q_roster_sorted,
    "sale_day_discount": sales.q_sale_day_discount,
    "sale_day_plan_revenue": sales.q_sale_day_plan_revenue,
    "orders_with_contact": sales.q_orders_with_contact,
    "orders_city_backfill": sales.q_orders_city_backfill,
    "rep_revenue_since": sales.q_rep_revenue_since,
    "city_coverage": coverage.city_coverage,
    "establishment_detail": coverage.establishment_detail,
    "distinct_clinics": coverage.distinct_clinics,
    "clinic_flag_rows": coverage.clinic_flag_rows,
    "locality_fanout_count": coverage.locality_fanout_count,
    "clinics_by_locality": coverage.clinics_by_locality,
    "practice_count_all_localities": coverage.practice_count_all_localities,
    "territory_rep_map": coverage.territory_rep_map,
    "practice_territory_map": coverage.practice_territory_map,
    "locality_geo": coverage.locality_geo,
    "region_owner_listing": coverage.region_owner_listing,
    "salesregion_listing": coverage.salesregion_listing,
    "sales_owner_listing": coverage.sales_owner_listing,
    "user_listing": coverage.user_listing,
    "literal_in_filters": coverage.literal_in_filters,
    "regex_name_lookup": coverage.regex_name_lookup,
    "scan_active_rows": coverage.scan_active_rows,
    "top_sources": coverage.top_sources,
    "profile_master": profiles.profile_master,
    "profile_mapping": profiles.profile_mapping,
    "country_split": profiles.country_split,
    "international_only": profiles.international_only,
    "practice_id_map": profiles.practice_id_map,
    "collapse_text": profiles.collapse_text_q,
    "collapse_text_distinct": profiles.collapse_text_distinct_q,
    "text_whitelist": profiles.text_whitelist,
    "keep_first": profiles.keep_first_q,
    "photo_stats": profiles.photo_stats,
    "key_concat": profiles.key_concat,
    "ad_catalog_statement": statements.ad_catalog_statement,
    "two_roles_statement": statements.two_roles_statement,
    "running_slots_statement": statements.running_slots_statement,
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _shared(f) for k, f in _QUERIES.items()}
