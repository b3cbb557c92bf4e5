"""End-to-end publishing jobs: run the reports and write the datasets the
spreadsheet front end reads.

``publish_dashboard``  metrics sheet, the report month's orders (month-named
                       partition), the three-month orders, the slot inventory
                       without renewals, orders with contact names, and the
                       roster with row numbers (as a new version, made from
                       the zones of the published one).
``publish_profiles``   profile master (dated snapshot + latest), profile
                       mapping, the per-country split, the international
                       complement and the practice-id map.

Each output is one Spark write (one job); nothing is collected.  The as-of
and snapshot dates are arguments.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.plans import inventory, profiles, sales
from fieldlens.plans import standins as S
from fieldlens.sinks import update_version, write_by_month, write_csv, write_snapshot_and_latest, write_split
from fieldlens.sinks.writers import remove


class _Staging:
    """Frames that several outputs are made of, written once below a folder
    of this run's own: two runs into one output do not share any."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.folder = spark, f"{out.rstrip('/')}/staging/{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        remove(self.spark, self.folder)


def publish_dashboard(spark: SparkSession, sf: str, out: str, as_of: str = S.AS_OF) -> dict[str, str]:
    paths = {k: os.path.join(out, k) for k in ["metrics", "orders_month", "orders_three_months", "inventory",
                                               "orders_with_contact", "teams"]}
    slots, places = sales.live_slots(S.slots(spark, sf)), S.slot_places(spark, sf)
    staged = _Staging(spark, out)
    # the cleaned three months are the base of all order outputs
    cleaned = staged(sales.in_period(sales.clean_orders(S.plan_orders(spark, sf)), as_of, three_months=True), "orders")
    month = staged(sales.month_orders(cleaned, slots, places, as_of), "month_orders")
    write_csv(sales.sheet_from(month, S.roster_managers(spark, sf), S.roster_reps(spark, sf)), paths["metrics"])
    write_by_month(sales.sales_plans(month).drop("currency", "discount"), paths["orders_month"], "placed_date")
    write_csv(cleaned.drop("currency", "city", "discount"), paths["orders_three_months"])
    write_csv(inventory.slot_inventory_from(slots, month, places), paths["inventory"])
    write_csv(sales.q_orders_with_contact(spark, sf), paths["orders_with_contact"])
    # the published roster names the zones of the next one; a run that lost
    # against another one raises VersionConflict
    paths["teams"] = update_version(
        spark, paths["teams"], lambda before: sales.next_roster(before, S.roster_managers(spark, sf), S.roster_reps(spark, sf)), fmt="csv")
    staged.clear()
    return paths


def publish_profiles(spark: SparkSession, sf: str, out: str, snapshot_date: str) -> dict[str, str]:
    """The master is built once; the other outputs are read from it."""
    paths = {k: os.path.join(out, k) for k in ["profiles", "profile_mapping", "by_country", "international",
                                               "practice_id_map"]}
    staged = _Staging(spark, out)
    master = staged(profiles.profile_master(spark, sf), "profiles")
    write_snapshot_and_latest(master, paths["profiles"], snapshot_date, fmt="csv")
    write_csv(profiles.mapping_from(master), paths["profile_mapping"])
    split = profiles.split_from(master)
    write_split(split.drop("country_key"), paths["by_country"], F.lower(F.col("country")), name="country")
    write_csv(profiles.international_from(master), paths["international"])
    write_csv(profiles.id_map_from(master, profiles.slugged_practices(spark, sf)), paths["practice_id_map"])
    staged.clear()
    return paths


def main(argv: list[str] | None = None) -> None:
    """``python -m fieldlens.plans.publish <tables_dir> <out_dir> <as_of> [dashboard|profiles|all]``"""
    import sys

    from fieldlens.session import build_session
    args = argv if argv is not None else sys.argv[1:]
    tables_dir, out_dir, as_of = args[:3]
    which = args[3] if len(args) > 3 else "all"
    spark = build_session(app="fieldlens-publish")
    if which in ("dashboard", "all"):
        publish_dashboard(spark, tables_dir, os.path.join(out_dir, "dashboard"), as_of)
    if which in ("profiles", "all"):
        publish_profiles(spark, tables_dir, os.path.join(out_dir, "profiles"), as_of)
    spark.stop()


if __name__ == "__main__":
    main()
