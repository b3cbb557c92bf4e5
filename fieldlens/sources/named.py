"""Statements over tables by their qualified names.

Reports that exist as SQL text name their tables as the operational databases
do (``orders.plan``, ``geo.city``) or rely on a current database.  Here each
such name is a catalogue view on files, so that the text runs as it is: Spark
resolves the names, and its optimiser sees through the views to the scans.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from fieldlens.sources.tables import TABLES


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def publish_names(spark: SparkSession, folder: str, views: Mapping[str, str],
                  files: Mapping[str, str] | None = None) -> None:
    """Define ``database.name`` -> ``SELECT`` text as views of the session's
    catalogue, in the given order (a view may use earlier ones).

    In the text, ``{table}`` stands for a table's files: those of ``files``
    (name -> Parquet path), by default the test tables below ``folder``.  A
    database that does not exist is made; it holds views only, and nothing is
    written to ``folder``, which is its location.  A view of that name is
    replaced (frames made before keep what they read), a table is not: Spark
    raises an error."""
    folder = folder.rstrip("/")
    paths = files if files is not None else {t: f"{folder}/{t}.parquet" for t in TABLES}
    sources = {name: "parquet." + "`" + path.replace("`", "``") + "`" for name, path in paths.items()}
    location = folder.replace("\\", "\\\\").replace("'", "\\'")
    for database in dict.fromkeys(name.rpartition(".")[0] for name in views):
        if not database:
            raise ValueError("a published name needs a database")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)} LOCATION '{location}'")
    for name, select in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS {select.format(**sources)}")


def run_statement(spark: SparkSession, text: str, database: str | None = None, **parameters) -> DataFrame:
    """The frame of a ``SELECT`` over published names.  Bare names are looked
    up in ``database`` (the session's current one is the same afterwards);
    ``:name`` in the text takes the value of a parameter."""
    before = spark.catalog.currentDatabase()
    if database is not None:
        spark.catalog.setCurrentDatabase(database)
    try:
        return spark.sql(text, args=parameters or None)
    finally:
        spark.catalog.setCurrentDatabase(before)
