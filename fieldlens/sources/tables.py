"""Table loading.

Production reads the operational tables over JDBC (``spark.read.jdbc`` with
``partitionColumn`` / ``numPartitions`` so the extract is parallel); the test
tables are parquet.  Either way the caller names the columns it needs, so the
scan reads only those (``ReadSchema`` in the plan) and later filters are pushed
into the scan by Catalyst.
"""

from __future__ import annotations

from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


# Declared schemas of the tables the reports read.  Reading with a declared
# schema skips footer-based inference on the driver (about 4x faster to open
# here, and on a cluster the schema cannot drift with whichever file is
# sampled); other tables fall back to inference.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def _open(spark: SparkSession, path: str, name: str) -> DataFrame:
    schema = SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


_SHARED: ContextVar[dict | None] = ContextVar("fieldlens_shared_reads", default=None)


@contextmanager
def shared_reads():
    """While building one query, reuse each table's base DataFrame.

    Opening a parquet table lists its files and reads a footer on the driver
    (~0.1 s); a report that joins the same tables in several branches would
    otherwise pay that per branch.  The sharing ends with the block, so a
    long-lived session never plans against a stale file listing."""
    token = _SHARED.set({}) if _SHARED.get() is None else None
    try:
        yield
    finally:
        if token is not None:
            _SHARED.reset(token)


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    cache = _SHARED.get()
    if cache is None:
        df = _open(spark, path, name)
    else:
        key = (id(spark), path)
        df = cache.get(key)
        if df is None:
            df = cache[key] = _open(spark, path, name)
    return df.select(*columns) if columns else df


def jdbc_options(url: str, table: str, columns: list[str] | None = None, where: str | None = None,
                 partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                 num_partitions: int | None = None) -> dict[str, str]:
    """Reader options of a parallel extract.  Columns and filter are part of
    the query that the database runs; the partition column must be among the
    columns, its range is read as ``num_partitions`` queries."""
    source = table
    if columns or where:
        source = f"(SELECT {', '.join(columns) if columns else '*'} FROM {table}" + (f" WHERE {where}" if where else "") + ") extract"
    options = {"url": url, "dbtable": source}
    if partition_column is not None:
        if columns and partition_column not in columns:
            raise ValueError(f"partition column {partition_column} is not among the columns")
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
                    "numPartitions": str(num_partitions)}
    return options


def read_jdbc_table(spark: SparkSession, url: str, table: str, props: dict, **extract) -> DataFrame:
    """Parallel JDBC extract (see ``jdbc_options``)."""
    return spark.read.format("jdbc").options(**props, **jdbc_options(url, table, **extract)).load()


def range_bounds(rows: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list:
    """Bounds that cut the known values of a column into ranges of about as
    many rows each, ascending and different: quantiles of an earlier extract
    or of any frame with the column (one aggregate, one row).  A value that
    fills several ranges is one bound, so its rows stay one range."""
    if parts < 2:
        return []
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    found = rows.agg(F.percentile_approx(column, shares, accuracy)).first()[0] or []
    return sorted(set(found))


def range_predicates(column: str, bounds: list) -> list[str]:
    """Conditions on a column, one a query of a parallel extract, of which
    every row meets exactly one: the ranges between the bounds, open at both
    ends, and missing values with the first."""
    if not bounds:
        return ["1 = 1"]
    literal = lambda v: str(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else "'" + str(v).replace("'", "''") + "'"
    cuts = [literal(v) for v in bounds]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, props: dict, column: str, bounds: list,
                     columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """Parallel JDBC extract by ranges of similar size (``range_bounds``)
    instead of even steps between two ends; columns and filter are part of the
    database's query."""
    options = jdbc_options(url, table, columns, where, partition_column=None)
    return spark.read.jdbc(url, options["dbtable"], predicates=range_predicates(column, bounds), properties=props)
