"""Publishing: CSV / parquet outputs for the spreadsheet front end.

* ``write_csv``: overwrite a dataset (header row, no index column).
* ``with_row_numbers``: an explicit 1-based row column (off by default).
* ``write_snapshot_and_latest``: a dated snapshot partition plus a "latest"
  copy made from the written snapshot, so the frame is computed once.
* ``write_split``: one output per value (``partitionBy``), e.g. per country.
* ``write_by_month``: month-named partitions (``month=yyyy_MM``); other
  months stay.
* ``publish_version`` / ``read_latest_version``: read-modify-write of a
  dataset that is also its own input.  Overwriting a path while reading it
  deletes the input first; each run writes a new version folder instead.
* ``update_version``: the same as one step that two runs cannot both win.

Writes are whole-job atomic per partition via Spark's commit protocol; a
lost executor only re-runs its tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.operators.rownum import global_row_number


# Quotes are doubled and nothing else is escaped, as spreadsheets and R do.
_CSV = {"header": True, "escape": '"', "quote": '"', "emptyValue": "", "nullValue": "NA", "quoteAll": False,
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _options(fmt: str) -> dict:
    return _CSV if fmt == "csv" else {}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV that ``sources.read_csv_r`` reads back: quotes doubled,
    missing as ``NA``, empty text as empty."""
    df.write.mode(mode).options(**_CSV).csv(path)


def with_row_numbers(df: DataFrame, order_cols: list, name: str = "row") -> DataFrame:
    return global_row_number(df, order_cols, out=name)


def write_snapshot_and_latest(df: DataFrame, base: str, snapshot_date: str, fmt: str = "parquet") -> None:
    """Write ``snapshots/snapshot_date=<date>`` and copy exactly that folder to
    ``latest``, with its own columns whatever other snapshots look like."""
    folder = f"{base.rstrip('/')}/snapshots/snapshot_date={snapshot_date}"
    df.write.mode("overwrite").format(fmt).options(**_options(fmt)).save(folder)
    if fmt == "csv":  # as text, so that the copy is the snapshot to the letter
        written = df.sparkSession.read.options(**_CSV, multiLine=True).schema(
            ", ".join(f"`{c}` string" for c in df.columns)).csv(folder)
    else:
        written = df.sparkSession.read.format(fmt).load(folder)
    written.write.mode("overwrite").format(fmt).options(**_options(fmt)).save(f"{base.rstrip('/')}/latest")


def write_split(df: DataFrame, path: str, by: str | Column, name: str = "split", fmt: str = "csv",
                keep_others: bool = False) -> None:
    """One folder per value.  ``keep_others`` overwrites only the folders of
    values that the frame has; without it the whole dataset is replaced.

    Rows are rebalanced by value first: a value's rows come together, and AQE
    cuts a value that holds many of them into parts of the advisory size, so
    the number of files follows their bytes, not tasks times values."""
    col = by if isinstance(by, Column) else F.col(by)
    (df.withColumn(name, col).hint("rebalance", name).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic" if keep_others else "static")
       .partitionBy(name).format(fmt).options(**_options(fmt)).save(path))


def write_by_month(df: DataFrame, path: str, date_col: str, fmt: str = "csv") -> None:
    """One folder per month; months that are not in the frame stay."""
    write_split(df, path, F.date_format(F.col(date_col), "yyyy_MM"), name="month", fmt=fmt, keep_others=True)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own making."""
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def list_versions(spark: SparkSession, base: str) -> list[int]:
    fs, p, _ = _fs(spark, base)
    if not fs.exists(p):
        return []
    return sorted(int(name[2:]) for st in fs.listStatus(p)
                  if st.isDirectory() and (name := st.getPath().getName()).startswith("v=") and name[2:].isdigit())


def finished_versions(spark: SparkSession, base: str) -> list[int]:
    """Versions whose write job was committed."""
    fs, _, jvm = _fs(spark, base)
    done = lambda v: fs.exists(jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/v={v}/_SUCCESS"))
    return [v for v in list_versions(spark, base) if done(v)]


def read_latest_version(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame | None:
    """The last finished version; a write that was cut short is skipped."""
    vs = finished_versions(spark, base)
    if not vs:
        return None
    return spark.read.format(fmt).options(**_options(fmt)).load(f"{base.rstrip('/')}/v={vs[-1]}")


def publish_version(df: DataFrame, base: str, fmt: str = "parquet") -> str:
    """Write ``df`` as the next version; the previous versions stay readable."""
    vs = list_versions(df.sparkSession, base)
    target = f"{base.rstrip('/')}/v={(vs[-1] + 1) if vs else 1}"
    df.write.mode("errorifexists").format(fmt).options(**_options(fmt)).save(target)
    return target


class VersionConflict(RuntimeError):
    """Another run has published on top of the version that was read."""


def claim_version(spark: SparkSession, base: str, version: int) -> bool:
    """Whether this caller is the one that may write a version: its claim file
    is created, which the file system lets only one caller do."""
    fs, _, jvm = _fs(spark, base)
    claim = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/claims/v={version}")
    fs.mkdirs(claim.getParent())
    try:
        fs.create(claim, False).close()
    except Exception as e:  # py4j wraps what the file system throws
        if fs.exists(claim):
            return False
        raise e
    return True


def update_version(spark: SparkSession, base: str, change: Callable[[DataFrame | None], DataFrame], fmt: str = "parquet",
                   read: Callable[[str], DataFrame] | None = None) -> str:
    """Read-modify-write: ``change`` gets the last finished version (None if
    there is none) and returns the next one.

    The new rows are written aside first; only then version n + 1 is claimed
    and the rows moved to it by a rename.  Of two runs that read version n, one
    claims n + 1; the other raises ``VersionConflict`` and leaves nothing
    behind, so it can be run again on what the first has published.  A run that
    ends between claim and rename blocks its number: ``release_claim``."""
    done = finished_versions(spark, base)
    n = done[-1] if done else 0
    source = f"{base.rstrip('/')}/v={n}"
    before = None if not done else read(source) if read else spark.read.format(fmt).options(**_options(fmt)).load(source)
    fs, _, jvm = _fs(spark, base)
    path = jvm.org.apache.hadoop.fs.Path
    aside = f"{base.rstrip('/')}/writing/{uuid.uuid4().hex}"
    change(before).write.mode("errorifexists").format(fmt).options(**_options(fmt)).save(aside)
    target = f"{base.rstrip('/')}/v={n + 1}"
    if not claim_version(spark, base, n + 1) or fs.exists(path(target)) or not fs.rename(path(aside), path(target)):
        fs.delete(path(aside), True)
        raise VersionConflict(f"version {n + 1} of {base} belongs to another run")
    return target


def release_claim(spark: SparkSession, base: str, version: int) -> None:
    """Give up the claim of a run that ended before it published."""
    fs, _, jvm = _fs(spark, base)
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/v={version}")):
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/claims/v={version}"), False)
