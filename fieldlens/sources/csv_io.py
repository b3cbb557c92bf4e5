"""CSV inputs with the NA conventions of the spreadsheet exports.

The exports were written and read by R: the text ``NA`` means missing, a
blank text field is an empty string (not missing), and a blank numeric field
is missing.  Spark's CSV defaults are the opposite for text (``NA`` stays
text, blank becomes null), so files are read as text and converted here.
"""

from __future__ import annotations

import csv
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.functions.dates import period_end, period_start, window_start


def r_text_nulls(c: Column) -> Column:
    """``NA`` -> null, blank (null after parsing) -> empty string."""
    return F.when(c == F.lit("NA"), F.lit(None).cast("string")).when(c.isNull(), F.lit("")).otherwise(c)


def _r_numeric(c: Column, dtype: T.DataType) -> Column:
    cleaned = F.when((c == F.lit("NA")) | (F.trim(c) == F.lit("")), F.lit(None).cast("string")).otherwise(F.trim(c))
    # try_cast: a stray text value becomes null instead of failing the job
    return cleaned.try_cast(dtype)


# Quotes are doubled inside quoted fields; a backslash is a character like any
# other and a quoted field may span lines.
_OPTIONS = {"header": True, "multiLine": True, "quote": '"', "escape": '"',
            "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _typed(raw: DataFrame, schema: T.StructType) -> list[Column]:
    """The schema's columns by name; one that the file lacks is missing."""
    out = []
    for f in schema.fields:
        if f.name not in raw.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(r_text_nulls(F.col(f"`{f.name}`")).alias(f.name))
        else:
            out.append(_r_numeric(F.col(f"`{f.name}`"), f.dataType).alias(f.name))
    return out


def _files(spark: SparkSession, paths: list[str]) -> list[str]:
    """The data files below paths or globs, in name order."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for path in paths:
        pattern = jvm.org.apache.hadoop.fs.Path(path)
        fs = pattern.getFileSystem(conf)
        todo = [st.getPath() for st in fs.globStatus(pattern) or []]
        while todo:
            p = todo.pop()
            if p.getName().startswith(("_", ".")):
                continue
            if fs.getFileStatus(p).isDirectory():
                todo += [st.getPath() for st in fs.listStatus(p)]
            else:
                out.append(p.toString())
    if not out:
        raise FileNotFoundError(f"no files below {paths}")
    return sorted(out)


def _plain(path: str) -> str:
    """A local path without the scheme's variants; any other as it is."""
    return re.sub("^file:/+", "/", unquote(path))


def _column_names(line: str) -> tuple[str, ...]:
    """Column names of a header line, as Spark's reader makes them: a blank
    one is ``_c`` and its number, one that repeats gets its number."""
    names = next(csv.reader([line]), [])
    lower = [n.lower() for n in names]
    return tuple(f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names))


def _headers(spark: SparkSession, files: list[str]) -> dict[str, tuple[str, ...]]:
    """Column names of each file: header lines are found by the executors in
    one job, whatever the number of files.  A header that goes on in the next
    line is left to the reader."""
    lines = spark.read.text(files).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                                          F.monotonically_increasing_id().alias("line")).where("at = 0 and value <> ''")
    found = {_plain(r["file"]): r["header"] for r in lines.groupBy("file").agg(F.min_by("value", "line").alias("header")).collect()}
    out = {}
    for f in files:
        header = found.get(_plain(f), "")
        whole = header.count('"') % 2 == 0
        out[f] = _column_names(header) if whole else tuple(spark.read.options(**_OPTIONS).csv(f).columns)
    return out


def _by_header(spark: SparkSession, files: list[str], base: str | None = None) -> list[DataFrame]:
    """One frame per distinct header line: files are read together only if
    they have the same columns in the same order.  Only header lines reach the
    driver, one a file."""
    by_columns: dict[tuple, list[str]] = {}
    for f, columns in _headers(spark, files).items():
        by_columns.setdefault(columns, []).append(f)
    reader = spark.read.options(**_OPTIONS)
    reader = reader.option("basePath", base) if base else reader
    return [reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).csv(group)
            for columns, group in by_columns.items()]


def read_months(spark: SparkSession, base: str, schema: T.StructType, as_of: str, three_months: bool = False,
                fmt: str = "csv") -> DataFrame:
    """The published months (``month=yyyy_MM`` folders) that a report as of a
    date needs, with their ``month``: folders of other months are not opened,
    as the months are a filter on the partition column."""
    first = window_start(as_of) if three_months else period_start(as_of)
    label = lambda day: F.date_format(day, "yyyy_MM")
    text = fmt == "csv"
    stored = T.StructType([T.StructField(f.name, T.StringType() if text else f.dataType) for f in schema.fields]
                          + [T.StructField("month", T.StringType())])
    rows = spark.read.schema(stored).options(**(_OPTIONS if text else {})).format(fmt).load(base)
    rows = rows.where(F.col("month").between(label(first), label(period_end(as_of))))
    return rows.select(*_typed(rows, schema), "month") if text else rows


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_csv_r(spark: SparkSession, path: str | list[str], schema: T.StructType,
               drop: list[str] | None = None) -> DataFrame:
    """Read header CSV(s) with an explicit schema and R NA semantics.

    Columns are matched by **name**, file by file: their order may differ, a
    column that a file lacks is missing, one that the schema lacks is left
    out.  ``drop`` removes columns such as an exported row index.
    """
    files = _files(spark, [path] if isinstance(path, str) else list(path))
    out = _union([raw.select(*_typed(raw, schema)) for raw in _by_header(spark, files)])
    return out.drop(*drop) if drop else out


def read_partitioned_csv(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """Read every file under ``base`` (e.g. one sub-folder per zone), each by
    its own header.

    The file set comes from the folder, not from a hard-coded count; the
    partition column (``zone=...``) is recovered by partition discovery.
    """
    frames = []
    for raw in _by_header(spark, _files(spark, [base]), base):
        found = [c for c in raw.columns if c not in {f.name for f in schema.fields} and raw.columns.index(c) >= len(raw.columns) - _levels(raw)]
        frames.append(raw.select(*_typed(raw, schema), *[F.col(f"`{c}`") for c in found]))
    return _union(frames)


def _levels(raw: DataFrame) -> int:
    """Partition levels of a frame's paths (``name=value`` folders)."""
    first = raw.inputFiles()[0]
    return sum("=" in part for part in first.split("/")[:-1])


def read_named_files(spark: SparkSession, glob: str, schema: T.StructType,
                     name_pattern: str, name_col: str) -> DataFrame:
    """Read a glob of files, each by its own header, and tag each row with a
    value parsed from its file name.

    ``name_pattern`` is a regex with one group applied to the file name, e.g.
    ``r'^TC-(.*)\\.csv$'`` recovers the zone of a per-zone roster file.
    """
    frames = _by_header(spark, _files(spark, [glob]))
    return _union([raw.select(*_typed(raw, schema), F.regexp_extract(F.col("_metadata.file_name"), name_pattern, 1).alias(name_col))
                   for raw in frames])
