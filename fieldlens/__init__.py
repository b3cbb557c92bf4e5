"""fieldlens: sales-operations and field-coverage analytics on Spark.

Every operator takes and returns DataFrames, keeps its work inside
Catalyst (built-in expressions only, no Python UDFs) and receives report
dates and patterns as arguments instead of reading the clock.

Sub-packages
------------
functions  column expressions (text, dates, ratios, flags)
operators  DataFrame -> DataFrame building blocks (dedup, NOT IN, renewal
           labelling, text collapse, grouping-set rollup, row numbers)
sources    table loading and CSV reading with R-style NA handling
sinks      CSV / parquet publishing (overwrite, snapshots, splits)
plans      the reports, the stand-in views over the test tables and the
           registry of named queries with their SQL oracles
"""

__version__ = "0.1.0"
