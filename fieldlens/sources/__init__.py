from fieldlens.sources.tables import read_table, TABLES
from fieldlens.sources.csv_io import read_csv_r, read_months, read_partitioned_csv, r_text_nulls

__all__ = ["read_table", "TABLES", "read_csv_r", "read_months", "read_partitioned_csv", "r_text_nulls"]
