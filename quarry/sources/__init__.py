from quarry.sources.csv import (
    read_csv_by_header,
    read_csv_inferred,
    read_csv_strict,
    read_points_csv,
    strict_csv_lines,
)
from quarry.sources.parquet import read_parquet, read_table
from quarry.sources.sinks import write_n_files, write_partitioned

__all__ = [
    "read_csv_by_header",
    "read_csv_inferred",
    "read_csv_strict",
    "read_points_csv",
    "strict_csv_lines",
    "read_parquet",
    "read_table",
    "write_n_files",
    "write_partitioned",
]
