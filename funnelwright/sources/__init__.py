"""Table specifications, file scans and table writes."""

from funnelwright.sources.files import (
    SOURCE_FILE,
    SOURCE_TIME,
    read_csv,
    read_csv_files,
    read_csv_folder,
    read_parquet,
    read_parquet_files,
    read_parquet_folder,
    stored_bytes,
)
from funnelwright.sources.tables import last_batch, merge_batches, read_batches, read_table, write_batch, write_table
from funnelwright.specs import Field, SPECS, TableSpec, get_spec, report_spec, specs_from_json

__all__ = [
    "Field",
    "SOURCE_FILE",
    "SOURCE_TIME",
    "SPECS",
    "TableSpec",
    "get_spec",
    "last_batch",
    "merge_batches",
    "read_batches",
    "read_csv",
    "read_csv_files",
    "read_csv_folder",
    "read_parquet",
    "read_parquet_files",
    "read_parquet_folder",
    "read_table",
    "report_spec",
    "specs_from_json",
    "stored_bytes",
    "write_batch",
    "write_table",
]
