"""Sources and sinks: parquet/CSV tables, bucketed layouts, partition overwrite."""

from tallyfold.sources.tables import (
    insert_periods,
    overwrite_into,
    read_csv,
    read_table,
    write_bucketed,
    write_csv,
    write_snapshot_table,
)

__all__ = [
    "insert_periods",
    "overwrite_into",
    "read_csv",
    "read_table",
    "write_bucketed",
    "write_csv",
    "write_snapshot_table",
]
