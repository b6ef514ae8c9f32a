"""Sources and sinks: count CSV, sensor JSON, Parquet tables and views."""

from countlens.sources.files import (
    RAW_COUNT_COLUMNS,
    counts_from_raw,
    raw_counts_schema,
    read_counts_csv,
    read_reference_json,
    read_table,
)
from countlens.sources.tables import (
    overwrite_partitions,
    overwrite_path,
    overwrite_table,
    passthrough_view,
    preview,
    publish_table,
    publish_view,
    register_table,
)

__all__ = [
    "RAW_COUNT_COLUMNS",
    "counts_from_raw",
    "overwrite_partitions",
    "overwrite_path",
    "overwrite_table",
    "passthrough_view",
    "preview",
    "publish_table",
    "publish_view",
    "raw_counts_schema",
    "read_counts_csv",
    "read_reference_json",
    "read_table",
    "register_table",
]
