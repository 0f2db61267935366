"""Sinks: stage outputs, quarantines, exports and star-schema tables."""

from .files import (  # noqa: F401
    export_csv, save_table, write_rejects, write_parquet,
)
