"""Structured Streaming ingest of newly arriving account files."""

from .ingest import new_files, start_ingest  # noqa: F401
