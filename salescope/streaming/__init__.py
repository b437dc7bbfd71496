"""Structured Streaming form of the collect step."""

from .ingest import ingest_order_files, order_file_stream  # noqa: F401
