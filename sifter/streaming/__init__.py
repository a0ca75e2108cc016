"""Incremental ingest with Structured Streaming."""

from .ingest import clean_line_stream, start_clean_ingest
