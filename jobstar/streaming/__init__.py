"""Incremental landing of raw files with Structured Streaming."""

from jobstar.streaming.ingest import land_stream  # noqa: F401
