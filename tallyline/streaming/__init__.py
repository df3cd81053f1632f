"""Incremental ingest of landed entity files with Structured Streaming."""
