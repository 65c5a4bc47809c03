"""Structured Streaming entry points: load-once file ingest and the incremental pipeline."""
