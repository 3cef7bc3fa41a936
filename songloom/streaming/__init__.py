"""Resumable incremental ingest with Structured Streaming."""
