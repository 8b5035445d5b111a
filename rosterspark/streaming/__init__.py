"""Resumable ingest on Structured Streaming."""
