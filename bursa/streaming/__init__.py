"""Structured Streaming forms of the feed ingest and the live views (T-01..T-06)."""
