"""Incremental refresh of the daily chart (Structured Streaming)."""
