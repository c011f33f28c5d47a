"""Structured Streaming versions of the feed ingest and alert operators."""
