"""Structured Streaming: feed ingestion with row expectations."""
