"""Structured Streaming ingest of daily facts."""
