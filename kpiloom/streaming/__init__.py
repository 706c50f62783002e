"""Structured Streaming ingest: landing files to bronze, silver and gold."""
