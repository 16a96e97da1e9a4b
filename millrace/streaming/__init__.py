"""Structured Streaming: file ingestion, silver tables, window features, query control."""
