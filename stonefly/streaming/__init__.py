"""Structured Streaming: incremental ingestion of new lab files."""
