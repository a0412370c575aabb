"""Incremental ingestion of landing files."""
