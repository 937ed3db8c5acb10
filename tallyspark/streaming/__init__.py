"""Incremental ingestion and loads."""
