"""Incremental ingestion of newly arrived deliveries."""
