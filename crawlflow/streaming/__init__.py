"""Batch and streaming runs of the ingest jobs."""
