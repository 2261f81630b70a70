"""Composites: the clean pipeline, the ingest job, the profile report, transform policies."""
