"""Incremental ingest: the K2 job run per micro-batch of new feed files."""

from hearth.streaming.incremental import start_incremental_ingest

__all__ = ["start_incremental_ingest"]
