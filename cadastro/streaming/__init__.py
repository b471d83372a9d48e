"""Structured Streaming entry points."""

from .incremental import ingest_new_content, ingest_new_files

__all__ = ["ingest_new_content", "ingest_new_files"]
