"""Structured Streaming: once-only incremental file ingestion, appended or merged by key."""

from .ingest import ingest_new_files  # noqa: F401
from .upsert import upsert_new_files  # noqa: F401
