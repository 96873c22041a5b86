"""Structured Streaming: resumable ingest, dedup and counts."""

from recordloom.streaming.folder import read_docs_folder_stream
from recordloom.streaming.ingest import ingest_docs_folder, ingest_docs_stream, ingest_records_stream, read_docs_stream
from recordloom.streaming.records import dedupe_stream, tumbling_counts

__all__ = [
    "dedupe_stream",
    "ingest_docs_folder",
    "ingest_docs_stream",
    "ingest_records_stream",
    "read_docs_folder_stream",
    "read_docs_stream",
    "tumbling_counts",
]
