"""Outputs: table folders, raw JSON Lines, SQL tables."""

from recordloom.sinks.runs import visible_folders, visible_runs
from recordloom.sinks.tables import (
    BATCH_COLUMN,
    register_tables,
    write_jsonl,
    write_summary,
    write_table,
    write_tables,
)

__all__ = [
    "BATCH_COLUMN",
    "register_tables",
    "visible_folders",
    "visible_runs",
    "write_jsonl",
    "write_summary",
    "write_table",
    "write_tables",
]
