"""Whole runs: documents to tables, raw records to a record store."""

from recordloom.plans.extract import extract_tables, run_extract, summary_of_runs
from recordloom.plans.harvest import read_store, store_records

__all__ = ["extract_tables", "read_store", "run_extract", "store_records", "summary_of_runs"]
