"""Table operators: shredding, tables, issues, profiles, dedup, windows, pages, filters."""

from recordloom.operators.dedupe import dedupe_against_existing, dedupe_first
from recordloom.operators.filters import HALF_OPEN, MS_INCLUSIVE, in_time_window, where_equal
from recordloom.operators.issues import issues_table
from recordloom.operators.paging import page_count, paginate, sort_order
from recordloom.operators.profile import (
    distribution,
    harvest_profile,
    issues_by,
    key_inventory,
    run_summary,
    top_issue_signatures,
)
from recordloom.operators.shred import shred_documents
from recordloom.operators.tables import derive_tables, judge_documents, table_from_documents
from recordloom.operators.windows import (
    HalvingTree,
    assign_any_windows,
    assign_windows,
    count_by_window,
    count_leaves,
    plan_windows_by_count,
    split_windows,
    store_leaves,
    stored_leaves,
)

__all__ = [
    "HALF_OPEN",
    "MS_INCLUSIVE",
    "HalvingTree",
    "assign_any_windows",
    "assign_windows",
    "count_by_window",
    "count_leaves",
    "dedupe_against_existing",
    "dedupe_first",
    "derive_tables",
    "distribution",
    "harvest_profile",
    "in_time_window",
    "issues_by",
    "issues_table",
    "judge_documents",
    "key_inventory",
    "page_count",
    "paginate",
    "plan_windows_by_count",
    "run_summary",
    "shred_documents",
    "sort_order",
    "split_windows",
    "store_leaves",
    "stored_leaves",
    "table_from_documents",
    "top_issue_signatures",
    "where_equal",
]
