"""Scalar and array functions; all are plain Column expressions."""

from recordloom.functions.dates import (
    day_end_exclusive,
    day_start,
    format_iso_z,
    parse_date_strict,
    parse_iso_ts,
)
from recordloom.functions.elements import (
    element_count,
    first_by_prefix,
    first_where,
    first_with_text,
    positional_first,
    text_of,
)
from recordloom.functions.identifiers import extract_record_id, file_name_record_id
from recordloom.functions.json import array_length, field_of, object_keys, page_total, read_object, read_page, record_id_of
from recordloom.functions.text import (
    attribute_display_name,
    last_segment,
    normalize_text,
    safe_int,
)

__all__ = [
    "array_length",
    "attribute_display_name",
    "day_end_exclusive",
    "day_start",
    "element_count",
    "extract_record_id",
    "file_name_record_id",
    "field_of",
    "first_by_prefix",
    "first_where",
    "first_with_text",
    "format_iso_z",
    "last_segment",
    "normalize_text",
    "object_keys",
    "page_total",
    "parse_date_strict",
    "parse_iso_ts",
    "positional_first",
    "read_object",
    "read_page",
    "record_id_of",
    "safe_int",
    "text_of",
]
