"""Inputs: XML documents, JSON Lines, API pages, published tables."""

from recordloom.sources.documents import (
    as_documents,
    attach_content,
    pack_documents,
    read_xml_dir,
    read_xml_list,
    resolve_listed_paths,
    select_docs_containing,
)
from recordloom.sources.jsonl import (
    explode_api_pages,
    line_quality,
    parse_jsonl,
    read_jsonl_tolerant,
)
from recordloom.sources.published import read_tables

__all__ = [
    "as_documents",
    "attach_content",
    "explode_api_pages",
    "line_quality",
    "pack_documents",
    "parse_jsonl",
    "read_jsonl_tolerant",
    "read_tables",
    "read_xml_dir",
    "read_xml_list",
    "resolve_listed_paths",
    "select_docs_containing",
]
