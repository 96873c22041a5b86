"""Where a record's id comes from."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The three spellings that carry an id, in order of preference.
URL_ID = r"/records/(\p{Nd}+)$"
OAI_ID = r":(\p{Nd}+)$"
FILE_NAME_ID = r"^(\p{Nd}+)"


def _captured(value: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(value, pattern, 1), F.lit(""))


def extract_record_id(url: Column, oai_identifier: Column, file_name: Column) -> Column:
    """Id from the record URL, else the OAI identifier, else the file name's leading digits.

    A value that is present but does not match falls through to the next source.
    """
    return F.coalesce(
        _captured(url, URL_ID),
        _captured(oai_identifier, OAI_ID),
        _captured(file_name, FILE_NAME_ID),
    )


def file_name_record_id(file_name: Column) -> Column:
    """The only source left when the document itself cannot be read."""
    return _captured(file_name, FILE_NAME_ID)
