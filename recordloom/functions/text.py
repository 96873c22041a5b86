"""Text, integer and name normalisation as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from recordloom.schemas import XML_NS

# Fixed value: the code points Unicode-aware regex engines call whitespace. Java's
# own \s is ASCII only and its (?U) form leaves out U+001C to U+001F.
_WHITESPACE_CODES = (
    r"\t\n\x0B\f\r\x1C\x1D\x1E\x1F\x20\x85\xA0"
    r"\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
)
WHITESPACE = f"[{_WHITESPACE_CODES}]"
NOT_WHITESPACE = f"[^{_WHITESPACE_CODES}]"

# A whitespace run that is not already one plain space. Most texts have none, and
# Spark then returns the input as it is instead of building a new string.
_IRREGULAR_RUN = rf"{WHITESPACE}(?:{WHITESPACE}+|(?<=[^ ]))"


def normalize_text(value: Column) -> Column:
    """Collapse whitespace runs to one space and strip; empty text becomes null."""
    collapsed = F.regexp_replace(value, _IRREGULAR_RUN, " ")
    return F.nullif(F.trim(collapsed), F.lit(""))


def has_text(value: Column) -> Column:
    """Whether ``normalize_text`` would leave anything; cheaper than doing it."""
    return value.rlike(NOT_WHITESPACE)


def safe_int(value: Column) -> Column:
    """Base-10 integer or null: optional sign, single ``_`` between digits allowed.

    Values that do not fit a long become null.
    """
    digits = F.regexp_extract(
        value, rf"^{WHITESPACE}*([+-]?[0-9]+(?:_[0-9]+)*){WHITESPACE}*\z", 1
    )
    return F.nullif(F.replace(digits, F.lit("_"), F.lit("")), F.lit("")).try_cast("bigint")


def last_segment(path: Column) -> Column:
    """Everything after the last ``/``: the basename of a path, the tail of a URI."""
    return F.substring_index(path, "/", -1)


def attribute_display_name_sql(key: str) -> str:
    """SQL text of ``attribute_display_name``, for use inside SQL lambdas."""
    prefix = "{" + XML_NS + "}"
    return (
        f"if(startswith({key}, '{prefix}'), concat('xml:', substr({key}, {len(prefix) + 1})), {key})"
    )


def attribute_display_name(key: str) -> Column:
    """``{xml-namespace}lang`` reads ``xml:lang``; other names stay as they are.

    ``key`` is the name of a column or any SQL expression.
    """
    return F.expr(attribute_display_name_sql(key))
