"""Picking one value out of an array of elements.

An element is a struct with a raw ``text``, normalised here, and a field per attribute.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from recordloom.functions.text import has_text, normalize_text


def text_of(element: Column) -> Column:
    return normalize_text(element["text"])


def positional_first(array: Column) -> Column:
    """First element, whatever it holds; null on an empty or null array."""
    return F.try_element_at(array, F.lit(1))


def first_where(array: Column, predicate: Callable[[Column], Column]) -> Column:
    """First element that satisfies ``predicate``; null if none does."""
    return positional_first(F.filter(array, predicate))


def first_with_text(array: Column, attr: str, value: str) -> Column:
    """First element whose attribute equals ``value`` and whose text is not blank.

    A blank match does not end the search: the next match gets its turn.
    """
    return first_where(
        array, lambda e: (e[attr] == value) & has_text(e["text"])
    )


def first_by_prefix(values: Column, prefix: str) -> Column:
    """First string that starts with ``prefix``."""
    return first_where(values, lambda v: F.startswith(v, F.lit(prefix)))


def element_count(array: Column) -> Column:
    """Number of elements as a long; 0 for null."""
    return F.when(array.isNull(), F.lit(0)).otherwise(F.size(array)).cast("bigint")
