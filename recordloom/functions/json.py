"""Raw JSON records and API pages, read by one tolerant parser.

A record is its text, or what ``read_object`` makes of it in one scan: a map from each key to the text of
its value. The parser accepts what Python's ``json`` does: ``NaN`` and ``Infinity``, repeated keys, of which
the last one counts, and texts of any length and depth. It takes exactly one value, so text behind it
makes a line malformed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from recordloom.functions.text import WHITESPACE, safe_int

# No limit on the length of a line, of its texts and numbers, or on its depth.
_OPTIONS = {
    "allowSingleQuotes": "false", "maxStringLen": "2147483647", "maxNumLen": "2147483647", "maxNestingDepth": "2147483647"}
_SEAL = "seal_"
OBJECT_DDL = "map<string,string>"
_PAGE_DDL = f"hits struct<total string, hits array<string>>, {_SEAL} string"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _single(value: Column, ddl: str, seal_of: Callable[[Column], Column]) -> Column:
    """The one JSON value of a text, as ``ddl``; null if there is none, another one, or anything behind it.

    Spark's parser ignores what follows a value. So the text is made the first entry of an
    array, and an object that only this text has is the second: both must be there, and no third.
    """
    seal = F.hex(F.xxhash64(value))
    text = F.regexp_replace(value, rf"^{WHITESPACE}+|{WHITESPACE}+\z", "")
    entries = F.from_json(F.concat(F.lit("["), text, F.lit(f',{{"{_SEAL}":"'), seal, F.lit('"}]')), f"array<{ddl}>", _OPTIONS)
    return _let(entries, lambda e: F.when((F.size(e) == 2) & (seal_of(F.get(e, 1)) == seal), F.get(e, 0)))


def _last(record: Column, key: str) -> Column:
    """The value of the last entry with this key."""
    named = F.filter(F.map_entries(record), lambda e: e["key"] == key)
    return F.try_element_at(named, F.lit(-1))["value"]


def read_object(value: Column) -> Column:
    """Keys and the texts of their values of a JSON object, repeated keys in order; null if the text is no JSON object.

    Texts come without quotes. Objects, arrays and numbers come as JSON, numbers with a
    fraction as doubles have it; ``NaN`` and the infinities within objects and arrays become texts.
    """
    return _single(value, OBJECT_DDL, lambda last: _last(last, _SEAL))


def field_of(record: Column, *path: str) -> Column:
    """The text at a path of keys in what ``read_object`` returned; null where there is none."""
    value = _last(record, path[0])
    for key in path[1:]:
        value = _last(read_object(value), key)
    return F.regexp_replace(value, r'^"(NaN|-?Infinity)"\z', "$1")


def record_id_of(record: Column) -> Column:
    """The id of what ``read_object`` returned, as a string, whatever JSON type it has; null if absent."""
    return field_of(record, "id")


def object_keys(record: Column, *path: str) -> Column:
    """The distinct keys of the object at a path in what ``read_object`` returned; null where there is no object."""
    for key in path:
        record = read_object(_last(record, key))
    return F.array_distinct(F.map_keys(record))


def array_length(text: Column) -> Column:
    """Number of elements of a JSON array; null if the text is none."""
    return F.json_array_length(text)


def read_page(page: Column) -> Column:
    """``struct<total, hits>`` of an API page's text: the texts of ``hits.total`` and of each record in ``hits.hits``."""
    return _single(page, f"struct<{_PAGE_DDL}>", lambda last: last[_SEAL])["hits"]


def page_total(page: Column) -> Column:
    """Hit count of a page's text: ``hits.total`` as a number or as ``{value: n}``; else 0. Fractions are cut off."""
    total = read_page(page)["total"]
    number = _let(total, lambda t: F.when(F.startswith(t, F.lit("{")), field_of(read_object(t), "value")).otherwise(t))
    return _let(number, lambda n: F.coalesce(
        safe_int(n),
        F.when(n.rlike(r"^-?[0-9]+[.eE][0-9.eE+-]*\z"), n.try_cast("double").try_cast("bigint")),
        F.when(n == "true", F.lit(1).cast("bigint")),
        F.lit(0).cast("bigint")))
