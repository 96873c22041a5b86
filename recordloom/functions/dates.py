"""Strict dates and ISO timestamps.

Timestamps without a zone mean UTC. Rendering follows the session time zone, which
``recordloom.session`` pins to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from recordloom.functions.text import WHITESPACE

_ISO_TIMESTAMP = (
    r"^\d{4}-\d{2}-\d{2}"
    r"(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(Z|[+-]\d{2}:\d{2})?)?\z"
)


def parse_date_strict(value: Column) -> Column:
    """A ``YYYY-MM-DD`` calendar date or null; partial dates and timestamps are null.

    A plain ``try_cast`` would accept ``2020``, ``2020-1-2`` and timestamps.
    """
    iso = F.regexp_extract(
        value, rf"^{WHITESPACE}*((?!0000)[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}){WHITESPACE}*\z", 1
    )
    return F.nullif(iso, F.lit("")).try_cast("date")


def parse_iso_ts(value: Column) -> Column:
    """ISO text with ``Z``, an offset, or no zone (UTC) to an instant; null if malformed.

    Of a fraction of a second six digits count.
    """
    zone = F.regexp_extract(value, _ISO_TIMESTAMP, 1)
    # Spark wants seconds where ISO lets them go.
    full = F.regexp_replace(value, r"^(.{10}[T ]\d{2}:\d{2})(?![:\d])", "$1:00")
    full = F.regexp_replace(full, r"(\.\d{6})\d+", "$1")
    return F.when(
        value.rlike(_ISO_TIMESTAMP),
        F.when(zone != "", full)
        .when(F.length(value) == 10, F.concat(value, F.lit("T00:00:00Z")))
        .otherwise(F.concat(full, F.lit("Z")))
        .try_cast("timestamp"),
    )


def format_iso_z(ts: Column) -> Column:
    """ISO text ending in ``Z``: whole seconds, or six fraction digits when there are any."""
    second = F.date_trunc("second", ts)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.when(second == ts, whole).otherwise(fraction), F.lit("Z"))


def day_start(value: Column) -> Column:
    """Midnight that begins the given ``YYYY-MM-DD`` day."""
    return parse_date_strict(value).cast("timestamp_ntz")


def day_end_exclusive(value: Column) -> Column:
    """Midnight that ends the given day: an inclusive last day as an exclusive bound."""
    return F.date_add(parse_date_strict(value), 1).cast("timestamp_ntz")
