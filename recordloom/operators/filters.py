"""Row filters of the record harvest."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

HALF_OPEN = "half_open"
MS_INCLUSIVE = "ms_inclusive"
ONE_MS = timedelta(milliseconds=1)


def check_mode(mode: str) -> None:
    if mode not in (HALF_OPEN, MS_INCLUSIVE):
        raise ValueError(f"mode must be {HALF_OPEN!r} or {MS_INCLUSIVE!r}, not {mode!r}")


def moment(df: DataFrame, column: str, value: datetime) -> Column:
    """``value`` (naive means UTC) as a literal of the column's own timestamp type.

    Comparing like with like leaves the column bare, so the scan can use the filter.
    """
    aware = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    text = aware.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(text + "+00:00").cast("timestamp")


def in_time_window(
    df: DataFrame, column: str, start: datetime, end: datetime, mode: str = HALF_OPEN
) -> DataFrame:
    """Rows whose timestamp lies in ``[start, end)``.

    ``ms_inclusive`` is the range ``[start, end - 1 ms]``, both ends included, which
    search APIs with inclusive ranges get; it loses what falls into the last
    millisecond.
    """
    check_mode(mode)
    ts = F.col(column)
    lower = ts >= moment(df, column, start)
    if mode == HALF_OPEN:
        return df.where(lower & (ts < moment(df, column, end)))
    return df.where(lower & (ts <= moment(df, column, end - ONE_MS)))


def where_equal(df: DataFrame, **values: object) -> DataFrame:
    """Rows in which every named column has the given value."""
    for name, value in values.items():
        df = df.where(F.col(name) == F.lit(value))
    return df
