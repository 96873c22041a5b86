"""Chronological pages inside windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordloom.session import materialize

# Fields whose pages run from oldest to newest.
CHRONOLOGICAL_FIELDS = ["created", "updated"]


def sort_order(field: str, column: Column) -> Column:
    """Oldest first for ``created`` and ``updated``, else most recent first."""
    return column.asc() if field in CHRONOLOGICAL_FIELDS else column.desc()


def page_count(total: Column, size: int, spare: int = 0) -> Column:
    """Pages needed for ``total`` records, plus spare ones, at least one."""
    pages = F.ceil(total / max(1, size)) + spare
    return F.greatest(F.lit(1).cast("bigint"), pages.cast("bigint"))


def paginate(
    df: DataFrame,
    window: str | Sequence[str],
    order: Sequence[str | Column],
    size: int,
    folder: str | None = None,
) -> DataFrame:
    """Add ``position`` (from 1, in ``order`` inside the window) and ``page``.

    This is an action: the sorted rows are written to ``folder``, by default a fresh one in
    the shared folder, when it is called, and the result reads them from there.

    ``order`` must be unique inside a window, so end it with the id. A window may hold
    any share of the rows, so positions do not come from one task per window: the rows
    are sorted globally, cut into ranges wherever the sort cuts them, and stored. Each
    (range, window) then needs only its row count, from which the number of rows in
    front of it follows. Storing the sorted rows fixes the cuts; two evaluations of
    the sort might cut differently.
    """
    if size < 1:
        raise ValueError("a page holds at least one row")
    keys = [window] if isinstance(window, str) else list(window)
    # Sequence numbers are (range << 33) + row inside the range.
    placed = materialize(
        df.orderBy(*keys, *order).withColumn("sequence_", F.monotonically_increasing_id()), folder
    ).withColumn("range_", F.shiftright("sequence_", 33))
    # One row per window, and one more for each range border inside a window.
    parts = placed.groupBy(*keys, "range_").agg(
        F.count("*").alias("rows_"), F.min("sequence_").alias("first_")
    )
    ahead = Window.partitionBy(*keys).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *(F.col(k).alias(f"{k}_") for k in keys),
        F.col("range_").alias("part_"),
        "first_",
        F.coalesce(F.sum("rows_").over(ahead), F.lit(0)).alias("ahead_"),
    )
    same = F.col("range_") == F.col("part_")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_"))
    position = F.col("sequence_") - F.col("first_") + F.col("ahead_") + 1
    return placed.join(offsets, same).select(
        *df.columns,
        position.cast("bigint").alias("position"),
        F.ceil(position / size).cast("bigint").alias("page"),
    )
