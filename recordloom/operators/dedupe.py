"""First occurrence per id. Rows without an id are no duplicates of each other: all stay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


_KEY, _ROW = "dedupe_key", "first_row"


def _first_rows(df: DataFrame, id_col: str, order_by: str | Sequence[str]) -> DataFrame:
    """``dedupe_key, first_row`` for every id that is not null."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    return (
        df.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias(_KEY))
        .agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias(_ROW))
    )


def dedupe_first(df: DataFrame, id_col: str, order_by: str | Sequence[str]) -> DataFrame:
    """The first row of every id in the order of ``order_by``, plus all rows with null id.

    The first row is the minimum of ``(order, row)``, an aggregate that Spark computes
    partly before the shuffle: an id that holds a third of all rows leaves each map
    task as one row. Rows without an id do not take part in the shuffle.
    """
    firsts = _first_rows(df, id_col, order_by).select(f"{_ROW}.*")
    return firsts.unionByName(df.where(F.col(id_col).isNull()))


def dedupe_against_existing(
    incoming: DataFrame, existing: DataFrame, id_col: str, order_by: str | Sequence[str]
) -> DataFrame:
    """``dedupe_first`` of the incoming rows, without ids the existing rows already have.

    Only the distinct ids of ``existing`` are read and shuffled, so its columns and
    its repeated ids do not matter. The join uses the key both sides are already
    partitioned by. Null ids match nothing and stay.
    """
    known = (
        existing.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias(_KEY)).distinct()
    )
    fresh = _first_rows(incoming, id_col, order_by).join(known, _KEY, "left_anti")
    return fresh.select(f"{_ROW}.*").unionByName(incoming.where(F.col(id_col).isNull()))
