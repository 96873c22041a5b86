"""Operators from stream to stream."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Ship this module's functions with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _first_of_batch(id_col: str, order: list[str]):
    """The function that keeps, of each id, the first row of an Arrow batch, so a hot id leaves a task as few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = pa.table([batch[c] for c in (id_col, *order)], names=[str(i) for i in range(len(order) + 1)])
            at = pc.sort_indices(keys, [(n, "ascending") for n in keys.column_names], null_placement="at_start")
            ids = batch[id_col].take(at)
            starts = pa.concat_arrays([pa.array([True]), pc.not_equal(ids.slice(1), ids.slice(0, len(ids) - 1))])
            yield batch.take(at.filter(starts))

    return run


class _FirstOfStream(StatefulProcessor):
    """Lets the first row of an id through, unless its state says that one came before."""

    def __init__(self, order: list[str], event: str | None, delay_ms: int) -> None:
        self.order, self.event, self.delay_ms = order, event, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: ANN001
        first = least = latest = None
        for row in rows:
            arrival = tuple((row[c] is not None, row[c]) for c in self.order)
            if first is None or arrival < least:
                first, least = row, arrival
            if self.event and row[self.event] is not None:
                latest = row[self.event] if latest is None else max(latest, row[self.event])
        if first is None or self.seen.exists():
            return
        self.seen.update((True,))
        if self.event and latest is not None:
            # The id is forgotten once the watermark has passed its first batch by the delay.
            self.handle.registerTimer(max(int(latest.timestamp() * 1000), timerValues.getCurrentWatermarkInMs()) + self.delay_ms)
        yield first

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: ANN001
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def _milliseconds(delay: str) -> int:
    """A delay such as ``1 hour`` or ``2 minutes 30 seconds``."""
    units = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000, "week": 604_800_000}
    words = delay.split()
    if not words or len(words) % 2 or any(u.removesuffix("s") not in units for u in words[1::2]):
        raise ValueError(f"not a delay: {delay!r}")
    return sum(int(n) * units[u.removesuffix("s")] for n, u in zip(words[::2], words[1::2]))


def dedupe_stream(
    stream: DataFrame,
    id_col: str,
    order_by: str | Sequence[str],
    watermark: tuple[str, str] | None = None,
) -> DataFrame:
    """The first row to arrive of every id, whole, and every row without an id.

    A row of an earlier batch is earlier; within a batch the order of ``order_by`` decides, nulls
    first. Of rows equal in it any may stay.

    All rows of an id meet in one task. An id may hold a third of the stream, so repeats are
    first dropped within the Arrow batches that a task reads: of such an id a task passes on one row in some thousands.

    State is a mark for each id, in RocksDB (``session`` sets that store). ``watermark=(column, delay)`` bounds it: an
    id is forgotten once the watermark is ``delay`` beyond the rows of its first batch, and a later repeat is let
    through. Rows behind the watermark are dropped then.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rows = stream.where(F.col(id_col).isNotNull()).mapInArrow(_first_of_batch(id_col, order), stream.schema)
    if watermark:
        rows = rows.withWatermark(*watermark)
    processor = _FirstOfStream(order, watermark[0] if watermark else None, _milliseconds(watermark[1]) if watermark else 0)
    once = rows.groupBy(id_col).transformWithState(processor, stream.schema, "append", "eventTime" if watermark else "none")
    return once.unionByName(stream.where(F.col(id_col).isNull()))


def tumbling_counts(stream: DataFrame, ts: str, width: str, delay: str) -> DataFrame:
    """Rows per window of fixed ``width``; a window closes ``delay`` after its end.

    Counts are summed before the shuffle, so a crowded window is no hot spot.
    """
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, width).alias("window"))
        .agg(F.count("*").alias("n"))
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n"
        )
    )
