"""Time windows that hold at most so many records each.

A span is halved again and again until every piece is small enough or too short to
halve. Doing that top down would need one count per piece. Here one pass counts the
records of the finest possible pieces, called leaves, and every coarser piece is a
sum of leaves.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from recordloom.operators.filters import HALF_OPEN, MS_INCLUSIVE, check_mode, in_time_window
from recordloom.session import materialize

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_MICROSECOND = timedelta(microseconds=1)
_ONE_MS_US = 1000


def _micros(moment: datetime) -> int:
    aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    return (aware - _EPOCH) // _MICROSECOND


def _long(value: int | Column) -> Column:
    return (F.lit(value) if isinstance(value, int) else value).cast("bigint")


def _shift_right(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits.cast("int"))


def _midpoint(start: Column, end: Column) -> Column:
    """Middle of two instants in microseconds; a half goes to the even offset."""
    half = F.shiftright(end - start, 1)
    round_up = (end - start).bitwiseAND(half).bitwiseAND(_long(1))
    return start + half + round_up


@dataclass(frozen=True)
class HalvingTree:
    """The pieces one gets by halving ``[start, end)`` down to ``min_split``.

    A piece is a ``level`` (0 is the whole span) and its ``node`` number from the left
    on that level. All arithmetic is on microseconds since 1970 in UTC.
    """

    start: datetime
    end: datetime
    min_split: timedelta = timedelta(seconds=1)

    def __post_init__(self) -> None:
        if self.span_us <= 0:
            raise ValueError("the span must not be empty")
        if self.min_split < timedelta(milliseconds=2):
            raise ValueError("pieces shorter than a millisecond are not supported")

    @property
    def start_us(self) -> int:
        return _micros(self.start)

    @property
    def span_us(self) -> int:
        return _micros(self.end) - _micros(self.start)

    @property
    def min_split_us(self) -> int:
        return self.min_split // _MICROSECOND

    @property
    def depth(self) -> int:
        """Number of halvings after which no piece is longer than ``min_split``."""
        longest, depth = self.span_us, 0
        while longest > self.min_split_us:
            longest, depth = (longest + 1) // 2, depth + 1
        return depth

    def bounds(self, level: Column | int, node: Column) -> Column:
        """``struct<start, end>`` of a piece, by repeating the halvings that lead to it."""
        level = _long(level)
        whole = F.struct(
            _long(self.start_us).alias("start"), _long(self.start_us + self.span_us).alias("end")
        )

        def halve(piece: Column, step: Column) -> Column:
            middle = _midpoint(piece["start"], piece["end"])
            right = _shift_right(node, level - step).bitwiseAND(_long(1)) == 1
            return F.struct(
                F.when(right, middle).otherwise(piece["start"]).alias("start"),
                F.when(right, piece["end"]).otherwise(middle).alias("end"),
            )

        return F.when(level == 0, whole).otherwise(
            F.aggregate(F.sequence(_long(1), level), whole, halve)
        )

    def leaf(self, ts: Column) -> Column:
        """Number of the leaf that holds ``ts``; only meaningful inside the span.

        Leaves have almost equal width, so a division finds the leaf. Only an instant
        within rounding distance of an edge takes the exact way down the tree.
        """
        us = F.unix_micros(ts.cast("timestamp"))
        offset = us - _long(self.start_us)
        leaves = 2**self.depth
        if self.span_us % leaves == 0:
            width = _long(self.span_us // leaves)
            return ((offset - offset % width) / width).cast("bigint")
        width = F.lit(self.span_us / leaves)
        nearest = F.floor(offset / width)
        inside = offset - nearest * width
        # Rounded halves move an edge by less than one microsecond per level.
        slack = float(self.depth + 2)
        near_edge = (inside < slack) | (inside > width - slack)
        return F.when(near_edge, self._descend(us)).otherwise(nearest).cast("bigint")

    def _descend(self, us: Column) -> Column:
        whole = F.struct(
            _long(self.start_us).alias("start"),
            _long(self.start_us + self.span_us).alias("end"),
            _long(0).alias("node"),
        )

        def halve(piece: Column, _step: Column) -> Column:
            middle = _midpoint(piece["start"], piece["end"])
            right = us >= middle
            return F.struct(
                F.when(right, middle).otherwise(piece["start"]).alias("start"),
                F.when(right, piece["end"]).otherwise(middle).alias("end"),
                (piece["node"] * 2 + right.cast("bigint")).alias("node"),
            )

        return F.aggregate(
            F.sequence(F.lit(1), F.lit(self.depth)), whole, halve, lambda piece: piece["node"]
        )

    def in_last_ms(self, ts: Column, leaf: Column) -> Column:
        """Whether ``ts`` is later than the last millisecond mark before its leaf's end."""
        us = F.unix_micros(ts.cast("timestamp"))
        rough_end = _long(self.start_us) + (leaf + 1) * F.lit(self.span_us / 2**self.depth)
        far = rough_end - us > float(_ONE_MS_US + self.depth + 2)
        return F.when(far, F.lit(False)).otherwise(
            us > self.bounds(self.depth, leaf)["end"] - _ONE_MS_US
        )


def _window_time(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def count_leaves(records: DataFrame, ts: str, tree: HalvingTree, mode: str = HALF_OPEN) -> DataFrame:
    """``leaf, n, tail``: records in each leaf, and of those how many its last millisecond loses.

    One pass over the records, summed before the shuffle. Stored, the result serves the plan
    and the assignment.
    """
    check_mode(mode)
    column = F.col(ts)
    placed = in_time_window(records, ts, tree.start, tree.end).select(
        tree.leaf(column).alias("leaf"), column.alias("ts")
    )
    if mode == MS_INCLUSIVE:
        tail = F.count_if(tree.in_last_ms(F.col("ts"), F.col("leaf")))
    else:
        tail = F.lit(0).cast("bigint")
    return placed.groupBy("leaf").agg(F.count("*").alias("n"), tail.alias("tail"))


def _leaves_folder(path: str, tree: HalvingTree, mode: str) -> str:
    check_mode(mode)
    return f"{path}/tree={tree.start_us}-{tree.span_us}-{tree.depth}-{mode}"


def store_leaves(
    records: DataFrame, ts: str, tree: HalvingTree, path: str, batch_id: int | str, mode: str = HALF_OPEN
) -> None:
    """Keep the leaf counts of one batch of records below ``path``; a batch that comes again replaces its own."""
    counted = count_leaves(records, ts, tree, mode)
    counted.write.mode("overwrite").parquet(f"{_leaves_folder(path, tree, mode)}/batch_id={batch_id}")


def stored_leaves(spark: SparkSession, tree: HalvingTree, path: str, mode: str = HALF_OPEN) -> DataFrame:
    """``leaf, n, tail`` over all batches kept for this tree and mode.

    Counts add up, so a new batch is counted alone and the records of earlier ones are not read
    again. Counts of other trees or modes below the same path stay out.
    """
    kept = spark.read.schema("leaf bigint, n bigint, tail bigint").parquet(_leaves_folder(path, tree, mode))
    return kept.groupBy("leaf").agg(F.sum("n").alias("n"), F.sum("tail").alias("tail"))


def plan_windows_by_count(
    records: DataFrame,
    ts: str,
    tree: HalvingTree,
    cap: int = 9000,
    mode: str = HALF_OPEN,
    leaves: DataFrame | None = None,
) -> DataFrame:
    """Windows ``level, node, window_start, window_end, est_total, over_cap``, by start.

    A window is a piece with at most ``cap`` records whose parent has more. Empty
    pieces are windows too. A piece of at most ``min_split`` that still has more is
    kept as it is and marked ``over_cap``. In mode ``ms_inclusive`` the records in the
    last millisecond of a piece are not counted in it.

    ``leaves`` are the counts of ``count_leaves`` if they are known already. Leaves are
    dealt out in ranges, so siblings meet in a task and each task sends on about two rows for
    each of its leaves, not one for each leaf and level.
    """
    check_mode(mode)
    depth = tree.depth
    if leaves is None:
        leaves = count_leaves(records, ts, tree, mode)
    # One empty leaf, so that a span without records still yields its one window.
    zero = _long(0)
    seed = records.sparkSession.range(1).select(
        zero.alias("leaf"), zero.alias("n"), zero.alias("tail")
    )
    counted = leaves.unionByName(seed)
    if depth > 0:
        counted = counted.repartitionByRange("leaf")
    if depth == 0:
        whole = counted.agg((F.sum("n") - F.sum("tail")).alias("est_total"))
        return _finish(tree, whole.select(zero.alias("level"), zero.alias("node"), "est_total"), cap)

    # Per piece that is not a leaf: what its left and its right half hold.
    level = F.col("level")
    spread = counted.select("*", F.explode(F.sequence(_long(0), _long(depth - 1))).alias("level"))
    below = _shift_right(F.col("leaf"), F.lit(depth - 1) - level)
    leaves_below = F.call_function("shiftleft", _long(1), (F.lit(depth - 1) - level).cast("int"))
    at_end = (F.col("leaf") + 1) % leaves_below == 0
    halves = spread.select(
        "level",
        F.shiftright(below, 1).alias("node"),
        (below.bitwiseAND(_long(1)) == 1).alias("is_right"),
        "n",
        F.when(at_end, F.col("tail")).otherwise(zero).alias("tail"),
    )
    right = F.col("is_right")
    pieces = halves.groupBy("level", "node").agg(
        F.sum(F.when(right, zero).otherwise(F.col("n"))).alias("n_left"),
        F.sum(F.when(right, F.col("n")).otherwise(zero)).alias("n_right"),
        F.sum(F.when(right, zero).otherwise(F.col("tail"))).alias("tail_left"),
        F.sum(F.when(right, F.col("tail")).otherwise(zero)).alias("tail_right"),
    )
    total = F.col("n_left") + F.col("n_right") - F.col("tail_right")
    piece = pieces.withColumn("total", total)

    def window(level: Column, node: Column, est_total: Column) -> Column:
        return F.struct(
            level.alias("level"), node.alias("node"), est_total.alias("est_total")
        )

    def half(side: int, n: str, tail_name: str) -> Column:
        return window(level + 1, F.col("node") * 2 + side, F.col(n) - F.col(tail_name))

    both = F.array(half(0, "n_left", "tail_left"), half(1, "n_right", "tail_right"))
    whole = F.array(window(level, F.col("node"), F.col("total")))
    # Splittability hides behind the count: as a condition of its own it would be
    # pushed below the sums and evaluated for every leaf on every level.
    found = F.when(F.col("total") > cap, F.when(_is_splittable(tree), both)).when(
        level == 0, whole
    )
    windows = piece.select(F.inline(found)).where(
        (F.col("est_total") <= cap) | ~_is_splittable(tree)
    )
    return _finish(tree, windows, cap)


def _is_splittable(tree: HalvingTree) -> Column:
    bounds = tree.bounds(F.col("level"), F.col("node"))
    return bounds["end"] - bounds["start"] > tree.min_split_us


def _finish(tree: HalvingTree, windows: DataFrame, cap: int) -> DataFrame:
    with_bounds = windows.withColumn("bounds", tree.bounds(F.col("level"), F.col("node")))
    return with_bounds.select(
        "level",
        "node",
        _window_time(F.col("bounds.start")).alias("window_start"),
        _window_time(F.col("bounds.end")).alias("window_end"),
        "est_total",
        (F.col("est_total") > cap).alias("over_cap"),
    ).orderBy("window_start")


def assign_windows(
    records: DataFrame,
    ts: str,
    windows: DataFrame,
    tree: HalvingTree,
    mode: str = HALF_OPEN,
    leaves: DataFrame | None = None,
) -> DataFrame:
    """Each record with the ``window_start`` and ``window_end`` of its planned window.

    Windows are pieces of the tree, so the time range join is an equi-join: the few
    distinct leaves find their window by ``(level, node)`` and the records find it by
    leaf. A leaf has a row for each level that has windows, not for each level of the tree. That
    map has one row per leaf and may be far larger than the files it comes from let Spark expect, so
    neither join broadcasts; AQE splits a leaf that holds very many records. ``leaves`` are
    the counts of ``count_leaves`` if they are known; the records are then read once.
    """
    check_mode(mode)
    depth = tree.depth
    column = F.col(ts)
    placed = in_time_window(records, ts, tree.start, tree.end).withColumn("leaf", tree.leaf(column))
    leaves = placed.select("leaf").distinct() if leaves is None else leaves.select("leaf")
    # As many values as the tree has levels at most.
    levels = windows.agg(F.collect_set("level").alias("levels")).scalar()
    ancestors = leaves.select("leaf", F.explode(levels).alias("level")).withColumn(
        "node", _shift_right(F.col("leaf"), F.lit(depth) - F.col("level"))
    )
    leaf_windows = ancestors.hint("merge").join(
        windows.select("level", "node", "window_start", "window_end"), ["level", "node"]
    ).select("leaf", "window_start", "window_end")
    assigned = placed.hint("merge").join(leaf_windows, "leaf").drop("leaf")
    if mode == MS_INCLUSIVE:
        assigned = assigned.where(
            column.cast("timestamp_ntz") <= F.col("window_end") - F.expr("interval 1 millisecond")
        )
    return assigned


def assign_any_windows(
    records: DataFrame,
    ts: str,
    windows: DataFrame,
    start: str = "window_start",
    end: str = "window_end",
    mode: str = HALF_OPEN,
) -> DataFrame:
    """Each record with ``start`` and ``end`` of the window that holds it, whatever its windows are.

    Windows need no common tree: split again, of uneven lengths or with gaps between them,
    they must only not overlap. Records in no window, or without a time, are left out, and
    so are windows without bounds. Columns of the two names are replaced.

    Starts and records are sorted together by ranges of time and stored; within a range the
    last start before a record is its window's, and a range takes over the last start of
    those before it. Records of one time may lie in several ranges, so none is a hot one.
    """
    check_mode(mode)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    window = F.struct(F.col(start), F.col(end), micros(end).alias("ends"))
    kept = [c for c in records.columns if c not in (start, end)]
    starts = windows.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(
        micros(start).alias("at"), _long(0).alias("tie"), window.alias("window"))
    times = records.where(F.col(ts).isNotNull()).select(
        micros(ts).alias("at"), (F.monotonically_increasing_id() + 1).alias("tie"), F.struct("*").alias("row"))
    both = starts.unionByName(times, allowMissingColumns=True)
    ordered = both.repartitionByRange("at", "tie").sortWithinPartitions("at", "tie")
    stored = materialize(ordered.withColumn("place", F.monotonically_increasing_id())).withColumn("part", F.shiftright("place", 33))

    last_start = F.max_by("window", F.when(F.col("window").isNotNull(), F.col("place")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    carried = stored.groupBy("part").agg(last_start.alias("latest")).select(
        "part", F.last("latest", ignorenulls=True).over(before).alias("carried"))
    upto = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = stored.withColumn("latest", F.last("window", ignorenulls=True).over(upto)).join(carried, "part")
    found = found.withColumn("window", F.coalesce("latest", "carried"))
    least_left = _ONE_MS_US if mode == MS_INCLUSIVE else 1
    return found.where(F.col("row").isNotNull() & (F.col("at") <= F.col("window.ends") - least_left)).select(
        *(F.col("row")[c].alias(c) for c in kept), F.col("window")[start].alias(start), F.col("window")[end].alias(end))


def count_by_window(assigned: DataFrame) -> DataFrame:
    """Records per window; hot windows are summed before the shuffle."""
    return assigned.groupBy("window_start", "window_end").agg(F.count("*").alias("n"))


def split_windows(
    windows: DataFrame, start: str, end: str, min_split: timedelta = timedelta(seconds=1)
) -> DataFrame:
    """Halve every window once at its midpoint; one too short to halve stays whole."""
    s = F.unix_micros(F.col(start).cast("timestamp"))
    e = F.unix_micros(F.col(end).cast("timestamp"))
    middle = _midpoint(s, e)
    pieces = F.when(
        e - s > min_split // _MICROSECOND,
        F.array(
            F.struct(s.alias("s"), middle.alias("e")), F.struct(middle.alias("s"), e.alias("e"))
        ),
    ).otherwise(F.array(F.struct(s.alias("s"), e.alias("e"))))
    others = [c for c in windows.columns if c not in (start, end)]
    return windows.select(*others, F.explode(pieces).alias("piece")).select(
        *others,
        _window_time(F.col("piece.s")).alias(start),
        _window_time(F.col("piece.e")).alias(end),
    )
