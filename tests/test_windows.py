"""Window planning against a plain recursive bisection, and its invariants."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from recordloom.operators import (
    HALF_OPEN,
    MS_INCLUSIVE,
    HalvingTree,
    assign_any_windows,
    assign_windows,
    count_by_window,
    count_leaves,
    paginate,
    page_count,
    plan_windows_by_count,
    split_windows,
    store_leaves,
    stored_leaves,
)

MS = timedelta(milliseconds=1)


def bisect(stamps, start, end, cap, mode, min_split=timedelta(seconds=1)):
    """Count, halve, repeat: one count per window."""
    upper = (lambda t: t < end) if mode == HALF_OPEN else (lambda t: t <= end - MS)
    n = sum(1 for t in stamps if start <= t and upper(t))
    if n <= cap or end - start <= min_split:
        return [(start, end, n)]
    middle = start + (end - start) / 2
    return bisect(stamps, start, middle, cap, mode, min_split) + bisect(
        stamps, middle, end, cap, mode, min_split
    )


def planned(spark, stamps, tree, cap, mode):
    df = spark.createDataFrame([(t,) for t in stamps], "ts timestamp_ntz")
    rows = plan_windows_by_count(df, "ts", tree, cap, mode).collect()
    return [(r.window_start, r.window_end, r.est_total) for r in rows]


def sample(seed, start, end, n):
    """Random instants, a burst inside one second, and instants close to edges."""
    rng = random.Random(seed)
    span = (end - start) // timedelta(microseconds=1)
    stamps = [start + timedelta(microseconds=rng.randrange(span)) for _ in range(n)]
    burst = start + (end - start) / 3
    stamps += [burst + timedelta(microseconds=rng.randrange(900_000)) for _ in range(n)]
    for level in range(1, 9):
        for node in range(1, 2**level, max(1, 2**level // 8)):
            edge = start + (end - start) * node / 2**level
            stamps += [edge + timedelta(microseconds=d) for d in (-1500, -1000, -500, -2, -1, 0, 1, 2)]
    return [t for t in stamps if start <= t < end]


SPANS = [
    (datetime(2024, 1, 1), datetime(2024, 1, 31)),
    (datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 17, 4)),  # 1024 s: halves evenly
    (datetime(2024, 1, 1), datetime(2024, 1, 1, 1, 23, 45, 678901)),  # odd microseconds
    (datetime(2016, 1, 1), datetime(2026, 3, 21)),
]


@pytest.mark.parametrize("mode", [HALF_OPEN, MS_INCLUSIVE])
@pytest.mark.parametrize("span", SPANS)
def test_plan_equals_recursive_bisection(spark, span, mode):
    start, end = span
    stamps = sample(7, start, end, 150)
    for cap in (3, 40):
        assert planned(spark, stamps, HalvingTree(start, end), cap, mode) == bisect(
            stamps, start, end, cap, mode
        )


def test_small_and_empty_spans(spark):
    start = datetime(2024, 1, 1)
    second = HalvingTree(start, start + timedelta(seconds=1))
    stamps = [start + timedelta(milliseconds=i) for i in range(10)]
    assert planned(spark, stamps, second, 3, HALF_OPEN) == [(start, start + timedelta(seconds=1), 10)]
    day = HalvingTree(start, start + timedelta(days=1))
    assert planned(spark, [], day, 3, HALF_OPEN) == [(start, start + timedelta(days=1), 0)]
    assert planned(spark, stamps, day, 10, HALF_OPEN) == [(start, start + timedelta(days=1), 10)]


@pytest.mark.parametrize("mode", [HALF_OPEN, MS_INCLUSIVE])
def test_assignment_agrees_with_the_plan(spark, mode):
    start, end = SPANS[2]
    stamps = sample(3, start, end, 200)
    tree = HalvingTree(start, end)
    df = spark.createDataFrame(list(enumerate(stamps)), "id long, ts timestamp_ntz")
    plan = plan_windows_by_count(df, "ts", tree, 20, mode)
    assigned = assign_windows(df, "ts", plan, tree, mode)
    counted = {(r.window_start, r.window_end): r.n for r in count_by_window(assigned).collect()}
    assert counted == {
        (r.window_start, r.window_end): r.est_total for r in plan.collect() if r.est_total
    }
    assert assigned.where((F.col("ts") < F.col("window_start")) | (F.col("ts") >= F.col("window_end"))).count() == 0
    if mode == HALF_OPEN:
        assert assigned.count() == len(stamps)


def test_assignment_sends_no_table_to_the_driver(spark, tmp_path):
    start = datetime(2024, 1, 1)
    tree = HalvingTree(start, start + timedelta(seconds=2**22))
    rows = spark.range(2000).selectExpr("id", "cast(timestamp_seconds(1704067200 + id * 1000) as timestamp_ntz) as ts")
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    count_leaves(rows, "ts", tree).write.parquet(str(tmp_path / "leaves"))
    leaves = spark.read.parquet(str(tmp_path / "leaves"))
    plan = plan_windows_by_count(rows, "ts", tree, 200, leaves=leaves)
    assigned = assign_windows(rows, "ts", plan, tree, leaves=leaves)
    # The files are small, but a leaf has a row for each level.
    assert assigned.count() == 2000
    assert "Broadcast" not in assigned._jdf.queryExecution().executedPlan().toString()


def test_split_windows(spark):
    day = datetime(2024, 1, 1)
    rows = [(day, day + timedelta(days=1)), (day, day + timedelta(seconds=1)), (day, day + timedelta(microseconds=3000003))]
    df = spark.createDataFrame(rows, "s timestamp_ntz, e timestamp_ntz")
    got = sorted((r.s, r.e) for r in split_windows(df, "s", "e").collect())
    want = []
    for s, e in rows:
        m = s + (e - s) / 2
        want += [(s, m), (m, e)] if e - s > timedelta(seconds=1) else [(s, e)]
    assert got == sorted(want)


def test_paginate_hot_window_and_null_window(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "w string, t int, id long")
    got = {r.id: (r.position, r.page) for r in paginate(df, "w", ["t", "id"], 25).collect()}
    for w in ("a", "b", None):
        ranked = sorted((t, i) for ww, t, i in rows if ww == w)
        for pos, (_, i) in enumerate(ranked, start=1):
            assert got[i] == (pos, -(-pos // 25))
    assert len(got) == 3000


def test_page_count(spark):
    df = spark.createDataFrame([(0,), (1,), (25,), (26,)], "n long")
    got = df.select(page_count(F.col("n"), 25).alias("p"), page_count(F.col("n"), 25, 2).alias("q")).collect()
    assert [(r.p, r.q) for r in got] == [(1, 2), (1, 3), (1, 3), (2, 4)]


@pytest.mark.parametrize("mode", [HALF_OPEN, MS_INCLUSIVE])
def test_any_windows_agree_with_brute_force(spark, mode):
    """Gaps, uneven lengths, a time that half of the records share, nulls, a clashing column, no windows."""
    start = datetime(2024, 1, 1)
    at = lambda us: start + timedelta(microseconds=us)
    rng = random.Random(4)
    cuts = sorted(rng.sample(range(0, 400_000), 60))
    windows = [(at(s), at(e)) for s, e in zip(cuts[::2], cuts[1::2])] + [(at(500_000), at(700_000)), (at(700_000), at(700_001)), (None, at(1))]
    times = [rng.choice([at(cuts[10]), at(rng.randrange(-10, 800_000)), at(rng.choice(cuts)), at(698_999)]) for _ in range(600)] + [None]
    records = spark.createDataFrame([(k, t, "x") for k, t in enumerate(times)], "id long, ts timestamp_ntz, window_end string")
    known = spark.createDataFrame(windows, "window_start timestamp_ntz, window_end timestamp_ntz")
    slack = timedelta(milliseconds=1) if mode == MS_INCLUSIVE else timedelta(microseconds=1)
    expected = {(k, s, e) for k, t in enumerate(times) if t for s, e in windows if s and s <= t <= e - slack}
    found = assign_any_windows(records.repartition(5), "ts", known, mode=mode)
    assert found.columns == ["id", "ts", "window_start", "window_end"]
    rows = [(r.id, r.window_start, r.window_end) for r in found.collect()]
    assert len(rows) == len(expected) > 300 and set(rows) == expected
    assert assign_any_windows(records, "ts", known.limit(0)).count() == 0


@pytest.mark.parametrize("mode", [HALF_OPEN, MS_INCLUSIVE])
def test_counts_of_batches_add_up(spark, tmp_path, mode):
    start, draw = datetime(2024, 1, 1), random.Random(8)
    tree = HalvingTree(start, start + timedelta(hours=3))
    stamps = [start + timedelta(microseconds=draw.randrange(3 * 3600 * 10**6)) for _ in range(300)]
    table = lambda some: spark.createDataFrame([(t,) for t in some], "ts timestamp_ntz")
    path = str(tmp_path)
    for batch, some in (("a", stamps[:200]), ("b", stamps[:50]), ("none", []), ("b", stamps[200:])):
        store_leaves(table(some), "ts", tree, path, batch, mode)
    # A tree with other leaves, below the same path.
    store_leaves(table(stamps), "ts", HalvingTree(start, start + timedelta(hours=4)), path, "a", mode)
    leaves = stored_leaves(spark, tree, path, mode)
    got = plan_windows_by_count(table([]), "ts", tree, 20, mode, leaves=leaves).collect()
    assert [(r.window_start, r.window_end, r.est_total) for r in got] == planned(spark, stamps, tree, 20, mode)
