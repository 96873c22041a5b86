"""Exact sizes, whole rows, repeatable results and counts as the hypergeometric law has them."""

import zlib
from collections import Counter, defaultdict
from math import comb, isclose, log

import numpy as np
from pyspark.sql import functions as F

from recordloom.llm import sharding
from recordloom.llm.queries import op1_sharding
from recordloom.llm.sharding import binomial_log, block_row, draw_hypergeometric, shard_rows, shard_sizes


def check(df, shards, **options):
    got = shard_rows(df, shards, **options).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[k]) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter(map(str, (r[:-2] for r in got))) == Counter(str(tuple(r)) for r in df.collect())
    return {(r.shard, r.slot): r[0] for r in got}


def test_exact_shards(rows):
    df = rows([(k, f"t{k}") for k in range(500)], partitions=7)
    once, again = check(df, 6, part_rows=20), check(df, 6, part_rows=20)
    assert once == again
    assert check(df, 6, seed=4, part_rows=20) != once
    order = [once[k] for k in sorted(once)]
    assert abs(np.corrcoef(order, range(500))[0, 1]) < 0.2


def test_awkward_rows(rows):
    df = rows([(None, None), (1, ""), (1, ""), (2, "x " * 200_000), (3, None)]).withColumns(
        {n: F.lit(n) for n in ("row", "at", "part", "nth", "order", "first", "held")})
    check(df, 3)
    check(df, 24)
    assert shard_rows(rows([]), 4).count() == 0
    clash = shard_rows(df.withColumn("shard", F.lit("old")), 2)
    assert {r.shard for r in clash.collect()} == {0, 1}


def test_matrix_is_exact_and_hypergeometric():
    upto, seeds = np.array([0, 30, 30, 100, 160]), range(400)
    sizes = shard_sizes(160, 3)
    first = []
    for seed in seeds:
        matrix = np.array([block_row(k, upto, sizes, seed) for k in range(4)])
        assert (matrix.sum(0) == sizes).all() and (matrix.sum(1) == np.diff(upto)).all() and (matrix >= 0).all()
        first.append(matrix[2, 1])
    n, good, draws = 160, sizes[1], 70
    mean = draws * good / n
    variance = mean * (1 - good / n) * (n - draws) / (n - 1)
    assert abs(np.mean(first) - mean) < 4 * (variance / len(seeds)) ** 0.5
    assert 0.75 < np.var(first) / variance < 1.3


def test_binomial_probabilities():
    for n, p in ((1, 0.5), (7, 0.3), (40, 0.9), (500, 0.02)):
        for x in range(n + 1):
            exact = log(comb(n, x)) + x * log(p) + (n - x) * log(1 - p)
            assert isclose(binomial_log(x, n, p), exact, rel_tol=1e-9, abs_tol=1e-9)


def test_draws_beyond_numpys_range(monkeypatch):
    # The same sampler on small numbers, against the law itself.
    monkeypatch.setattr(sharding, "_NUMPY_MOST", 0)
    for good, bad, draws in ((9, 30, 12), (30, 9, 12), (5, 5, 10), (6, 6, 0), (4, 3, 6)):
        rng, n = np.random.default_rng(1), 20_000
        got = Counter(draw_hypergeometric(rng, good, bad, draws) for _ in range(n))
        for x in range(draws + 1):
            law = comb(good, x) * comb(bad, draws - x) / comb(good + bad, draws)
            assert abs(got[x] / n - law) <= 5 * (law * (1 - law) / n) ** 0.5
    monkeypatch.undo()
    good, bad, draws = 4 * 10**9, 10**11, 3 * 10**10
    rng = np.random.default_rng(2)
    got = np.array([draw_hypergeometric(rng, good, bad, draws) for _ in range(2_000)], float)
    share = good / (good + bad)
    variance = draws * share * (1 - share) * (1 - draws / (good + bad))
    assert abs(got.mean() - draws * share) < 4 * (variance / len(got)) ** 0.5
    assert 0.85 < got.var() / variance < 1.15


def test_registered_query(spark, rows, tmp_path):
    data = [(k, None if k % 7 == 0 else "é" * (k % 5)) for k in range(100)]
    rows(data, partitions=3).write.parquet(f"{tmp_path}/documents.parquet")
    got = op1_sharding(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {
        (k, 8 + len((t or "").encode()), zlib.crc32((t or "").encode())) for k, t in data}
    assert len(got) == 100 and {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    assert sorted(Counter(r.shard for r in got).values()) == [4] * 20 + [5] * 4
