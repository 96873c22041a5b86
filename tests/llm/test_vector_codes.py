"""Codes and codebooks against plain k-means, and balls against all distances."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from recordloom.llm.vector_codes import ball_assign, codebooks_digest, decode, fit_and_encode, with_label_error

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts, entries, rounds):
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda r: kept[r][0])[:entries]
    books = [[cut[r][p] for r in first] for p in range(parts)]

    def far(x, e):
        return sum((a - b) ** 2 for a, b in zip(x, e))

    def nearest(p):
        return [min(range(len(books[p])), key=lambda e: (far(c[p], books[p][e]), e)) for c in cut]

    for _ in range(rounds):
        for p in range(parts):
            codes = nearest(p)
            for e in range(len(books[p])):
                mine = [c[p] for c, k in zip(cut, codes) if k == e]
                if mine:
                    books[p][e] = tuple(sum(col) // len(mine) for col in zip(*mine))
    codes = [nearest(p) for p in range(parts)]
    errors = [sum(far(c[p], books[p][codes[p][r]]) for p in range(parts)) for r, c in enumerate(cut)]
    return [(kept[r][0], "".join(f"{codes[p][r]:02x}" for p in range(parts)), errors[r], kept[r][2]) for r in range(len(kept))], books


def test_agrees_with_plain_k_means(spark):
    draw = random.Random(3)
    centres = [[draw.gauss(0, 0.3) for _ in range(16)] for _ in range(9)]
    rows = [(i, [c + draw.gauss(0, 0.05) for c in draw.choice(centres)], draw.choice([None, 1, 2, 3])) for i in range(400)]
    rows += [(1000 + i, rows[5][1], 9) for i in range(60)]  # copies
    rows += [(2000, [0.5, 0.0] * 8, 1), (2001, [-0.5] * 16, None)]
    bad = [(-1, None, 1), (-2, [None] + [0.1] * 15, 1), (-3, [float("nan")] * 16, 1), (-4, [0.1] * 15 + [float("inf")], 1), (-5, [], 1)]
    frame = spark.createDataFrame(rows + bad, SCHEMA).repartition(5).withColumns({c: F.lit(c) for c in ("codes", "vector", "error", "that")})
    coded, books = fit_and_encode(frame, parts=4, entries=16, rounds=6)
    want, want_books = brute(rows, 4, 16, 6)
    assert books.tolist() == [[list(e) for e in part] for part in want_books]
    total = {}
    for _, _, error, label in want:
        total[label] = total.get(label, 0) + error
    got = sorted(tuple(r) for r in with_label_error(coded).select("vec_id", "code", "error", "label_error").collect())
    assert got == sorted((i, code, error, total[label]) for i, code, error, label in want)
    assert codebooks_digest(books) == __import__("hashlib").sha256(",".join(str(x) for p in want_books for e in p for x in e).encode()).hexdigest()
    vector = {i: v for i, v, _ in rows}
    for i, code, error, _ in got[:20]:
        lost = sum((a - b) ** 2 for a, b in zip(vector[i], decode(code, books)))
        assert abs(lost - error / 4096**2) < 0.01


def test_balls_equal_all_distances_and_save_work():
    draw = np.random.default_rng(1)
    for case in range(40):
        k = int(draw.integers(1, 17))
        entries = draw.integers(-40, 40, (k, 3)) if case % 2 else draw.integers(-3, 3, (k, 3))  # the latter with ties
        points = draw.integers(-60, 60, (300, 3)) if case % 2 else draw.integers(-4, 4, (300, 3))
        all_apart = ((points[:, None, :] - entries[None]) ** 2).sum(-1)
        codes, apart, _ = ball_assign(points, entries, draw.integers(0, k, 300))
        assert (codes == all_apart.argmin(1)).all() and (apart == all_apart.min(1)).all()
    entries = draw.integers(-4000, 4000, (16, 8))
    points = entries[draw.integers(0, 16, 5000)] + draw.integers(-50, 50, (5000, 8))
    codes, _, _ = ball_assign(points, entries, np.zeros(5000, np.int64))
    assert ball_assign(points, entries, codes)[2] == 0  # everything lies in a stable core


def test_few_rows_lengths_and_no_rows(spark):
    rows = [(1, [0.25] * 8, 1), (2, [-0.25] * 8, None), (None, [0.0] * 8, 2), (3, [0.1] * 16, 1), (4, [0.1] * 7, 1), (5, [1e30] * 8, 1), (1, [0.25] * 8, 1)]
    coded, books = fit_and_encode(spark.createDataFrame(rows, SCHEMA), parts=8, entries=16, rounds=2)
    assert books.shape == (8, 4, 1)
    got = sorted(coded.select("vec_id", "error").collect(), key=str)
    assert [tuple(r) for r in got] == [(1, 0), (1, 0), (2, 0), (None, 0)]
    none, books = fit_and_encode(spark.createDataFrame([], SCHEMA))
    assert with_label_error(none).collect() == [] and books.size == 0
    assert codebooks_digest(books) == __import__("hashlib").sha256(b"").hexdigest()
