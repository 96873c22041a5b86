"""Budgets against plain water filling, and what is taken against a sort of every leaf."""

import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from recordloom.llm.mixing import mix_sources

LEVELS, WEIGHTS = ("domain", "language", "origin"), {"domain": {"a": 5, "b": 3}, "language": {"x": 4}, "origin": {"s0": 0}}


def weight(level, name):
    return WEIGHTS[LEVELS[level]].get(name, 1)


def fill(budget, children):
    """Whole budgets by weight, none above its capacity; ``children`` is (capacity, weight, name)."""
    fed = sorted((c for c in children if c[1] > 0), key=lambda c: (c[0] / c[1], c[2]))
    out, left, ahead = {}, budget, sum(c[1] for c in fed)
    while fed and fed[0][0] * ahead <= fed[0][1] * left:
        capacity, w, name = fed.pop(0)
        out[name], left, ahead = capacity, left - capacity, ahead - w
    upto = 0
    for _, w, name in fed:
        out[name] = left * (upto + w) // ahead - left * upto // ahead
        upto += w
    return out


def brute(data, share, epochs, seed):
    sized = [(i, path, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, *path in data]
    leaves = defaultdict(int)
    for _, path, n in sized:
        leaves[tuple(p or "" for p in path)] += n
    budgets = {(): int(sum(leaves.values()) * share)}
    for level in range(3):
        for parent in [p for p in budgets if len(p) == level]:
            capacity = defaultdict(int)
            for leaf, n in leaves.items():
                if leaf[:level] == parent and all(weight(below, leaf[below]) > 0 for below in range(level + 1, 3)):
                    capacity[leaf[level]] += n * epochs
            for name, b in fill(budgets[parent], [(c, weight(level, n), n) for n, c in capacity.items()]).items():
                budgets[*parent, name] = b
    out = []
    for leaf, n in leaves.items():
        if not n or leaf not in budgets:
            continue
        whole, part = divmod(budgets[leaf], n)
        rows = [(i, k) for i, path, k in sized if tuple(p or "" for p in path) == leaf]
        out += [(i, e) for e in range(whole) for i, _ in rows]
        key = lambda i: hashlib.md5(f"{seed}:{whole}:{'' if i is None else i}".encode()).hexdigest()  # noqa: B023, E731
        taken = 0
        for h in sorted({key(i) for i, _ in rows}):
            same = [(i, k) for i, k in rows if key(i) == h]
            taken += sum(k for _, k in same)
            if taken > part:
                break
            out += [(i, whole) for i, _ in same]
    return sorted(out, key=str)


def mixed(df, share, epochs):
    level = lambda k: F.col(LEVELS[k])
    weights = {}
    for k, name in enumerate(LEVELS):
        case = F.lit(1)
        for value, w in WEIGHTS[name].items():
            case = F.when(level(k) == value, w).otherwise(case)
        weights[name] = case
    return mix_sources(df, {"domain": F.col("d"), "language": F.col("l"), "origin": F.col("o")}, weights, share, epochs, seed=9)


def test_mix_matches_brute_force(spark):
    draw = random.Random(4)
    data = [(draw.choice([k, k, None, 3]), draw.choice([None, "", *["w " * draw.randrange(1, 40)] * 9]), draw.choice("aab"),
             draw.choice(["x", "y", None]), f"s{draw.randrange(4)}") for k in range(400)]
    df = spark.createDataFrame(data, "doc_id long, text string, d string, l string, o string").repartition(5)
    df = df.withColumns({n: F.lit(n) for n in ("tokens", "at", "row", "key", "part", "epoch")})
    for share, epochs in ((0.3, 1), (0.9, 1), (1.5, 3), (9.0, 2), (0.0, 1)):
        out = mixed(df, share, epochs)
        assert sorted(out.columns) == sorted(df.columns)
        assert sorted(((r.doc_id, r.epoch) for r in out.collect()), key=str) == brute(data, share, epochs, 9)
    assert mixed(df.limit(0), 0.5, 1).count() == 0


def test_a_long_text_and_a_single_leaf(spark):
    data = [(1, "w " * 300_000, "a", "x", "s1"), (2, "w", "a", "x", "s1"), (2, "w", "a", "x", "s1")]
    df = spark.createDataFrame(data, "doc_id long, text string, d string, l string, o string")
    assert sorted((r.doc_id, r.epoch) for r in mixed(df, 0.5, 1).collect()) == brute(data, 0.5, 1, 9)
