"""Near duplicates against all pairs, planted groups and awkward rows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm.near_dedup import BASE, DEPTH, TREES, _keys, _walk_trees, drop_near_duplicates, near_duplicates


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def brute(pairs, width, percent=80):
    sets = [(i, shingles(t, width)) for i, t in pairs]
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    groups = {}
    for k, (i, _) in enumerate(sets):
        groups.setdefault(find(k), []).append(i)
    return sorted(
        ((i, len(s), min((x for x in groups[find(k)] if x is not None), default=None)) for k, (i, s) in enumerate(sets)),
        key=str,
    )


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def corpus(seed, n=160):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)] + ["É", "Ab", "x y"]
    base = " ".join(draw.choices(vocabulary, k=60))
    out = []
    for k in range(n):
        if k % 3 == 0:
            words = base.split()
            for _ in range(draw.randrange(0, 9)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            out.append((k, " ".join(words)))
        elif k % 3 == 1 and out:
            out.append((k, draw.choice(out)[1].upper() if draw.random() < 0.5 else draw.choice(out)[1] + " tail"))
        else:
            out.append((k, " ".join(draw.choices(vocabulary, k=draw.randrange(1, 50)))))
    return out


@pytest.mark.parametrize(("width", "seed"), [(2, 1), (5, 2)])
def test_components_match_all_pairs(rows, width, seed):
    pairs = corpus(seed)
    assert found(near_duplicates(rows(pairs), width)) == brute(pairs, width)


def test_awkward_rows(rows):
    long = " ".join(f"v{k % 977}" for k in range(40_000))
    pairs = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, long), (7, long + " more"), (None, "one two three"),
             (8, "one two three"), (None, "alone here now"), (None, None), (9, "same"), (9, "same"), (9, "other thing")]
    assert found(near_duplicates(rows(pairs), 2)) == brute(pairs, 2)
    kept = {(r.doc_id, r.text) for r in drop_near_duplicates(rows(pairs), 2).collect()}
    assert kept == {(1, None), (2, ""), (3, " \t\n"), (4, "one"), (6, long), (8, "one two three"), (None, "alone here now"),
                    (None, None), (9, "same"), (9, "other thing")}


def test_no_rows_and_other_columns(rows):
    assert near_duplicates(rows([]), 2).count() == 0
    df = rows(corpus(3, 30)).withColumns({n: F.lit(n) for n in ("node", "root", "digest", "component_id", "nth")})
    assert found(near_duplicates(df, 2)) == brute(corpus(3, 30), 2)
    out = drop_near_duplicates(df, 2)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted({c for *_, c in brute(corpus(3, 30), 2)})


def test_no_link_lost_at_the_threshold(rows):
    # Ninety distinct words, ten of them new in the copy: 80 words shared of 100, so exactly 0.8 with one-word shingles.
    pairs = []
    for k in range(2000):
        words = [f"p{k}w{j}" for j in range(100)]
        pairs += [(2 * k, " ".join(words[:90])), (2 * k + 1, " ".join(words[:80] + words[90:]))]
    got = near_duplicates(rows(pairs), 1)
    assert got.where("component_id <> doc_id - doc_id % 2").count() == 0


def test_regions_that_reach_over_ranges(spark, rows):
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    before = {n: spark.conf.get(n) for n in names}
    base = [f"b{k}" for k in range(80)]
    pairs = [(k, " ".join([*base[: k % 4], f"new{k}", *base[k % 4 :]])) for k in range(400)] + corpus(5, 60)[1::3]
    pairs = [(k, t) for k, (_, t) in enumerate(pairs)]
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        assert found(near_duplicates(rows(pairs), 2)) == brute(pairs, 2)
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_neighbours_have_the_longest_common_prefix(spark):
    draw = random.Random(3)
    values = [(t, *(draw.randrange(2) << 48 | draw.randrange(2) << 32 for _ in range(2)), n) for n in range(300) for t in range(2)]
    ordered = spark.createDataFrame(values, "tree int, high long, low long, node long").coalesce(1).sortWithinPartitions(
        "tree", "high", "low", "node")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = ordered.mapInArrow(_walk_trees, "node long, region long, neighbour long, part int, edge int").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = []
    rank = sorted(values)
    for k, (tree, high, low, node) in enumerate(rank):
        near = [r for r in rank[:k] if (r[0], r[1]) == (tree, high) and r[2] >> 48 == low >> 48]
        if near:
            run = max(r[2] for r in near)
            expected.append((node, next(r[3] for r in near if r[2] == run)))
    assert [(r.node, r.neighbour) for r in got if r.neighbour is not None] == expected
    assert [r.edge for r in got if r.edge] == [1, 2]


def test_keys_keep_the_order_of_values():
    values = np.random.default_rng(1).integers(0, 2**63, TREES * DEPTH, dtype=np.uint64)
    other = values.copy()
    other[BASE::DEPTH] += np.uint64(1)  # the first BASE values of each tree stay
    (high, low, _), (high2, low2, _) = _keys(values), _keys(other)
    assert (high == high2).all() and ((low ^ low2) >> 48 == 0).all() and (low != low2).any()
