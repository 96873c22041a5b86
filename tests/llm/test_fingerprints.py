"""Sketches as estimates, merging, and the query's edits and order against a plain reading."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from recordloom.llm import queries
from recordloom.llm.fingerprints import containment, likeness, merged, with_fingerprint


def text_of(draw, n):
    return " ".join(f"w{draw.randrange(100_000)}" for _ in range(n))


def test_containment_between_unequal_texts(spark):
    draw = random.Random(1)
    small = text_of(draw, 3000)
    large = text_of(draw, 60_000) + " " + " ".join(small.split()[:1500])
    df = spark.createDataFrame([(small, large)], "a string, b string")
    df = with_fingerprint(with_fingerprint(df, "x", F.col("a")), "y", F.col("b"))
    r = df.select("x", "y", containment(F.col("x"), F.col("y")).alias("part"), F.size(merged(F.col("x"), F.col("y"))).alias("both")).first()
    assert abs(r.part - 0.5) < 0.12
    assert abs(len(r.y) / (61_500 / 8) - 1) < 0.1
    assert r.x == sorted(r.x) and r.both == len(set(r.x) | set(r.y))


def test_awkward_texts(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate([None, "", " \n", "one", "One", "two", "a b c d", "a b c d e", "x " * 200_000])],
                               "k int, t string")
    df = df.withColumns({n: F.lit(n) for n in ("_other", "_words", "_shingles", "_kept", "f")})
    kept = with_fingerprint(df, "f", F.col("t"), fraction=1)
    assert kept.columns == df.columns and kept.select("_words", "_shingles", "_kept").distinct().collect() == [("_words", "_shingles", "_kept")]
    got = {r.k: r.f for r in kept.collect()}
    assert got[0] == got[1] == got[2] == [] and got[3] == got[4] != got[5]
    assert len(got[3]) == len(got[6]) == len(got[7]) == len(got[8]) == 1
    pairs = spark.createDataFrame([([], []), ([], [1]), ([1, 2], [2])], "a array<long>, b array<long>")
    assert [r[0] for r in pairs.select(likeness(F.col("a"), F.col("b"))).collect()] == [0.0, 0.0, 1.0]


@pytest.mark.parametrize("ids", [[5, 3, 9, 1, 7], [4], []])
def test_query_edits(spark, tmp_path, ids):
    draw = random.Random(len(ids))
    texts = {i: text_of(draw, draw.randrange(1, 400)) + " é😀" for i in ids}
    if len(ids) > 3:
        texts[3], texts[9] = "", "ab"
    data = [(i, texts[i] or None, "en") for i in ids]
    spark.createDataFrame(data, "doc_id long, text string, hash string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op6_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted(ids, reverse=True)
    assert sorted(got) == sorted(ids)
    for k, i in enumerate(order):
        text, following = texts[i], texts[order[(k + 1) % len(order)]]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        if len(text.split()) > 200:
            assert got[i].near_edited > 0.35


def test_one_rule_for_all_lengths_against_sets(spark):
    """A fingerprint is what lies below the fraction among all hashes, and the estimates keep to their error."""
    draw = random.Random(4)
    data = []
    for n in (6, 12, 40, 300, 2000):
        for _ in range(20):
            words = text_of(draw, n).split()
            data.append((" ".join(words), " ".join(words[: n // 2 + 3] + text_of(draw, n).split())))
    df = spark.createDataFrame(data, "a string, b string").withColumn("both", F.concat_ws("\n", "a", "b"))
    for name in ("a", "b"):
        df = with_fingerprint(with_fingerprint(df, f"{name}_print", F.col(name)), f"{name}_all", F.col(name), fraction=1)
    x, y = F.col("a_print"), F.col("b_print")
    worst = 0
    for r in df.select("*", containment(x, y).alias("part"), merged(x, y).alias("merged")).collect():
        for name in ("a", "b"):
            assert r[f"{name}_print"] == [h for h in r[f"{name}_all"] if h <= -(2**63) + 2**61]
        one, other = ({tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in (r.a, r.b))
        assert (len(r.a_all), len(r.b_all)) == (len(one), len(other))
        assert r.merged == sorted({*r.a_print, *r.b_print})
        if len(one) > 1000:
            worst = max(worst, abs(r.part - len(one & other) / len(one)))
    assert 0 < worst < 0.15
