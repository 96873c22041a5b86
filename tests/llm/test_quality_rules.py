"""Statistics against a plain count, rules on planted thresholds, held-out labels, awkward rows."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from recordloom.llm.quality_rules import Condition, judge_quality, learn_rules, text_statistics


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    times, hit, seen, dup = Counter(windows), set(), set(), 0
    for k, w in enumerate(windows):
        if times[w] > 1:
            hit |= {k, k + 1, k + 2}
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def test_statistics_match_a_plain_count():
    draw = random.Random(1)
    texts = [None, "", " \n ", "a", "a b", "a b c a b c", "É\x85x # |\x1c<>\n\nÉ\x85x # |\x1c<>\n \n ", "x " * 50_000]
    texts += ["".join(draw.choices(["a ", "b ", "c\n", "#d ", "É\t"], k=draw.randrange(1, 90))) for _ in range(300)]
    for text in texts:
        assert text_statistics(text)[:5] == plain(text)


def test_rules_find_planted_thresholds():
    draw = np.random.default_rng(2)
    x, y, z = draw.random((3, 4000))
    bad = (x > 0.8) | ((y < 0.2) & (z > 0.5))
    rules = learn_rules({"x": x, "y": y, "z": z}, bad)
    hit = np.zeros(len(bad), bool)
    for rule in rules:
        hit |= np.logical_and.reduce([c.holds({"x": x, "y": y, "z": z}) for c in rule])
    assert (hit & bad).sum() / bad.sum() > 0.95 and (hit & bad).sum() / hit.sum() > 0.95
    assert learn_rules({"x": x}, np.zeros(len(x), bool)) == []
    assert learn_rules({"x": x}, draw.random(len(x)) < 0.1) == []
    assert str(Condition("x", True, 0.5)) == "x >= 0.5"


def test_held_out_labels(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{base}/{n}.parquet") for n in ("documents", "labels"))
    train = labels.where("pmod(xxhash64(doc_id), 2) = 0")
    got = judge_quality(docs, train).join(labels.where("pmod(xxhash64(doc_id), 2) = 1"), "doc_id")
    r = got.where("not base_failed").agg(
        F.avg(F.expr("if(kept, 1, 0)")).alias("kept"), F.avg(F.expr("if(quality = 1, if(kept, 1, 0), null)")).alias("good")).first()
    assert r.good > 0.95


def test_awkward_rows(rows, spark):
    pairs = [(None, None), (1, ""), (2, "one two"), (2, "one two"), (3, "w " * 60), (4, " ".join(f"w{k}" for k in range(80)))]
    df = rows(pairs).withColumns({n: F.lit(n) for n in ("statistics", "rule", "kept", "n_words")})
    labels = spark.createDataFrame([(None, 1, 0), (4, None, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")
    got = sorted(((r.doc_id, r.n_words, r.base_failed, r.kept) for r in judge_quality(df, labels).collect()), key=str)
    assert got == sorted([(None, 0, True, False), (1, 0, True, False), (2, 2, True, False), (2, 2, True, False), (3, 60, True, False),
                          (4, 80, False, True)], key=str)
    assert judge_quality(rows([]), labels).count() == 0
