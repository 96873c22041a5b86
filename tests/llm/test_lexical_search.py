"""Ranked search against scoring every document for every query."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from recordloom.llm import lexical_search
from recordloom.llm.lexical_search import build_index, impacts, search, sketch_of, terms_of

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return _TERM.findall((text or "").translate(_LOWER))


def brute(docs, queries, k):
    held = [(d, Counter(_terms(t)), len(_terms(t))) for d, t in docs if _terms(t)]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    rows = []
    for q, text in {(q, " ".join(sorted(set(_terms(t))))) for q, t in queries}:
        scored = []
        for d, counts, n in held:
            m = 50 + (50 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 20 * m))
                        for t in text.split() if t in counts)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        rows += [(q, i + 1, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(scored)[:k])]
    return sorted(rows, key=str)


def _found(spark, docs, queries, k, partitions=3):
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("terms", "sketch", "score")})
    asked = spark.createDataFrame(queries, "item_id long, text string").withColumns({c: F.lit(c) for c in ("query", "terms", "rank")})
    return sorted((tuple(r) for r in search(build_index(frame.repartition(partitions)), asked, k).collect()), key=str)


def _corpus(seed, n):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["İst", "ÉTÉ", "naïve", "x_y", "A-B", "ж"]
    return [(i, " ".join(draw.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=draw.choice([1, 5, 40, 400])))) for i in range(n)]


def test_agrees_with_scoring_everything(spark):
    docs = _corpus(1, 300)
    docs += [(1000 + i, docs[7][1]) for i in range(40)]  # a group of copies: ties by id
    docs += [(None, docs[7][1]), (7, docs[7][1]), (2000, None), (2001, ""), (2002, "... !!"), (2003, "w1 " * 70_000)]
    queries = [(i, t) for i, t in _corpus(2, 12)] + [(50, docs[7][1]), (51, None), (52, "unseen"), (50, "w3 W3 w3"), (50, "w3"), (None, "w5 w6")]
    assert _found(spark, docs, queries, 20) == brute(docs, queries, 20)


def test_blocks_of_queries_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "QUERIES_TOGETHER", 2)
    monkeypatch.setattr(lexical_search, "_CHUNK", 16)
    monkeypatch.setattr(lexical_search, "_FIRST", 2)
    docs, queries = _corpus(3, 200), _corpus(4, 7)
    assert _found(spark, docs, queries, 5) == brute(docs, queries, 5)


def test_empty_tables(spark):
    assert _found(spark, [], [(1, "a")], 5) == []
    assert _found(spark, [(1, None), (2, " ")], [(1, "a")], 5) == []
    assert _found(spark, [(1, "a")], [], 5) == []


def test_sketch_bounds_every_impact():
    draw = random.Random(5)
    for _ in range(50):
        counts = Counter(terms_of(" ".join(f"t{draw.randrange(5000)}" for _ in range(draw.choice([1, 50, 3000]))).encode()))
        occurrences = np.array(list(counts.values()), np.uint32)
        sketch = sketch_of(list(counts), occurrences)
        for term, n in counts.items():
            assert sketch[lexical_search.zlib.crc32(term) % lexical_search.WIDTH] >= min(n, 255)
        assert np.count_nonzero(sketch) <= len(counts)
    assert impacts(np.array([10**7]), np.array([50]))[0] < lexical_search._LIMIT


def test_few_documents_are_scored(spark, monkeypatch):
    """The bounds do their work: of copies of common documents hardly any is scored for a rare query."""
    seen = []
    real = lexical_search.impacts
    monkeypatch.setattr(lexical_search, "impacts", lambda o, n: (seen.append(np.ndim(n)), real(o, n))[1])
    docs = [(i, f"common filler words {i} " + ("needle " * 3 if i == 77 else "")) for i in range(2000)]
    index = build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).toPandas()
    known = {b"needle": 0}
    run = lexical_search._searcher([(1, [b"needle"])], known, np.array([7000]), 2000, 8003, 1, lexical_search.pa.int64())
    batch = lexical_search.pa.RecordBatch.from_pandas(index)
    out = list(run(iter([batch])))[0].to_pydict()
    assert out["doc_id"] == [77]
    # Calls with one length are documents scored exactly; those with many bound a chunk.
    assert sum(1 for n in seen if n == 0) < 200
