"""Repeated units against a plain pass over the documents in order."""

import random
import re

import pytest
from pyspark.sql import functions as F

from recordloom.llm import queries
from recordloom.llm.substring_dedup import remove_repeats

ENDS = {"line": r"\n\s*", "paragraph": r"\n[^\S\n]*\n\s*", "sentence": r"(?<=[.!?])\s+|\n\s*", "clause": r"(?<=[.!?,;:])\s+|\n\s*"}


def brute(pairs, kind, min_words):
    """Units of all documents in order of their ids; a unit seen before is a repeat."""
    seen, out = set(), []
    for i, text in sorted(pairs):
        marks, start = [], 0
        for end, after in [*(m.span() for m in re.finditer(ENDS[kind], text)), (len(text), len(text))]:
            words = tuple(text[start:end].lower().split())
            if words:
                marks.append((start, len(words), words in seen))
                seen.add(words)
            start = after
        spans, run = [], []
        for k, mark in enumerate([*marks, (len(text), 0, False)]):
            if mark[2]:
                run.append(k)
                continue
            if run and sum(marks[j][1] for j in run) >= min_words:
                spans.append((marks[run[0]][0], mark[0]))
            run = []
        kept = "".join(c for k, c in enumerate(text) if not any(a <= k < b for a, b in spans))
        out.append((i, kept, spans))
    return out


def found(df):
    return sorted((r.doc_id, r.text, [tuple(s) for s in r.removed]) for r in df.collect())


def corpus(seed):
    draw = random.Random(seed)
    sentence = lambda: " ".join(draw.choices(["aa", "Bb", "cé", "dd", "e"], k=draw.randrange(1, 9))) + draw.choice([".", "!", "", "?", ",", ";"])
    pool = [sentence() for _ in range(60)]
    passage = [sentence() for _ in range(4)]
    out = []
    for k in range(40):
        parts = [draw.choice(pool) if draw.random() < 0.4 else sentence() for _ in range(draw.randrange(1, 25))]
        if k % 4 == 0:
            parts[1:1] = passage
        out.append((k, "".join(p + draw.choice([" ", "\n", "\n\n", "  "]) for p in parts)))
    return out


@pytest.mark.parametrize(("kind", "min_words"), [("line", 1), ("sentence", 8), ("clause", 5), ("paragraph", 3)])
def test_matches_a_plain_pass(rows, kind, min_words):
    pairs = corpus(len(kind))
    assert found(remove_repeats(rows(pairs), kind, min_words)) == brute(pairs, kind, min_words)


def test_passages_inside_lines(rows):
    draw = random.Random(9)
    word = lambda: "".join(draw.choices("abcdefgh", k=6)) + draw.choice(["", "", "", "", ",", "."])
    passage = [word() for _ in range(60)]
    hosts = [[word() for _ in range(80)] for _ in range(30)]
    data = [(k, " ".join(h[:k] + (passage if k % 2 else []) + h[k:])) for k, h in enumerate(hosts)]
    got = {r.doc_id: r.text for r in remove_repeats(rows(data)).collect()}
    assert all(got[k] == t for k, t in data if k % 2 == 0 or k == 1)
    for k, _ in data:
        if k % 2 and k > 1:
            assert len(got[k].split()) < 80 + 20 and set(hosts[k]) <= set(got[k].split())


def test_awkward_rows(rows):
    passage = " ".join(f"p{k}" for k in range(60)) + "."
    long = " ".join(f"s{k} is here." for k in range(30_000))
    pairs = [(1, None), (2, ""), (3, f"Start. {passage} End."), (4, f"Other {passage}"), (5, f"Odd. {passage}\nLast."), (6, long),
             (7, long), (None, passage), (8, passage), (9, "own. " * 60), (10, "x"), (10, "x")]
    df = rows(pairs).withColumns({n: F.lit(n) for n in ("digest", "row", "cut", "removed", "own_id")})
    out = remove_repeats(df)
    assert sorted(out.columns) == sorted(df.columns)
    got = {(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()}
    assert got == {(1, None), (2, ""), (3, pairs[2][1]), (4, pairs[3][1]), (5, "Odd. Last."), (6, long), (7, ""), (None, ""), (8, ""),
                   (9, "own. "), (10, "x")}
    spans = {r.doc_id: [tuple(s) for s in r.removed] for r in out.where("doc_id = 5").collect()}
    assert spans == {5: [(5, 5 + len(passage) + 1)]}
    assert remove_repeats(rows([])).count() == 0


def plain_passages(pairs, size):
    """Words covered by a window of ``size`` words that stands earlier, in order of the ids."""
    seen, out = set(), []
    for i, text in sorted(pairs):
        words, marks = text.lower().split(), set()
        for k in range(len(words) - size + 1):
            window = tuple(words[k : k + size])
            if window in seen:
                marks.update(range(k, k + size))
            seen.add(window)
        starts = [m.start() for m in re.finditer(r"\S+", text)] + [len(text)]
        spans = [(starts[k], starts[next(e for e in range(k, len(words) + 1) if e not in marks)]) for k in sorted(marks) if k - 1 not in marks]
        out.append((i, "".join(c for k, c in enumerate(text) if not any(a <= k < b for a, b in spans)), spans))
    return out


@pytest.mark.parametrize("size", [1, 2, 5, 8])
def test_passages_match_a_plain_pass(rows, size):
    pairs = [*corpus(size), (100, ""), (101, "aa Bb " * 20), *((k + 200, t) for k, t in corpus(size)[:8])]
    assert found(remove_repeats(rows(pairs), "passage", size)) == plain_passages(pairs, size)


@pytest.mark.parametrize("marks", [[""], ["", "", "", ",", "."]])
def test_passages_set_into_sentences_go_as_a_whole(rows, marks):
    draw = random.Random(len(marks))
    word = lambda: "".join(draw.choices("abcdefgh", k=6)) + draw.choice(marks)
    passages = [[word() for _ in range(n)] for n in (40, 51, 58, 60, 200)]
    hosts = [[word() for _ in range(60)] for _ in range(30)]
    data = [(k, " ".join(h[: k + 3] + passages[k % 5] + h[k + 3 :])) for k, h in enumerate(hosts)]
    got = {r.doc_id: r.text for r in remove_repeats(rows(data), "passage", 40).collect()}
    assert got == {k: t if k < 5 else " ".join(hosts[k]) for k, t in data}
    # One edited word: both sides that still have 40 words go, to the word.
    one, edited = passages[4], [*passages[4][:90], "new", *passages[4][91:]]
    pairs = [(1, " ".join(one)), (2, " ".join(["own", *edited, "end"]))]
    assert {r.doc_id: r.text for r in remove_repeats(rows(pairs), "passage", 40).collect()} == {1: pairs[0][1], 2: "own new end"}


def test_query_cuts_a_passage_inside_a_sentence(spark, tmp_path):
    passage = " ".join(f"p{k}" for k in range(55))
    spark.createDataFrame([(1, f"one {passage} two"), (2, f"three {passage} four")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.text for r in queries.op2_substring_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: f"one {passage} two", 2: "three four"}


def test_short_documents_count_as_earlier(rows):
    one, two = (" ".join(f"{c}{k}" for k in range(30)) + "." for c in "ab")
    got = {r.doc_id: r.text for r in remove_repeats(rows([(1, one), (2, two), (3, f"{one} {two}")]), "clause", 40).collect()}
    assert got == {1: one, 2: two, 3: ""}
