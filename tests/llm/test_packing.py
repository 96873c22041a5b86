"""Packed pieces: ids as the tokenizer gives them, no gaps, little padding, best fit by brute force."""

import random
import struct
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordloom.llm import packing
from recordloom.llm.packing import best_fit_decreasing, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_best_fit(lengths, window):
    left, places, offsets = [], {}, {}
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        fits = [(room, w) for w, room in enumerate(left) if room >= lengths[k]]
        if not fits:
            left.append(window)
            fits = [(window, len(left) - 1)]
        least = min(room for room, _ in fits)
        places[k] = least
        left[next(w for room, w in fits if room == least)] -= lengths[k]
    return sorted(left), places


@pytest.mark.parametrize("window", [7, 64, 2048])
def test_best_fit(window):
    draw = random.Random(window)
    lengths = [draw.randrange(1, window + 1) for _ in range(400)]
    places, offsets, used = best_fit_decreasing(lengths, window)
    left, rooms = plain_best_fit(lengths, window)
    filled = defaultdict(int)
    for k in range(len(lengths)):
        filled[places[k]] += lengths[k]
        assert offsets[k] == window - rooms[k]
    assert sorted(window - filled[w] for w in range(used)) == left
    assert best_fit_decreasing([], window) == ([], [], 0)


def pieces(df):
    return df.withColumn("ids", F.col("ids")).collect()


def test_round_trip(rows, spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    odd = [None, "", " \n\t", "W̊ ẘ İİ", "a b don't DON'T. x.y, €., é.É, 3.14  z", "ß. ª, <|endoftext|>. <|endoftext|>",
           "İ. İ, Ǆ. aİ. ﬁ. x̌.", " lead\ttrail ", "word " * 9000, "ΑΣ ΑΣ. ſs 'S 's. é. É, ẞ À̖", "\x1c\x85x\x0by", "同じ。 ok"]
    pairs = list(enumerate([*texts, *odd])) + [(None, "no id"), (5, "twice"), (5, "twice")]
    exact = Tokenizer.from_file(PATH)
    want = sorted((tuple([*exact.encode(t or "", add_special_tokens=False).ids, 1]), str(i)) for i, t in pairs)
    df = rows(pairs).withColumns({n: F.lit(n) for n in ("ids", "offset", "start")})
    got, windows, docs = pieces(pack_documents(df, PATH, block_tokens=20_000)), defaultdict(list), defaultdict(list)
    for r in got:
        ids = struct.unpack(f"<{len(r.ids) // 4}I", r.ids)
        assert 0 < len(ids) <= 2048
        windows[r.sequence_id].append((r.offset, len(ids)))
        docs[str(r.doc_id)].append((r.doc_tokens, r.start, ids))
    rebuilt = []
    for i, parts in docs.items():
        parts.sort()
        while parts:
            total, start, ids = parts.pop(0)
            assert start == 0
            while len(ids) < total:
                k = next(k for k, p in enumerate(parts) if p[0] == total and p[1] == len(ids))
                ids += parts.pop(k)[2]
            rebuilt.append((ids, i))
    assert sorted(rebuilt) == want
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(len(ids) for ids, _ in want)
    assert len(windows) <= total / 2048 * 1.06 + 12


def test_any_tokenizer_whose_pieces_end_at_white_space(rows, tmp_path):
    """One that keeps capitals and does not split punctuation off."""
    from tokenizers import models, pre_tokenizers

    cased = Tokenizer(models.WordLevel({"[UNK]": 0, "A": 2, "a": 3, "a.": 4, "A.": 5, ".": 6}, unk_token="[UNK]"))
    cased.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    cased.save(f"{tmp_path}/cased.json")
    got = pack_documents(rows([(1, "A a a. A. . zz A")]), f"{tmp_path}/cased.json").first()
    assert struct.unpack("<8I", got.ids) == (2, 3, 4, 5, 6, 0, 2, 1)


def test_random_strings_agree_with_whole_texts(monkeypatch):
    exact, draw = Tokenizer.from_file(PATH), random.Random(3)
    alphabet = "aAbzİıß.,'sStT !?é\u0301\u0307ǅ中\x1c\x85\n\t 0½"
    texts = ["".join(draw.choices(alphabet, k=draw.randrange(30))) for _ in range(4000)]
    ids = packing.WordIds(PATH, 1)
    monkeypatch.setattr(packing.WordIds, "MOST", 500)  # words are forgotten on the way
    for at in range(0, len(texts), 250):
        found, ends = ids.documents(packing.pa.array(texts[at : at + 250]))
        parts = np.split(found, ends)[:-1]
        for text, part in zip(texts[at : at + 250], parts, strict=True):
            assert part.tolist() == [*exact.encode(text, add_special_tokens=False).ids, 1], text


def test_blocks_of_many_short_texts_are_bounded(rows):
    got = pack_documents(rows([(i, None) for i in range(3000)], partitions=1), PATH, block_tokens=2500).collect()
    assert {(r.start, r.doc_tokens, len(r.ids)) for r in got} == {(0, 1, 4)} and len({r.doc_id for r in got}) == 3000
    assert len({r.sequence_id for r in got}) == 30  # a piece counts 25 here, so a block has a hundred
    assert sorted((r.sequence_id, r.offset) for r in got) == [(s, o) for s in sorted({r.sequence_id for r in got}) for o in range(100)]


def test_no_rows(rows):
    assert pack_documents(rows([]), PATH).count() == 0
