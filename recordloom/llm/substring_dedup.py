"""Repeated passages, lines, paragraphs, sentences or clauses: hashes are grouped, the earliest occurrence stays.

Passages, of words alone and exact to the word, are found by windows of ``min_words`` words:

1. The least hash among the half-length word runs of a window is its anchor; neighbouring
   windows of one anchor are a stretch, some eleven windows at 40 words. Each document gives
   the digest of every stretch. Equal windows have equal anchors, so only stretches whose
   anchor more than one document holds go on.
2. A stretch that stands in an earlier document is repeated as a whole. Where an anchor has
   stretches that differ (at the ends of a passage, at an edit), the earliest document of
   each gives its single windows, and those are compared.
3. Each document that has any, or may repeat itself, is hashed again and loses the words that repeated windows cover.

The other kinds of unit:

1. Each text is cut into units; a unit's digest is that of its words in lower case. A
   document gives each digest once, what it repeats itself is found again in step 4.
2. Digests that more than one document holds: the least and the greatest document hash of
   each, which is summed before the shuffle, so a line in a third of all documents is cheap.
3. Of those digests alone, the earliest document, and the others as occurrences to remove.
4. Each document is cut again and loses the units on its list, as long as a run of them
   has enough words.

Digests have 64 bits: among 10^12 distinct units some 30,000 are mistaken for another, and
a mistake only tells where it completes a run of ``min_words``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import WordHashes, mixed
from .work import kept_by_worker, work_table

# Where a unit ends: what is matched up to "cut" still belongs to it.
_ENDS = {
    "line": re.compile(r"(?P<cut>)\n\s*"),
    "paragraph": re.compile(r"(?P<cut>)\n[^\S\n]*\n\s*"),
    "sentence": re.compile(r"(?P<cut>[.!?])\s+|\n\s*"),
    "clause": re.compile(r"(?P<cut>[.!?,;:])\s+|\n\s*"),
}
_REMOVED = "struct<text: string, removed: array<struct<start: long, end: long>>>"


def units(text: str, kind: str) -> tuple[list[int], list[int], list[int]]:
    """Starts of the units with words, their digests and their numbers of words, in reading order."""
    starts, digests, sizes = [], [], []
    start = 0
    ends = [(m.end("cut") if m["cut"] else m.start(), m.end()) for m in _ENDS[kind].finditer(text)]
    for end, after in [*ends, (len(text), len(text))]:
        words = text[start:end].lower().split()
        if words:
            starts.append(start)
            digests.append(xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "surrogatepass")))
            sizes.append(len(words))
        start = after
    return starts, digests, sizes


def cut_runs(text: str, kind: str, elsewhere: set[int], min_words: int) -> tuple[str, list[tuple[int, int]]]:
    """The text without its runs of repeated units, and their offsets in the original text.

    A unit is repeated if it is on the list ``elsewhere`` or stands earlier in the text. A
    run goes from its first unit up to where the next unit begins.
    """
    starts, digests, sizes = units(text, kind)
    seen: set[int] = set()
    spans, first, words = [], None, 0
    for k, digest in enumerate([*digests, None]):
        repeated = digest is not None and (digest in elsewhere or digest in seen)
        seen.add(digest)
        if repeated:
            first, words = (k, sizes[k]) if first is None else (first, words + sizes[k])
        elif first is not None:
            if words >= min_words:
                spans.append((starts[first], starts[k] if digest is not None else len(text)))
            first = None
    kept, last = [], 0
    for start, end in spans:
        kept.append(text[last:start])
        last = end
    return "".join([*kept, text[last:]]), spans


class _Hasher(WordHashes):
    """Hashes of words of any script, and of runs of words by the powers of an odd number modulo 2^64."""

    ODD = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        super().__init__()
        self.up = self.down = np.empty(0, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (
                np.cumprod(np.array([1] + [base] * (2 * n - 1), np.uint64), dtype=np.uint64)
                for base in (self.ODD, pow(self.ODD, -1, 2**64)))
        return self.up[:n], self.down[:n]

    def runs(self, words: list[str]) -> Callable[..., np.ndarray]:
        """A function of starts and ends, as arrays or slices, that gives a hash for each of these runs of words."""
        up, down = self.powers(len(words) + 1)
        hashes = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * down[:-1], dtype=np.uint64)])
        return lambda a, b, size: mixed((sums[b] - sums[a]) * up[a] + np.asarray(size).astype(np.uint64))


def windows_of(text: str | None, size: int, single: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words; anchors, digests and first windows of their stretches, and the number of windows.

    Without ``single`` the first are left out.
    """
    words = (text or "").lower().split()
    count = len(words) - size + 1
    if count < 1:
        none = np.empty(0, np.uint64)
        return none, none, none, np.zeros(1, np.int64)
    runs = kept_by_worker("passages", _Hasher).runs(words)
    short = (size + 1) // 2
    every = lambda n: runs(slice(0, len(words) - n + 1), slice(n, None), n)
    least, reach, wanted = every(short), 1, size - short + 1
    while reach < wanted:
        step = min(reach, wanted - reach)
        least, reach = np.minimum(least[:-step], least[step:]), reach + step
    firsts = np.concatenate([np.zeros(1, np.int64), np.flatnonzero(least[1:] != least[:-1]) + 1])
    ends = np.append(firsts[1:], count) + size - 1
    return every(size) if single else np.empty(0, np.uint64), least[firsts], runs(firsts, ends, ends - firsts), np.append(firsts, count)


def may_repeat(anchors: np.ndarray, firsts: np.ndarray, size: int) -> bool:
    """Whether a text can hold a window twice: an anchor in two stretches, or a stretch with more windows than one place of it is in."""
    return len(np.unique(anchors)) < len(anchors) or bool((np.diff(firsts) > size // 2 + 1).any())


def cut_passages(
    text: str, stretches: np.ndarray, windows: np.ndarray, size: int
) -> tuple[str, list[tuple[int, int]]]:
    """The text without the words of repeated windows, and the cut spans in characters of the original text.

    A window is repeated if it or its stretch is listed, or if it stands earlier in the text.
    A span goes from its first word up to where the next word begins.
    """
    every, anchors, digests, firsts = windows_of(text, size)
    if not len(every):
        return text, []
    repeated = np.repeat(np.isin(digests, stretches), np.diff(firsts)) | np.isin(every, windows)
    own = np.zeros(len(every), bool)
    if may_repeat(anchors, firsts, size):
        own[:] = True
        own[np.unique(every, return_index=True)[1]] = False
    at = np.flatnonzero(repeated | own)
    if not len(at):
        return text, []
    starts = np.array([m.start() for m in re.finditer(r"\S+", text)] + [len(text)])
    opens = at[np.append(True, at[1:] > at[:-1] + size)]
    closes = at[np.append(at[1:] > at[:-1] + size, True)] + size
    spans = [(int(a), int(b)) for a, b in zip(starts[opens], starts[closes], strict=True)]
    kept, last = [], 0
    for start, end in spans:
        kept.append(text[last:start])
        last = end
    return "".join([*kept, text[last:]]), spans


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _listed(known: pa.Scalar) -> np.ndarray:
    return np.array(known.as_py() or [], np.int64).view(np.uint64)


def _stretcher(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors, stretches, again = [], [], []
            for text in batch["text"]:
                _, anchor, digest, firsts = windows_of(text.as_py(), size, single=False)
                again.append(may_repeat(anchor, firsts, size))
                digest, once = np.unique(digest, return_index=True)
                anchors.append(anchor[once])
                stretches.append(digest)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], _lists(anchors), _lists(stretches), pa.array(again, pa.bool_())],
                names=["doc_id", "text_hash", "anchors", "stretches", "again"])

    return run


def _opener(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, known in zip(batch["text"], batch["open"], strict=True):
                every, _, digests, firsts = windows_of(text.as_py(), size)
                chosen = np.repeat(np.isin(digests, _listed(known)), np.diff(firsts))
                found.append(np.unique(every[chosen]))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], _lists(found)], names=["doc_id", "text_hash", "windows"])

    return run


def _passage_cutter(size: int):
    def cut(texts: pa.Array, stretches: pa.Array, windows: pa.Array) -> pa.Array:
        out = []
        for text, whole, single in zip(texts, stretches, windows, strict=True):
            text = text.as_py()
            listed = text is not None and whole.is_valid
            kept, spans = (text, []) if not listed else cut_passages(text, _listed(whole), _listed(single), size)
            out.append({"text": kept, "removed": [{"start": a, "end": b} for a, b in spans]})
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.array(out, pa.struct([("text", pa.string()), ("removed", span)]))

    return F.arrow_udf(cut, _REMOVED)


def _repeated_passages(slim: DataFrame, size: int) -> DataFrame:
    """``doc_id, text_hash, stretches, windows``: what stands in an earlier document, for those that have any."""
    key, rank = F.xxhash64("doc_id", "text_hash"), F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_hash")
    found = work_table(slim.mapInArrow(
        _stretcher(size), "doc_id long, text_hash long, anchors array<long>, stretches array<long>, again boolean"))
    held = found.select("doc_id", "text_hash", F.explode(F.arrays_zip("anchors", "stretches")).alias("of")).select(
        "doc_id", "text_hash", F.col("of.anchors").alias("anchor"), F.col("of.stretches").alias("stretch"))
    shared = held.groupBy("anchor").agg(
        F.min(key).alias("low"), F.max(key).alias("high"), (F.min("stretch") < F.max("stretch")).alias("several")).where("low <> high")
    often = work_table(held.join(shared.select("anchor", "several"), "anchor").drop("anchor"))
    earliest = often.groupBy("stretch").agg(F.min(rank).alias("first"))
    is_first = rank.eqNullSafe(F.col("first"))
    marked = often.join(earliest, "stretch").withColumn("is_first", is_first).where("not is_first or several")
    # Those that may repeat themselves are listed too; texts on no list are not hashed again.
    alone = found.where("again").select("doc_id", "text_hash", F.lit(None).cast("long").alias("stretch"), F.lit(False).alias("is_first"))
    marked = marked.select(alone.columns).unionByName(alone)
    lists = work_table(marked.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.when(~F.col("is_first"), F.col("stretch"))).alias("stretches"),
        F.collect_set(F.when(F.col("is_first"), F.col("stretch"))).alias("open")))

    wanted = lists.where(F.size("open") > 0).select(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"), "open")
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash"))
    opened = work_table(slim.join(wanted, same).select("doc_id", "text_hash", "text", "open").mapInArrow(
        _opener(size), "doc_id long, text_hash long, windows array<long>"))
    single = opened.select("doc_id", "text_hash", F.explode("windows").alias("window"))
    twice = single.groupBy("window").agg(
        F.min(rank).alias("first"), F.min(key).alias("low"), F.max(key).alias("high")).where("low <> high")
    later = single.join(twice.select("window", "first"), "window").where(~is_first)
    repeated = later.groupBy(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash")).agg(F.collect_set("window").alias("windows"))
    return lists.join(repeated, same, "left").select("doc_id", "text_hash", "stretches", "windows")


def _digester(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for text in batch["text"]:
                _, digests, _ = units(text.as_py() or "", kind)
                lists.append(np.unique(np.array(digests, np.uint64)).view(np.int64))
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            values = pa.array(np.concatenate(lists) if lists else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], pa.ListArray.from_arrays(pa.array(ends), values)],
                names=["doc_id", "text_hash", "digests"])

    return run


def _cutter(kind: str, min_words: int):
    def cut(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out = []
        for text, known in zip(texts, lists, strict=True):
            text = text.as_py()
            if text is None:
                out.append({"text": None, "removed": []})
                continue
            elsewhere = {d % 2**64 for d in known.as_py() or ()}
            kept, spans = cut_runs(text, kind, elsewhere, min_words)
            out.append({"text": kept, "removed": [{"start": a, "end": b} for a, b in spans]})
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.array(out, pa.struct([("text", pa.string()), ("removed", span)]))

    return F.arrow_udf(cut, _REMOVED)


def _repeated_units(slim: DataFrame, unit: str, min_words: int) -> DataFrame:
    """``doc_id, text_hash, digests``: units that stand in an earlier document, for those that have any."""
    found = work_table(slim.mapInArrow(
        _digester(unit), "doc_id long, text_hash long, digests array<long>"))
    held = found.select("doc_id", "text_hash", F.explode("digests").alias("digest"))
    key = F.xxhash64("doc_id", "text_hash")
    shared = held.groupBy("digest").agg(F.min(key).alias("low"), F.max(key).alias("high")).where("low <> high")
    often = work_table(held.join(shared.select("digest"), "digest"))
    rank = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_hash")
    earliest = often.groupBy("digest").agg(F.min(rank).alias("first"))
    later = often.join(earliest, "digest").where(~rank.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set("digest").alias("digests"))


def remove_repeats(
    docs: DataFrame, unit: str = "clause", min_words: int = 40, id_col: str = "doc_id", text_col: str = "text",
    removed_col: str = "removed",
) -> DataFrame:
    """``docs`` with repeated runs of units cut from the texts, and the cut spans as ``removed_col``.

    ``unit`` is ``passage`` (any ``min_words`` words on end that stand earlier, wherever they
    begin and whatever punctuation they have; exact to the word), ``line``, ``paragraph``
    (lines up to a blank one), ``sentence`` (lines, also cut after ``.``, ``!`` or ``?`` before white space) or ``clause`` (after ``,``, ``;`` and
    ``:`` as well). A passage that was put into the middle of a line begins in the unit that
    it was put into, so small units lose less of it. Units are compared by their words
    in lower case. The earliest occurrence stays: that of the smallest id (nulls last), of
    equal ids that of the smallest text hash, within a text the first. Others are removed
    where a run of adjacent ones has ``min_words`` words or more.

    One row for each row of ``docs``, all columns as they are but for the text; ``removed_col``
    holds ``(start, end)`` in characters of the original text and replaces a column of that
    name. Null stays null, an empty text stays empty, a text that only repeats becomes empty.
    Rows equal in id and text are one document and all keep what it keeps.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("text_hash"))
    if unit == "passage":
        lists = _repeated_passages(slim, min_words)
        cutter = _passage_cutter(min_words)("text", "stretches", "windows")
    else:
        lists, cutter = _repeated_units(slim, unit, min_words), _cutter(unit, min_words)("text", "digests")

    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"),
                       F.col(id_col).cast("long").alias("own_id"), F.xxhash64(text_col).alias("own_hash"))
    joined = rows.join(lists, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash")), "left")
    cut = joined.withColumn("cut", cutter)
    kept = [F.col("cut.text").alias(c) if c == text_col else F.col("row")[c].alias(c)
            for c in docs.columns if c != removed_col]
    return cut.select(*kept, F.col("cut.removed").alias(removed_col))
