"""Packing documents into fixed windows: best fit decreasing, block by block.

A task reads its documents one after the other, turns them into token ids and cuts whole
windows off those that are too long. What is left over, at most one short piece of each
document, is held until ``block_tokens`` ids have come together; the block is then packed,
longest piece first, each into the open window that it fills best. Which one that is a
segment tree over the remaining capacities tells.

Blocks are independent, so nothing is shuffled, nothing is gathered and a lost task is run
again alone. A block of a few million ids leaves well under a thousandth of the space empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import kept_by_worker

WINDOW = 2048
END_ID = 1
BLOCK_TOKENS = 8_000_000  # 32 MB of ids held by a task
_PIECE_COST = 24  # what a piece takes beside its ids, in ids
_TEXT_BYTES = 4 << 20  # of documents whose words are looked up together

_PIECES = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long"


class OpenWindows:
    """Open windows by remaining capacity; a segment tree finds the tightest that is large enough."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()  # for capacities 0 to window
        self.count = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, change: int) -> None:
        k = capacity + self.leaves
        while k:
            self.count[k] += change
            k >>= 1

    def put(self, capacity: int, window_id: int) -> None:
        if capacity:
            self.at[capacity].append(window_id)
            self._add(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return ``(capacity, window_id)`` with the least capacity of at least ``need``."""
        k, count = need + self.leaves, self.count
        if not count[k]:
            # Up to the first right-hand neighbour that holds anything, then down its left edge.
            while k > 1 and (k & 1 or not count[k + 1]):
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.leaves:
                k = 2 * k if count[2 * k] else 2 * k + 1
        capacity = k - self.leaves
        self._add(capacity, -1)
        return capacity, self.at[capacity].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int], int]:
    """For pieces of 1 to ``window`` ids: the window of each, its offset there, and the number of windows."""
    places, offsets, used = [0] * len(lengths), [0] * len(lengths), 0
    free = OpenWindows(window)
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        found = free.take(lengths[k])
        if found is None:
            found = window, used
            used += 1
        capacity, places[k] = found
        offsets[k] = window - capacity
        free.put(capacity - lengths[k], places[k])
    return places, offsets, used


class WordIds:
    """Ids of texts, put together from those of their pieces between ASCII white space.

    The tokenizer drops white space and its pieces never reach across it, so a text's ids are
    those of its words one after the other. Words are numbered by Arrow, and only those not
    met before go to the tokenizer, all of some documents in one call. What is known of them are
    flat arrays, some 30 bytes a word.
    """

    MOST = 1_000_000  # memory only: beyond so many words all are forgotten and met anew

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.ids = np.empty(0, np.uint32)
        self.ends = np.zeros(1, np.int64)  # where the ids of each word begin, and the last end

    def _learn(self, words: pa.Array) -> None:
        """Adds words, all of them new."""
        found = self.tokenizer.encode(words.to_pylist(), is_pretokenized=True, add_special_tokens=False)
        ends = np.searchsorted(np.array(found.word_ids, np.int64), np.arange(1, len(words) + 1))
        self.words = pa.concat_arrays([self.words, words])
        self.ids = np.concatenate([self.ids, np.array(found.ids, np.uint32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends])

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """Where each of these distinct words stands among the known ones."""
        at = pc.index_in(words, value_set=self.words)
        if at.null_count:
            new = words.filter(at.is_null())
            if len(self.words) + len(new) > self.MOST and len(self.words):
                self._forget()
                return self._numbers(words)
            at = at.fill_null(-1).to_numpy().copy()
            at[at < 0] = len(self.words) + np.arange(len(new))
            self._learn(new)
            return at
        return at.to_numpy()

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of whole texts, each with the end id, one after the other, and where each text ends."""
        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        words = lists.flatten().dictionary_encode()
        number = self._numbers(words.dictionary)[words.indices.to_numpy()]
        size = self.ends[number + 1] - self.ends[number]
        upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
        ids = self.ids[np.repeat(self.ends[number] - upto[:-1], size) + np.arange(upto[-1])]
        of_text = upto[lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()]
        return np.insert(ids, of_text, self.end_id), of_text + np.arange(1, len(texts) + 1)


def word_ids(path: str, end_id: int) -> WordIds:
    """The tokenizer of this worker, loaded once."""
    return kept_by_worker(f"ids {path} {end_id}", lambda: WordIds(path, end_id))


class _Block:
    """Pieces that wait to be packed together."""

    def __init__(self) -> None:
        self.docs: list[pa.Array] = []
        self.columns: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # start, length, doc_tokens
        self.ids: list[np.ndarray] = []
        self.cost = 0

    def packed(self, window: int, first: int) -> tuple[pa.RecordBatch, int]:
        """Rows of the block, the pieces' order kept, and how many windows they take; these are numbered from ``first`` on."""
        start, length, total = (np.concatenate(c) for c in zip(*self.columns, strict=True))
        short = np.flatnonzero(length < window)
        places, offsets, used = best_fit_decreasing(length[short].tolist(), window)
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        sequence[short], offset[short] = places, offsets
        whole = np.flatnonzero(length == window)
        sequence[whole] = used + np.arange(len(whole))
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(length)]).astype(np.int32) * 4
        ids = np.concatenate(self.ids).astype("<u4")
        pieces = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
        batch = pa.RecordBatch.from_arrays(
            [pa.concat_arrays(self.docs), pa.array(start), pieces, pa.array(total), pa.array(sequence + first), pa.array(offset)],
            names=["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"])
        return batch, used + len(whole)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch with some megabytes of text each."""
    sizes = np.cumsum(pc.binary_length(batch["text"]).fill_null(0).to_numpy().astype(np.int64) + 1)
    cuts = np.flatnonzero(np.diff(sizes // _TEXT_BYTES)) + 1
    for low, high in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield batch.slice(low, high - low)


def _packer(path: str, window: int, end_id: int, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(path, end_id)
        first = TaskContext.get().partitionId() << 36
        block = _Block()
        for rows in (part for batch in batches if batch.num_rows for part in _slices(batch)):
            found, ends = ids.documents(rows["text"])
            begins = np.concatenate([np.zeros(1, np.int64), ends[:-1]])
            totals = ends - begins
            pieces = -(-totals // window)
            doc = np.repeat(np.arange(len(totals)), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
            length = np.minimum(window, totals[doc] - start)
            # Blocks end where the rows before them have cost enough, so memory is bounded for many short texts too.
            cost = block.cost + np.cumsum(length + _PIECE_COST)
            cuts = np.flatnonzero(np.diff(cost // block_tokens, prepend=block.cost // block_tokens)) + 1
            for k, (low, high) in enumerate(zip([0, *cuts], [*cuts, len(doc)], strict=True)):
                if high > low:
                    block.docs.append(rows["doc_id"].take(pa.array(doc[low:high])))
                    block.columns.append((start[low:high], length[low:high], totals[doc[low:high]]))
                    at = begins[doc[low]] + start[low]
                    block.ids.append(found[at : at + int(length[low:high].sum())])
                    block.cost += int((length[low:high] + _PIECE_COST).sum())
                if k < len(cuts):
                    batch, windows = block.packed(window, first)
                    yield batch
                    first += windows
                    block = _Block()
        if block.columns:
            yield block.packed(window, first)[0]

    return run


def pack_documents(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, start, ids, doc_tokens, sequence_id, offset``: a row for each piece of a document.

    ``tokenizer`` is the path of a file for the ``tokenizers`` library whose pieces end at
    white space, on every executor; words go to it as they are. A block ends at ``block_tokens`` ids, where each piece counts 24 more. A document's ids are followed by ``end_id``; documents
    longer than ``window`` are cut every ``window`` ids. ``ids`` are little-endian 32-bit
    numbers; ``start`` counts the document's ids before them, ``offset`` those before them
    in the window ``sequence_id``. Windows have no gaps but at their end.

    Null and empty texts, or such of white space, are one piece, the end id. Repeated rows
    and ids are packed each on their own, a null id stays null, other columns are not read.
    A document of any length is packed whole and held by one task; no rows give no rows.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(_packer(tokenizer, window, end_id, block_tokens), _PIECES)
