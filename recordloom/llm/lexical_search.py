"""Ranked lexical search over hashed max-sketches.

The index holds, for each document, its distinct terms with their occurrences and a sketch of
fixed width: every term belongs to a coordinate by its hash, and a coordinate holds the largest
number of occurrences of its terms. A term's impact grows with its occurrences and otherwise
depends on the document alone, so the impact of a coordinate's maximum is the maximum of its
impacts. The sketch needs no statistics of the corpus: it is made in one pass and serves every query.

For a block of queries, one product of a chunk's impacts with the queries' weights bounds every score
from above. A task then goes through the documents of its chunk by falling bound, scores them
exactly from the stored terms, and stops where the bound is below the lowest of the best ``k`` so far.
Each task passes on ``k`` documents a query at most, which are merged in two steps by partial top-k.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .work import kept_by_worker, work_folder, work_table

WIDTH = 1024  # coordinates of a sketch
QUERIES_TOGETHER = 256  # of a block, whose terms and weights every task holds
TERMS_TOGETHER = 200_000
_CHUNK = 1024  # documents bounded by one product
_FIRST = 64  # candidates scored before the first look at the threshold; doubled from look to look
_MOST = 255  # occurrences that a sketch tells apart; more have the limit of all impacts as bound
_LIMIT = 1_000_000
_BATCH_BYTES = 8 << 20
_SALTS = 32

# Letters and digits of ASCII and all bytes of other characters make terms; A-Z become a-z.
_FOLDED = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, with repeats; null has none."""
    return text.translate(_FOLDED).split() if text else []


class Coordinates(dict):
    """Coordinate of each term seen; frequent terms are hashed once per worker."""

    MOST = 200_000  # memory only: beyond it the terms are forgotten and hashed anew
    LONGEST = 64

    def __missing__(self, term: bytes) -> int:
        value = zlib.crc32(term) % WIDTH
        if len(term) <= self.LONGEST:
            if len(self) >= self.MOST:
                self.clear()
            self[term] = value
        return value


def sketch_of(terms: list[bytes], occurrences: np.ndarray) -> np.ndarray:
    """Per coordinate the largest number of occurrences of its terms, up to 255; 0 where it has none."""
    sketch = np.zeros(WIDTH, np.uint8)
    where = np.fromiter(map(kept_by_worker("coordinates", Coordinates).__getitem__, terms), np.int64, len(terms))
    np.maximum.at(sketch, where, np.minimum(occurrences, _MOST).astype(np.uint8))
    return sketch


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch["text"].cast(pa.binary())
        start, size, rows = 0, 0, []

        def part(end: int) -> pa.RecordBatch:
            n, terms, counts, sketches = zip(*rows)  # noqa: B023
            return pa.RecordBatch.from_arrays(
                [batch["doc_id"].slice(start, end - start), pa.array(n, pa.int64()),  # noqa: B023
                 *(pa.array(values, pa.binary()) for values in (terms, counts, sketches))],
                names=["doc_id", "n_terms", "terms", "occurrences", "sketch"])

        for at in range(batch.num_rows):
            found = terms_of(texts[at].as_py())
            counted = Counter(found)
            terms, occurrences = list(counted), np.fromiter(counted.values(), np.uint32, len(counted))
            rows.append((len(found), b" ".join(terms), occurrences.tobytes(), sketch_of(terms, occurrences).tobytes()))
            size += WIDTH + len(rows[-1][1]) + len(rows[-1][2])
            if size >= _BATCH_BYTES:
                yield part(at + 1)
                start, size, rows = at + 1, 0, []
        if rows:
            yield part(batch.num_rows)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_terms, terms, occurrences, sketch`` of every row, stored in the shared folder.

    Null and empty texts are rows without terms. Repeated rows and ids are documents of their own.
    Other columns are not kept, so their names can't clash. A text of any length is one row.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()
    return work_table(slim.mapInArrow(_fold, f"doc_id {id_type}, n_terms long, terms binary, occurrences binary, sketch binary"))


def _query_blocks(queries: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """Blocks of ``(query_id, distinct terms)``, of bounded size each; queries without terms are left out."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [b" ".join(sorted(set(terms_of(t.as_py())))) for t in batch["text"].cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch["query_id"], pa.array(terms, pa.binary())], names=["query_id", "terms"])

    slim = queries.select(F.col(id_col).alias("query_id"), F.col(text_col).cast("string").alias("text"))
    id_type = slim.schema["query_id"].dataType.simpleString()
    held = work_table(slim.mapInArrow(split, f"query_id {id_type}, terms binary").distinct())
    block: list[tuple] = []
    size = 0
    for row in held.where("length(terms) > 0").toLocalIterator():
        terms = bytes(row.terms).split(b" ")
        if block and (len(block) >= QUERIES_TOGETHER or size + len(terms) > TERMS_TOGETHER):
            yield block
            block, size = [], 0
        block.append((row.query_id, terms))
        size += len(terms)
    if block:
        yield block


def _document_counts(index: DataFrame, known: dict[bytes, int]) -> np.ndarray:
    """For each known term, how many documents hold it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(known), np.int64)
        for batch in batches:
            for terms in batch["terms"]:
                at = [known[t] for t in terms.as_py().split() if t in known]
                held[at] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(held[at], pa.int64())], names=["term", "n"])

    found = np.zeros(len(known), np.int64)
    for row in index.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        found[row.term] = row.n
    return found


def impacts(occurrences: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What an occurrence count contributes in a document of this relative length, before the term's weight."""
    return (1_000_000_000 * occurrences) // (1000 * occurrences + 20 * lengths)


def _searcher(block: list[tuple], known: dict[bytes, int], weights: np.ndarray, documents: int, total_terms: int, k: int, id_type: pa.DataType):
    """The function that finds, in the rows of a task, the best ``k`` for each query of the block."""
    own = [np.array([known[t] for t in terms], np.int64) for _, terms in block]
    by_coordinate = np.zeros((WIDTH, len(block)))
    for q, at in enumerate(own):
        coordinates = [zlib.crc32(t) % WIDTH for t in block[q][1]]
        np.add.at(by_coordinate[:, q], coordinates, weights[at].astype(float))

    def bounds(sketches: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        # All values are whole numbers far below 2^53, so the product is exact.
        row, column = np.nonzero(sketches)
        most = sketches[row, column].astype(np.int64)
        highest = np.zeros(sketches.shape)
        highest[row, column] = np.where(most == _MOST, _LIMIT, impacts(most, lengths[row]))
        return highest @ by_coordinate

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in block]  # (-score, id is null, id), rising
        weight_of = np.zeros(len(known), np.int64)
        for chunk in chain.from_iterable(
                (batch.slice(at, _CHUNK) for at in range(0, batch.num_rows, _CHUNK)) for batch in batches):
            ids = chunk["doc_id"].to_pylist()
            n = chunk["n_terms"].to_numpy()
            lengths = 50 + (50 * n * documents) // total_terms
            sketches = np.frombuffer(b"".join(chunk["sketch"].to_pylist()), np.uint8).reshape(len(ids), WIDTH)
            above = bounds(sketches, lengths)
            parsed: dict[int, tuple[np.ndarray, np.ndarray]] = {}

            def held(row: int) -> tuple[np.ndarray, np.ndarray]:
                """The known terms of a document, and their impacts."""
                if row not in parsed:  # noqa: B023
                    at = [(i, known[t]) for i, t in enumerate(chunk["terms"][row].as_py().split()) if t in known]  # noqa: B023
                    place, term = np.array(at, np.int64).reshape(-1, 2).T
                    counts = np.frombuffer(chunk["occurrences"][row].as_py(), np.uint32)[place].astype(np.int64)  # noqa: B023
                    parsed[row] = term, impacts(counts, lengths[row])  # noqa: B023
                return parsed[row]  # noqa: B023

            for q, top in enumerate(best):
                threshold = -top[-1][0] if len(top) == k else 1
                candidates = np.flatnonzero(above[:, q] >= threshold)
                if not len(candidates):
                    continue
                candidates = candidates[np.argsort(-above[candidates, q], kind="stable")]
                weight_of[own[q]] = weights[own[q]]
                done, step = 0, _FIRST
                while done < len(candidates) and above[candidates[done], q] >= threshold:
                    rows = candidates[done : done + step].tolist()
                    terms, values = zip(*map(held, rows))
                    owner = np.repeat(np.arange(len(rows)), [len(t) for t in terms])
                    scores = np.bincount(owner, weight_of[np.concatenate(terms)] * np.concatenate(values), len(rows)).astype(np.int64)
                    top += [(-int(s), ids[r] is None, ids[r]) for r, s in zip(rows, scores) if s >= threshold]
                    top.sort(key=lambda t: t if not t[1] else t[:2])
                    del top[k:]
                    threshold = -top[-1][0] if len(top) == k else 1
                    done += step
                    step *= 2
                weight_of[own[q]] = 0
        rows = [(q, t[2], -t[0]) for q, top in enumerate(best) for t in top]
        query, doc, score = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int64()), pa.array(doc, id_type), pa.array(score, pa.int64())], names=["query", "doc_id", "score"])

    return search


def search(index: DataFrame, queries: DataFrame, k: int = 50, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``query_id, rank, doc_id, score``: the ``k`` best documents of each query with a score above 0.

    A term's weight is ``floor(1000 * ln((2N + 2) / (2 df + 1)))``, its impact the share that its
    occurrences have against the document's relative length; all else is integers, so scores are exact.
    Equal scores stand by rising id, null ids last. Queries without terms, a null text among them, have no
    rows, nor has an empty index. Rows of ``queries`` equal in id and terms are one query; rows of one id with other
    terms are ranked apart. Queries go through the driver in blocks of bounded size, never as a whole.
    """
    spark = index.sparkSession
    id_type, query_type = index.schema["doc_id"].dataType, queries.schema[id_col].dataType
    found = T.StructType([T.StructField("query_id", query_type), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", id_type),
                          T.StructField("score", T.LongType())])
    documents, total_terms = index.where("n_terms > 0").agg(F.count("*"), F.sum("n_terms")).first()
    if not documents:
        return spark.createDataFrame([], found)
    out = work_folder(spark)
    spark.createDataFrame([], found).write.parquet(f"{out}/none")
    paths = [f"{out}/none"]
    for number, block in enumerate(_query_blocks(queries, id_col, text_col)):
        known = {t: i for i, t in enumerate(sorted({t for _, terms in block for t in terms}))}
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in _document_counts(index, known)], np.int64)
        ranked = index.where("n_terms > 0").select("doc_id", "n_terms", "terms", "occurrences", "sketch").mapInArrow(
            _searcher(block, known, weights, documents, int(total_terms), k, to_arrow_type(id_type)), f"query long, doc_id {id_type.simpleString()}, score long")
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        # First within a salt, then over all: no task sorts more than k rows of a salt.
        salted = ranked.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(_SALTS)))
        partly = salted.withColumn("rank", F.row_number().over(Window.partitionBy("query", "salt").orderBy(*order))).where(F.col("rank") <= k)
        best = partly.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)
        names = spark.createDataFrame([(q, query_id) for q, (query_id, _) in enumerate(block)],
                                      T.StructType([T.StructField("query", T.LongType()), T.StructField("query_id", query_type)]))
        best.join(F.broadcast(names), "query").select(*found.names).write.parquet(f"{out}/{number}")  # a block of names is bounded
        paths.append(f"{out}/{number}")
    return spark.read.schema(found).parquet(*paths)
