"""Vector codes: product quantization with codebooks fitted by Ball k-means.

Vectors become integers and are cut into equal parts, each with a codebook of its own. Entries
start as the parts of the smallest ids and move for a fixed number of rounds. All arithmetic
is in integers, so results do not depend on how rows are dealt out.

The parts of a batch that belong to an entry form a ball around it. Another entry can only be nearer
to one of them if it is within twice the ball's radius, so an entry has few neighbours. Parts nearer to
their entry than half way to its next neighbour are the stable core and are left alone. The rest lies in rings: a part
between half the distance to the k-th neighbour and half that to the one after compares k neighbours only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .work import work_table

LARGEST = 1 << 28  # of a component as an integer, in either direction: distances then fit 64 bits
MOST_LABELS = 10_000  # sums by label that are sent to all executors; more are joined by a shuffle
_KEPT = ("vec_id", "label", "vector", "codes")


def squared(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    apart = points - entry
    return np.einsum("ij,ij->i", apart, apart)


def ball_assign(points: np.ndarray, entries: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry of each point, ties to the lower index, from any former ``codes``.

    Returns codes, squared distances, and how many distances to other entries were computed.
    """
    codes = codes.copy()
    own = squared(points, entries[codes])
    between = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(-1)
    before = codes.copy()
    work = 0
    for j in range(len(entries)):
        ball = np.flatnonzero(before == j)
        if not len(ball):
            continue
        # Twice the radius, squared. A neighbour exactly twice as far may tie, so it counts.
        reach = 4 * own[ball]
        others = np.flatnonzero(between[j] <= reach.max())
        others = others[others != j]
        others = others[np.argsort(between[j][others], kind="stable")]
        ring = np.searchsorted(between[j][others], reach, "right")  # neighbours to compare; 0 is the stable core
        for k, other in enumerate(others):
            near = ball[ring > k]
            apart = squared(points[near], entries[other])
            work += len(near)
            closer = (apart < own[near]) | ((apart == own[near]) & (other < codes[near]))
            own[near[closer]], codes[near[closer]] = apart[closer], other
    return codes, own, work


def _vectors(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).astype(np.int64).reshape(len(column), -1)


def _integers(components: int):
    """The function that turns vectors into whole numbers and drops those that have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.asarray(batch["embedding"].flatten().to_numpy(zero_copy_only=False), float)
            # Rows come with the wanted number of components and no null among them.
            with np.errstate(all="ignore"):
                whole = np.floor(flat.reshape(batch.num_rows, components) * 4096.0)
            fits = (np.abs(whole) < LARGEST).all(axis=1)  # false for what is not finite
            vectors = whole[fits].astype(np.int32)
            kept = batch.filter(pa.array(fits))
            yield pa.RecordBatch.from_arrays(
                [kept["vec_id"], kept["label"], pa.array([v.tobytes() for v in vectors], pa.binary()),
                 pa.array([bytes(0)] * len(vectors), pa.binary())], names=list(_KEPT))

    return run


def _assigner(codebooks: np.ndarray):
    """The function that gives each vector its codes, from those of the round before."""
    parts = len(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch["vector"]).reshape(batch.num_rows, parts, -1)
            held = b"".join(c or bytes(parts) for c in batch["codes"].to_pylist())
            codes = np.frombuffer(held, np.uint8).reshape(batch.num_rows, parts).astype(np.int64)
            error = np.zeros(batch.num_rows, np.int64)
            for p in range(parts):
                codes[:, p], apart, _ = ball_assign(vectors[:, p], codebooks[p], codes[:, p])
                error += apart
            packed = pa.array([c.tobytes() for c in codes.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in _KEPT[:3]), packed, pa.array(error)], names=[*_KEPT, "error"])

    return run


def _summer(parts: int, entries: int):
    """The function that sums, over a task's rows, the parts of each entry: one row per part and entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = count = None
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch["vector"]).reshape(batch.num_rows, parts, -1)
            codes = np.frombuffer(b"".join(batch["codes"].to_pylist()), np.uint8).reshape(batch.num_rows, parts)
            if total is None:
                total, count = np.zeros((parts, entries, vectors.shape[2]), np.int64), np.zeros((parts, entries), np.int64)
            for p in range(parts):
                np.add.at(total[p], codes[:, p], vectors[:, p])
                count[p] += np.bincount(codes[:, p], minlength=entries)
        if total is not None:
            at = [(p, e) for p in range(parts) for e in range(entries) if count[p, e]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in at], pa.int32()), pa.array([e for _, e in at], pa.int32()), pa.array([count[i] for i in at], pa.int64()),
                 pa.array([total[i].tolist() for i in at], pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])

    return run


def _moved(codebooks: np.ndarray, coded: DataFrame) -> np.ndarray:
    """Every entry at the floored mean of its parts; an unused one stays."""
    parts, entries, width = codebooks.shape
    sums = coded.select(*_KEPT).mapInArrow(_summer(parts, entries), "part int, entry int, n long, total array<long>")
    # Decimals, as sums over very many rows may pass a long. A row per part and entry comes back.
    summed = sums.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *(F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(width)))
    moved = codebooks.copy()
    for row in summed.collect():
        moved[row.part, row.entry] = [int(row[f"t{i}"]) // row.n for i in range(width)]
    return moved


def fit_and_encode(embeddings: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of every kept vector, and the codebooks by part, entry and place.

    Left out are rows whose vector is null or holds a null or a component that is not finite. So are those
    that have no place in a codebook: vectors empty, of a length that ``parts`` does not divide, of another
    length than the first kept vector by id (nulls last), or with a component of 2^16 or more, whose distances do not fit a long.
    Repeated rows and ids each get a code; with fewer rows than ``entries`` the codebooks are as short, and
    without rows there are none. Other columns are not kept. ``entries`` is at most 256.

    A round reads the codes of the round before, which are persisted and follow from the stored vectors
    again if an executor is lost; only sums by part and entry come to the driver.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte: entries must be 1 to 256")
    slim = embeddings.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("embedding"))
    usable = slim.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & (F.size("embedding") % parts == 0)
                        & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= F.lit(float(LARGEST // 4096)))))
    id_type, label_type = slim.schema["vec_id"].dataType, slim.schema["label"].dataType
    first = usable.select(F.size("embedding").alias("n"), "vec_id", "embedding").orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(1).collect()
    result = T.StructType([T.StructField("vec_id", id_type), T.StructField("label", label_type), T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])
    if not first:
        return embeddings.sparkSession.createDataFrame([], result), np.zeros((parts, 0, 0), np.int64)
    components = first[0].n
    kinds = f"vec_id {id_type.simpleString()}, label {label_type.simpleString()}, vector binary, codes binary"
    stored = work_table(usable.where(F.size("embedding") == components).mapInArrow(_integers(components), kinds))
    seeds = stored.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").collect()
    start = np.array([np.frombuffer(r.vector, np.int32) for r in seeds], np.int64)
    codebooks = start.reshape(len(seeds), parts, -1).swapaxes(0, 1).copy()
    coded = stored
    for _ in range(rounds):
        now = coded.select(*_KEPT).mapInArrow(_assigner(codebooks), f"{kinds}, error long").persist(StorageLevel.MEMORY_AND_DISK)
        codebooks = _moved(codebooks, now)
        if coded is not stored:
            coded.unpersist()
        coded = now
    final = work_table(coded.select(*_KEPT).mapInArrow(_assigner(codebooks), f"{kinds}, error long").select(
        "vec_id", "label", F.lower(F.hex("codes")).alias("code"), "error"))
    coded.unpersist()
    return final, codebooks


def decode(code: str, codebooks: np.ndarray) -> np.ndarray:
    """The vector, in its original scale, that a code stands for."""
    return np.concatenate([codebooks[p, e] for p, e in enumerate(bytes.fromhex(code))]) / 4096.0


def codebooks_digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place, as decimals joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: the error summed over the rows of its label, nulls together."""
    sums = work_table(coded.groupBy(F.col("label").alias("that")).agg(F.sum("error").alias("label_error")))
    few = sums.limit(MOST_LABELS + 1).count() <= MOST_LABELS
    return coded.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("that"))).drop("that")
