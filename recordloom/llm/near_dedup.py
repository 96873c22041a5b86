"""Near-duplicate documents: candidates from an LSH forest, links confirmed on full shingle sets.

Every document has a signature of MinHash values, cut into ``TREES`` keys of ``DEPTH`` values. Each
tree is the sorted order of its keys: all trees are sorted at once by ranges of tree, key and
node, so a run of equal keys may lie in several ranges and none is a hot one. In sorted order
documents with a long common prefix stand together; a region is a run that shares the first
``BASE`` values. Two documents of similarity 0.8 share no region in any of 32 trees with a
probability of about 3 in a million.

Candidates are found in two rounds, and no region is cut short:

1. each row of a tree against a row before it that has the longest common prefix with it, if
   that is ``BASE`` values or more. The depth so adapts to the region: in a dense one the
   prefix is the whole key, in a sparse one it ends sooner. Of several rows with that prefix
   the first of the run of equal keys next to it is taken. That is one pair a row however
   large a region is, and ties together almost all that belongs together. The last row of a
   range is handed on to the next;
2. in regions that still hold several components, every member outside the region's
   largest component against all members of other components, unless sizes or sketches
   rule out the needed similarity. So a region of near copies costs next to nothing.

Of the two sketches, one has a bit of each MinHash value. The other has a bit for each rest
of a shingle modulo 1024, set if an odd number of shingles have that rest: two of them
never differ in more bits than the sets in shingles, so it rules out no link.

Documents with equal sets are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .words import mixed, shingle_set
from .work import work_table

BASE = 5  # values that a region shares
DEPTH = 7  # values of a key
TREES = 32
_DIGITS = 16  # bits of each value in a key: four values in its high number, the others in its low one
_BITS = TREES * DEPTH  # of the sketch with a bit of each value
_RESTS = 1024  # bits of the sketch of odd rests
_BLOCK = 512  # shingles hashed at a time, to stay in the processor's cache
# Standard deviations by which agreeing bits may fall short of what a linked pair is expected to have.
_SLACK = 4.5

_MEMBERS = "node long, region long, neighbour long, part int, edge int"
_FEATURES = "doc_id long, text_hash long, n_shingles long, digest binary, high array<long>, low array<long>, bits array<long>, odd array<long>"


def _factors(seed: int) -> np.ndarray:
    draw = np.random.default_rng(seed)
    return draw.integers(1, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over the set."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), _BLOCK):
        block = shingles[k : k + _BLOCK]
        np.minimum(least, (factors[:, None] * block[None, :]).min(axis=1), out=least)
    return least


def _keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """High and low numbers of the key of every tree, and a bit of each value."""
    values = mixed(values)
    digits = values.reshape(TREES, DEPTH) >> np.uint64(64 - _DIGITS)
    numbers = []
    for part in (digits[:, :4], digits[:, 4:]):
        places = np.uint64(64 - _DIGITS) - np.arange(part.shape[1], dtype=np.uint64) * np.uint64(_DIGITS)
        numbers.append(np.bitwise_or.reduce(part << places, axis=1).view(np.int64))
    return (*numbers, _packed(values & np.uint64(1)))


def _packed(bits: np.ndarray) -> np.ndarray:
    """Bits as 64-bit numbers, filled up with zeros."""
    bytes_ = np.packbits(bits.astype(np.uint8))
    return np.pad(bytes_, (0, -len(bytes_) % 8)).view(np.int64)


def odd_rests(shingles: np.ndarray) -> np.ndarray:
    rests = (shingles % np.uint64(_RESTS)).astype(np.int64)
    return _packed(np.bincount(rests, minlength=_RESTS) & 1)


def _featurizer(width: int, seed: int):
    factors = _factors(seed)
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                        *((n, pa.list_(pa.int64())) for n in ("high", "low", "bits", "odd"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for *ids, text in zip(*(batch[n].to_pylist() for n in ("doc_id", "text_hash")), batch["text"], strict=True):
                found = shingle_set(text.as_py(), width)
                if not len(found):
                    rows.append((*ids, 0, None, None, None, None, None))
                    continue
                digest = xxhash.xxh3_128_digest(found.tobytes())
                rows.append((*ids, len(found), digest, *_keys(signature(found, factors)), odd_rests(found)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                    schema=schema)

    return run


def _set_reader(width: int):
    """Sets of the texts that have the digest asked for: an id may be repeated with another text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), width) for t in batch["text"]]
            asked = batch["digest"].to_pylist()
            rows = [k for k, s in enumerate(sets) if xxhash.xxh3_128_digest(s.tobytes()) == asked[k]]
            if rows:
                ends = np.cumsum([0, *(len(sets[k]) for k in rows)]).astype(np.int32)
                values = np.concatenate([sets[k] for k in rows]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch["node"].take(pa.array(rows)), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
                    names=["node", "shingles"])

    return run


def _walk_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of regions, each with its neighbour before it, from rows ``tree, high, low, node`` in sorted order.

    Rows alone in their region are left out, but for the first and the last of the range:
    ``edge`` has 1 for the first and 2 for the last, 3 for an only one, and 0 otherwise.
    """
    part = TaskContext.get().partitionId()
    held = None  # the last row so far, which waits for the row after it

    def rows(of: dict[str, np.ndarray], kept: np.ndarray) -> pa.RecordBatch:
        tree, high, low = (of[n].astype(np.int64)[kept].view(np.uint64) for n in ("tree", "high", "low"))
        region = mixed(mixed(mixed(tree + np.uint64(1)) + high) + (low >> np.uint64(64 - _DIGITS)))
        return pa.RecordBatch.from_arrays(
            [pa.array(of["node"][kept]), pa.array(region.view(np.int64)),
             pa.array(of["neighbour"][kept], mask=~of["shares"][kept]),
             pa.array(np.full(kept.sum(), part, np.int32)), pa.array(of["edge"][kept])],
            names=["node", "region", "neighbour", "part", "edge"])

    for batch in batches:
        if not batch.num_rows:
            continue
        of = {n: batch[n].to_numpy() for n in ("tree", "high", "low", "node")}
        if held is not None:
            of = {n: np.concatenate([held[n], v]) for n, v in of.items()}
        count = len(of["node"])
        region = (of["tree"][1:] == of["tree"][:-1]) & (of["high"][1:] == of["high"][:-1]) & (
            (of["low"][1:] ^ of["low"][:-1]) >> (64 - _DIGITS) == 0)
        run = region & (of["low"][1:] == of["low"][:-1])
        start = np.maximum.accumulate(np.where(np.concatenate([[True], ~run]), np.arange(count), 0))
        # The first of the run a row is in, and for that first itself the first of the run before.
        head = of["node"][start]
        if held is not None:
            head[start == 0] = held["head"][0]
        of["head"], of["neighbour"] = head, np.concatenate([head[:1], head[:-1]])
        of["shares"] = np.concatenate([[False], region])
        of["edge"] = np.zeros(count, np.int32)
        if held is None:
            of["edge"][0] = 1
        else:
            for n in ("neighbour", "shares", "edge"):
                of[n][0] = held[n][0]
        kept = of["shares"] | (of["edge"] > 0)
        kept[:-1] |= region
        held = {n: v[-1:].copy() for n, v in of.items()}
        kept[-1] = False
        if kept.any():
            yield rows(of, kept)
    if held is not None:
        held["edge"] += 2
        yield rows(held, np.array([True]))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes ``(a, b)`` whose full sets have at least ``percent`` of their union in common."""
    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - both
    return pairs.join(first, "a").join(second, "b").where(100 * both >= percent * union).select("a", "b")


def _differing(name: str, words: int) -> Column:
    """In how many bits a sketch of two rows differs."""
    return sum((F.bit_count(F.col(f"x.{name}")[k].bitwiseXOR(F.col(f"y.{name}")[k])) for k in range(words)), F.lit(0))


def _could_link(percent: int) -> Column:
    """Neither the sizes nor the sketches of two nodes rule out a link."""
    agree = (1 + percent / 100) / 2
    most = _BITS * (1 - agree) + _SLACK * (_BITS * agree * (1 - agree)) ** 0.5
    sizes = 100 * F.least("x.size", "y.size") >= percent * F.greatest("x.size", "y.size")
    # Linked sets differ in at most this part of their shingles.
    rests = _differing("odd", _RESTS // 64) * (100 + percent) <= (F.col("x.size") + F.col("y.size")) * (100 - percent)
    return sizes & rests & (_differing("bits", -(-_BITS // 64)) <= int(most))


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", seed: int = 7
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    A document is its set of distinct shingles of ``width`` words (A-Z in lower case, cut
    at ASCII white space; fewer words are one shingle). Two are linked if the intersection
    is at least ``percent`` (80 to 100, others are refused) hundredths of the union; ``component_id`` is the smallest id
    that links reach. Null and empty texts, or such of white space, have no shingles and
    are linked with nothing: their component is their own id. Rows with equal texts share
    a component even if an id is null or repeated; where no id of a component is known the
    component is null. ``kept`` says that a row's id is its component's (null as a value).
    Texts of any length are read whole, other columns are not read, no rows give no rows.
    """
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return _placed(docs, width, percent, id_col, text_col, seed).select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _placed(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str, seed: int) -> DataFrame:
    """Each row's id, text hash, set size, root (null without shingles) and component's smallest id."""
    if not 80 <= percent <= 100:
        raise ValueError("regions are laid out for similarities from 80 to 100 percent")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("text_hash"))
    features = work_table(slim.mapInArrow(_featurizer(width, seed), _FEATURES))
    nodes = work_table(
        features.where("digest is not null").groupBy("digest").agg(
            F.min("doc_id").alias("least_id"), F.any_value("n_shingles").alias("size"),
            F.any_value("high").alias("high"), F.any_value("low").alias("low"),
            F.any_value("bits").alias("bits"), F.any_value("odd").alias("odd"),
        ).withColumn("node", F.monotonically_increasing_id()))

    # Rows of every tree whose region holds more than one node, and those at the ends of a sorted range.
    key = ["tree", "high", "low", "node"]
    trees = nodes.select("node", F.posexplode(F.arrays_zip("high", "low")).alias("tree", "at")).select(
        "tree", "at.high", "at.low", "node")
    members = work_table(trees.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(_walk_trees, _MEMBERS))
    before = F.lag(F.struct("region", "node", "part")).over(Window.orderBy("part", "edge"))  # two rows for each range
    borders = members.where("edge > 0").withColumn("last", before).where("last.region = region and last.part <> part")
    first = members.where("neighbour is not null").select("node", F.col("neighbour").alias("b")).unionByName(
        borders.select("node", F.col("last.node").alias("b"))).where("node <> b")
    pairs = work_table(first.select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct())

    # Full sets of the nodes that have company at all, read from one of their documents.
    company = members.select("node").distinct().join(nodes.select("node", "digest", "least_id"), "node")
    texts = slim.select("doc_id", "text").where("text is not null").join(company, F.col("doc_id").eqNullSafe(F.col("least_id")))
    texts = texts.groupBy("node", "digest", F.xxhash64("text").alias("of")).agg(F.any_value("text").alias("text"))
    sets = work_table(texts.mapInArrow(_set_reader(width), "node long, shingles array<long>"))

    links = work_table(_confirmed(pairs, sets, percent))
    roots = connected_components(links)
    rest = work_table(_across(members, nodes, roots, percent).join(pairs, ["a", "b"], "left_anti"))
    more = _confirmed(rest, sets, percent)
    roots = connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))

    placed = nodes.select("node", "digest", "least_id").join(roots, "node", "left").select(
        "digest", "least_id", F.coalesce("root", "node").alias("root"))
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    found = placed.join(least, "root").select("digest", "root", "component_id")
    return features.select("doc_id", "text_hash", "n_shingles", "digest").join(found, "digest", "left")


def _across(members: DataFrame, nodes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs of a region in different components that could still be linked."""
    placed = members.select("region", "node").join(roots, "node", "left").select(
        "region", "node", F.coalesce("root", "node").alias("root"))
    shares = placed.groupBy("region", "root").agg(F.count("*").alias("n"))
    mixed_regions = shares.groupBy("region").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots")).where("roots > 1")
    rows = work_table(placed.join(mixed_regions.select("region", "main"), "region").join(
        nodes.select("node", "size", "bits", "odd"), "node"))
    x, y = rows.where("root <> main").alias("x"), rows.alias("y")
    once = (F.col("y.root") == F.col("y.main")) | (F.col("x.node") > F.col("y.node"))
    both = x.join(y, (F.col("x.region") == F.col("y.region")) & (F.col("x.root") != F.col("y.root"))
                  & once & _could_link(percent))
    return both.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()


def drop_near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", seed: int = 7
) -> DataFrame:
    """The rows of ``docs``, all columns, of which one of each component stays: that with the smallest id.

    Documents without shingles all stay. Of rows with the same id the one with the smallest
    text hash stays, of rows equal in id and text any one; a row without an id stays only if
    no row of its component has one.
    """
    placed = _placed(docs, width, percent, id_col, text_col, seed)
    first = placed.where("root is not null").groupBy("root").agg(
        F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_hash")).alias("at"))
    stays = first.select("at.doc_id", "at.text_hash", F.lit(True).alias("one")).unionByName(
        placed.where("root is null").select("doc_id", "text_hash", F.lit(False).alias("one")).distinct())
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("own_id"),
                       F.xxhash64(text_col).alias("own_hash"))
    joined = rows.join(stays, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash")))
    nth = F.row_number().over(Window.partitionBy("own_id", "own_hash").orderBy("one"))
    return joined.withColumn("nth", F.when(F.col("one"), nth).otherwise(1)).where("nth = 1").select("row.*")
