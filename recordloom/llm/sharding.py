"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Were all rows permuted and then cut into shards, the number that block i sends to shard j
would follow a multivariate hypergeometric law: rows of the matrix add up to the blocks'
sizes, columns to the shards'. So the counts are drawn first. Every block then permutes
its own rows and deals them out by its counts, one exchange brings the rows of a shard
together, and each shard is permuted again. Every order of all rows is equally likely.

The matrix is never built as one: blocks are the leaves of a binary tree, each node draws
from its own seeded generator what of each shard goes to its left half, and a task walks
the tree down to its block. A walk takes one draw for each shard and level of the tree,
however many rows there are, and all tasks agree without talking to each other.

The order within a shard is that of a hash of each row's place. Ranges of the hash cut a shard
into parts of about ``part_rows`` rows, numbered each on its own, so no task holds a whole shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log, log1p, pi

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .work import work_table

PART_ROWS = 65_536
_POSITION_BITS = 33  # of monotonically_increasing_id: the rest is the block
_NUMPY_MOST = 1_000_000_000  # numpy's generator draws below this many rows


def _stirling_error(n: float) -> float:
    """``log(n!)`` less its Stirling approximation, without loss of digits for large ``n``."""
    if n < 16:
        return lgamma(n + 1) - (n + 0.5) * log(n) + n - log(2 * pi) / 2
    return (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / n**2) / n**2) / n**2) / n


def _deviance(x: float, mean: float) -> float:
    """``x * log(x / mean) + mean - x``, by a series where the two are close."""
    v = (x - mean) / (x + mean)
    if abs(v) >= 0.1:
        return x * log(x / mean) + mean - x
    total, term, k = (x - mean) * v, 2 * x * v, 3
    while True:
        term *= v * v
        if total + term / k == total:
            return total
        total, k = total + term / k, k + 2


def binomial_log(x: int, n: int, p: float) -> float:
    """Logarithm of the binomial probability of ``x`` among ``n``, by the saddle point expansion."""
    if x == 0:
        return n * log1p(-p)
    if x == n:
        return n * log(p)
    return (_stirling_error(n) - _stirling_error(x) - _stirling_error(n - x) - _deviance(x, n * p)
            - _deviance(n - x, n * (1 - p)) + log(n / (2 * pi * x * (n - x))) / 2)


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` taken from ``good`` and ``bad`` are good, for any numbers.

    A binomial number is proposed for the smaller kind and kept with the probability that
    the other kind makes up the rest, relative to its largest: that is the hypergeometric
    law, and seven in ten proposals or more are kept.
    """
    if good + bad < _NUMPY_MOST:
        return int(rng.hypergeometric(good, bad, draws)) if good else 0
    if draws in (0, good + bad):
        return good if draws else 0
    if good > bad:
        return draws - draw_hypergeometric(rng, bad, good, draws)
    p = draws / (good + bad)
    most = binomial_log(min(bad, int((bad + 1) * p)), bad, p)
    while True:
        taken = int(rng.binomial(good, p))
        if 0 <= draws - taken <= bad and rng.random() < exp(binomial_log(draws - taken, bad, p) - most):
            return taken


def draw_split(rng: np.random.Generator, colors: np.ndarray, draws: int) -> np.ndarray:
    """How many of each colour there are among ``draws`` taken without replacement."""
    taken = np.zeros(len(colors), np.int64)
    left, after = int(draws), int(colors.sum())
    for k, n in enumerate(colors.tolist()):
        if not left:
            break
        after -= n
        taken[k] = draw_hypergeometric(rng, n, after, left)
        left -= int(taken[k])
    return taken


def block_row(block: int, upto: np.ndarray, shards: np.ndarray, seed: int) -> np.ndarray:
    """What a block sends to each shard; ``upto`` has the rows before each block, and all at its end."""
    first, last, colors = 0, len(upto) - 1, shards
    while last - first > 1:
        middle = (first + last) // 2
        rng = np.random.default_rng([seed, first, last])
        left = draw_split(rng, colors, int(upto[middle] - upto[first]))
        if block < middle:
            last, colors = middle, left
        else:
            first, colors = middle, colors - left
    return colors


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Sizes that differ by one at most, the larger ones first."""
    return np.array([rows // shards + (k < rows % shards) for k in range(shards)], np.int64)


def _dealer(blocks: list[int], upto: np.ndarray, shards: np.ndarray, seed: int):
    at = {block: k for k, block in enumerate(blocks)}

    @F.pandas_udf("long")
    def deal(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known: tuple[int, np.ndarray, np.ndarray] | None = None
        for block, position in batches:
            out = np.empty(len(block), np.int64)
            for one in block.unique():
                if known is None or known[0] != one:
                    k = at[int(one)]
                    ends = np.cumsum(block_row(k, upto, shards, seed))
                    known = one, ends, np.random.default_rng([seed, k]).permutation(int(upto[k + 1] - upto[k]))
                mine = (block == one).to_numpy()
                out[mine] = np.searchsorted(known[1], known[2][position.to_numpy()[mine]], side="right")
            yield pd.Series(out)

    return deal


def shard_rows(
    docs: DataFrame, shards: int, seed: int = 3, part_rows: int = PART_ROWS, shard_col: str = "shard", slot_col: str = "slot"
) -> DataFrame:
    """``docs`` with ``shard_col`` (0 to ``shards`` - 1) and ``slot_col`` (from 0 without gaps in each shard).

    Shard sizes are equal or, where the rows cannot be divided, the first shards have one
    more. All columns stay and may hold anything, nulls and repeated rows are rows like
    others; columns of the two names are replaced. Fewer rows than shards leave the last
    shards empty; no rows give no rows.

    The rows are stored once with their block and position, so that a task that is run again
    deals them out as before. What is sent to every task is one number for each block of the
    input and each shard.
    """
    at = F.monotonically_increasing_id()
    stored = work_table(docs.select(F.struct("*").alias("row"), at.alias("at")))
    block, position = F.shiftright("at", _POSITION_BITS), F.col("at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    sizes = stored.groupBy(block.alias("block")).agg(F.count("*").alias("n")).orderBy("block").collect()
    upto = np.cumsum([0, *(r.n for r in sizes)])
    counts = shard_sizes(int(upto[-1]), shards)
    deal = _dealer([r.block for r in sizes], upto, counts, seed)
    order = F.xxhash64(F.lit(seed), "at")
    parts = max(1, -(-int(counts[0]) // part_rows))
    # Ranges of the hash, from its upper 31 bits, in the hash's order.
    part = F.shiftright((F.shiftright(order, 33) + (1 << 30)) * parts, 31)
    dealt = stored.withColumns({"shard": deal(block, position), "order": order, "part": part})

    upto_part = Window.partitionBy("shard").orderBy("part")  # a row for each part
    held = dealt.groupBy("shard", "part").agg(F.count("*").alias("held"))
    firsts = held.select("shard", "part", (F.sum("held").over(upto_part) - F.col("held")).alias("first"))
    nth = F.row_number().over(Window.partitionBy("shard", "part").orderBy("order", "at")) - 1
    placed = dealt.withColumn("nth", nth).join(firsts, ["shard", "part"])
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in (shard_col, slot_col)]
    return placed.select(*kept, F.col("shard").cast("int").alias(shard_col), (F.col("first") + F.col("nth")).cast("long").alias(slot_col))
