"""Mixing sources to target weights: a token budget is handed down a tree, leaves give prefixes of epochs.

The budget of a node goes to its children by their weights. A child takes no more than its
subtree holds, times the epochs allowed; what it leaves goes to its siblings by their
weights, and only what all of them cannot take is missing from their parent, whose siblings
get it in the same way. As each node's budget is settled before its children's, this is
one pass from the root to the leaves.

A leaf whose budget is several times its tokens is read in that many whole epochs and a
prefix of one more. The order of an epoch is that of seeded hashes, so a prefix is found
without sorting the leaf: sums by the first hash digits tell in which small part it ends,
and only that part is put in order. A leaf with a third of all rows is no task of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .work import work_table

WORD = r"[^\x20\x09-\x0D]+"
DIGITS = 3  # 4096 parts of each leaf


def epoch_order(seed: int, epoch: Column, key: Column) -> Column:
    """Hexadecimal digits by which a document stands in an epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit(""))))


def share_budgets(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """``nodes`` with ``budget`` (of the parent) replaced by each child's part of it.

    ``nodes`` has ``weight`` and ``capacity``, whole numbers. Children are filled in the
    order of capacity to weight; the first that does not get full ends the full ones, and
    the others share the rest by weight, rounded so that it comes out exactly. A weight of
    zero or below gets nothing.
    """
    family = [F.col(p) for p in parents] or [F.lit(0)]
    order = Window.partitionBy(*family).orderBy("ratio", name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(*family)
    fed = nodes.where("weight > 0").withColumn("ratio", F.col("capacity").cast("double") / F.col("weight").cast("double"))
    fed = fed.withColumn("filled", F.coalesce(F.sum("capacity").over(before), F.lit(0))).withColumn(
        "ahead", F.sum("weight").over(onward))
    fed = fed.withColumn("full", F.expr("capacity * ahead <= weight * (budget - filled)"))
    open_weight = F.when(F.col("full"), 0).otherwise(F.col("weight"))
    fed = fed.withColumn("left", F.col("budget") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(whole))
    fed = fed.withColumn("open", F.sum(open_weight).over(whole)).withColumn("upto", F.sum(open_weight).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    part = F.when(F.col("full"), F.col("capacity")).otherwise(F.expr("(left * upto) div open - (left * (upto - weight)) div open"))
    return fed.withColumn("budget", part).drop("ratio", "filled", "ahead", "full", "left", "open", "upto")


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: dict[str, Column], budget_share: float, max_epochs: int) -> DataFrame:
    """Budget of each leaf of ``(*levels, available)``; ``budget_share`` is of all tokens."""
    capacity = leaves.withColumn("capacity", F.col("available") * max_epochs)
    total = leaves.agg(F.floor(F.coalesce(F.sum("available"), F.lit(0)) * F.lit(budget_share)).cast("long").alias("budget"))
    nodes: list[DataFrame] = []
    below = capacity
    for depth in reversed(range(len(levels))):
        summed = below.groupBy(*levels[: depth + 1]).agg(F.sum("capacity").alias("capacity"))
        nodes.append(summed.withColumn("weight", weights[levels[depth]].cast("long")))
        # What a node without weight holds is no capacity of those above it.
        below = nodes[-1].where("weight > 0")
    above: DataFrame | None = None
    for depth, name in enumerate(levels):
        path = levels[: depth + 1]
        if above is None:
            # One row with the budget, so that the product has as many rows as there are children.
            fed = nodes.pop().withColumn("budget", total.scalar())
        else:
            fed = nodes.pop().join(above, path[:-1])
        above = share_budgets(fed, path[:-1], name).select(*path, "budget")
    return leaves.join(above, levels)


def mix_sources(
    docs: DataFrame, levels: dict[str, Column], weights: dict[str, Column], budget_share: float, max_epochs: int = 1,
    seed: int = 5, id_col: str = "doc_id", tokens: Column | None = None, epoch_col: str = "epoch",
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, once for each epoch, with the epoch's number (from 0).

    ``levels`` names the tree's levels from the top and says how a row's branch is found; a
    null branch counts as the empty string. ``weights`` gives whole-number weights from the
    level columns; zero takes nothing, and what lies below counts for no node above. ``tokens`` counts a row's tokens, by default the words
    of ``text`` (null: none). The budget is ``budget_share`` of all tokens, or all that
    ``max_epochs`` epochs hold if that is less.

    A leaf takes rows in the epoch's order while their sum stays within its budget. Rows with
    the same id, null among them, are taken together. Without rows or tokens nothing is taken. All columns stay
    as they are, ``epoch_col`` replaces one of that name. Budgets times weights must fit 63 bits.
    """
    names = list(levels)
    count = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)) if tokens is None else tokens
    branch = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()]
    slim = work_table(docs.select(*branch, F.col(id_col).alias("key"), count.cast("long").alias("tokens")))
    leaves = slim.groupBy(*names).agg(F.sum("tokens").alias("available"))
    budgets = leaf_budgets(leaves, names, weights, budget_share, max_epochs)
    plan = work_table(budgets.where("available > 0").select(
        *names, F.expr("budget div available").alias("epochs"), F.expr("budget % available").alias("part")))

    rows = slim.join(plan, names).withColumn("at", epoch_order(seed, F.col("epochs"), F.col("key")))
    rows = rows.select(*names, "part", "tokens", "at", F.substring("at", 1, DIGITS).alias("digits"))
    upto = Window.partitionBy(*names).orderBy("digits")
    sums = rows.groupBy(*names, "part", "digits").agg(F.sum("tokens").alias("tokens"))
    sums = sums.withColumn("end", F.sum("tokens").over(upto)).withColumn("before", F.col("end") - F.col("tokens"))
    edge = work_table(sums.where("before <= part and part < end").select(*names, "digits", "before"))
    in_order = Window.partitionBy(*names).orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = rows.join(edge, [*names, "digits"]).withColumn("end", F.col("before") + F.sum("tokens").over(in_order)).where(
        "end <= part").groupBy(*names).agg(F.max("at").alias("last"))
    # Any hash that begins with the digits comes after them.
    # A row for each leaf; stored, its size is known when the texts are joined to it, so they stay where they are.
    ends = work_table(plan.join(edge, names, "left").join(last, names, "left").select(
        *names, "epochs", F.coalesce("last", "digits").alias("upto")))

    keyed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("key"), *branch)
    taken = keyed.join(ends, names).withColumn("at", epoch_order(seed, F.col("epochs"), F.col("key")))
    times = F.col("epochs") + F.when(F.col("at") <= F.col("upto"), 1).otherwise(0)
    taken = taken.withColumn("times", times).where("times > 0")
    taken = taken.withColumn("epoch", F.explode(F.sequence(F.lit(0), (F.col("times") - 1).cast("int"))))
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c != epoch_col]
    return taken.select(*kept, F.col("epoch").alias(epoch_col))
