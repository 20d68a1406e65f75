"""Token budgets over a tree of sources, and a seeded selection that meets them.

The tree's levels are columns (domain, language, source). A node passes its budget to its children by
weight; a child takes no more than its subtree holds in `max_epochs` passes, and what it leaves goes to its
siblings by weight. Because a node never gets more than its subtree can hold, a shortage reaches the next
level up only when all siblings are full. Weights are whole numbers, so budgets are exact.

A leaf's budget buys whole passes over its documents and a prefix of one more pass, in an order seeded per
pass. The prefix sum is split: tokens are summed per leaf and slice of the order, then inside each slice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthlab.llm.quality import words
from growthlab.llm.storage import ready, stored, without

#: hexadecimal digits of the order's hash that make a slice
SLICE = 3


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, int], share_percent: int, max_epochs: int
) -> DataFrame:
    """Leaves (levels and supply) with their budget. `weights` by path, names joined with "/"; 1 where
    no weight is given."""
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else None
    all_supply = W.partitionBy()
    out = leaves.withColumn("capacity", F.col("supply") * max_epochs)
    wanted = F.expr(f"sum(supply) OVER () * {int(share_percent)} DIV 100")
    out = out.withColumn("budget", F.least(wanted, F.sum("capacity").over(all_supply)))
    for k in range(len(levels)):
        path = list(levels[: k + 1])
        name = F.concat_ws("/", *path)
        weight = F.lit(1) if table is None else F.coalesce(F.try_element_at(table, name), F.lit(1))
        # one row for each child of this level; its parent's budget is the same on all its rows
        child = out.groupBy(*path).agg(
            F.sum("capacity").cast("long").alias("room"), F.max("budget").cast("long").alias("given")
        )
        child = child.withColumn("weight", weight.cast("long"))
        parent = W.partitionBy(*path[:-1])
        by_fill = parent.orderBy((F.col("room") / F.nullif("weight", F.lit(0))).asc_nulls_last(), *path)
        earlier = F.coalesce(F.sum("room").over(by_fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        heavier = F.sum("weight").over(by_fill.rowsBetween(W.currentRow, W.unboundedFollowing))
        # tokens for each unit of weight if this child and the later ones share what the earlier leave;
        # the largest such value is the one at which the full children are exactly those that come earlier
        child = child.withColumn("rate", (F.col("given") - earlier) / F.nullif(heavier, F.lit(0)))
        rate = F.max("rate").over(parent)
        share = F.least(F.col("room"), F.floor(F.col("weight") * rate))
        child = child.withColumn("share", F.coalesce(share, F.lit(0)).cast("long"))
        out = out.drop("budget").join(child.select(*path, F.col("share").alias("budget")), path)
    return out.select(*levels, "supply", "budget")


def mix_sources(
    docs: DataFrame,
    levels: Mapping[str, Column],
    weights: Mapping[str, int],
    share_percent: int = 80,
    max_epochs: int = 2,
    seed: str = "0",
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_text: bool = False,
) -> DataFrame:
    """The selected documents, once for each epoch: their columns (the text only if `keep_text`), the levels'
    columns, n_tokens (words), epoch (from 0) and budget (the leaf's tokens).

    `levels` names the tree's levels in order and gives the column each is read from; NULL there is a branch
    named "unknown". The total budget is `share_percent` of all tokens, at most what `max_epochs` passes hold.
    Inside an epoch documents are ordered by md5 of seed, epoch and id, then id and size; a prefix ends
    before the document that would exceed its budget. Texts without words are never drawn. NULL ids are
    ordered as the text "NULL". Rows that repeat an id are drawn for themselves. A weight of 0 gives a branch
    nothing. Input columns named like a result are replaced."""
    ready(docs.sparkSession)
    names = list(levels)
    clean = {n: F.coalesce(c.cast("string"), F.lit("unknown")) for n, c in levels.items()}
    made = ("n_tokens", "epoch", "budget", "supply", "_slice", "_order", "_id")
    rows = docs.withColumns({f"_level_{n}": c for n, c in clean.items()})
    rows = rows.withColumn("_id", F.coalesce(F.col(id_col).cast("string"), F.lit("NULL")))
    counted = F.size(words(F.col(text_col))).cast("long")
    rows = rows.withColumn("_n", counted)
    rows = without(rows, *names, *[m for m in made if m != "_id"])
    rows = rows.withColumnsRenamed({f"_level_{n}": n for n in names} | {"_n": "n_tokens"})
    if not keep_text:
        rows = rows.drop(text_col)
    rows = stored(rows.where("n_tokens > 0"), "counted_documents")
    leaves = stored(rows.groupBy(*names).agg(F.sum("n_tokens").alias("supply")), "leaves")
    budgets = stored(leaf_budgets(leaves, names, weights, share_percent, max_epochs), "leaf_budgets")
    # leaves are joined to every row: few for a curated tree, and a plain join for one of millions of leaves
    rows = rows.join(budgets, names)
    whole = F.expr("budget DIV supply")
    passes = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), whole)))
    full = passes.where(F.col("epoch") < whole)

    last = passes.where((F.col("epoch") == whole) & (F.expr("budget % supply") > 0))
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col("epoch").cast("string"), F.col("_id")))
    last = last.withColumn("_order", order).withColumn("_slice", F.substring(order, 1, SLICE))
    slices = last.groupBy(*names, "_slice").agg(F.sum("n_tokens").alias("_tokens"))
    before = W.partitionBy(*names).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    slices = slices.select(*names, "_slice", F.coalesce(F.sum("_tokens").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy(*names, "_slice").orderBy("_order", "_id", "n_tokens")
    running = F.sum("n_tokens").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow))
    last = last.withColumn("_running", running).join(slices, [*names, "_slice"])
    last = last.where(F.col("_before") + F.col("_running") <= F.expr("budget % supply"))
    return full.unionByName(last.select(*full.columns)).drop("_id", "supply")
