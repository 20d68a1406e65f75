"""Reproducible experiment assignment and value banding."""

from __future__ import annotations

from collections.abc import Callable

from fractions import Fraction
from math import lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthlab.functions import scalars as S
from growthlab.operators import ordered as O

# Percentile levels and category thresholds.
LEVELS = [
    75, 80, 85, 88, 90, 91, 92, 93, 94, 95, 96, 97, 98, 98.5, 99, 99.5, 99.8, 99.9, 99.99, 99.999, 100,
]
CATEGORY_LIMITS = [(0, 75), (1, 90), (2, 98), (3, 99.5), (4, 99.8), (5, 99.999)]
LAST_CATEGORY = 6

# Bounds of the value bands used for the half split.
SPLIT_BOUNDS = [15, 75, 125]


def category(percentile: Column) -> Column:
    out = None
    for cat, limit in CATEGORY_LIMITS:
        hit = percentile <= limit
        out = F.when(hit, F.lit(cat)) if out is None else out.when(hit, F.lit(cat))
    return out.otherwise(F.lit(LAST_CATEGORY))


def percentile_band(
    df: DataFrame, value: str, levels: list[float] = LEVELS, quantiles: Callable = O.exact_quantiles
) -> DataFrame:
    """Smallest listed percentile whose quantile covers the value, and its category. Quantiles are exact unless another
    function, such as sketches.sketch_quantiles, is given."""
    keyed = df.select(F.lit(1).alias("_all"), F.col(value).cast("double").alias(value))
    cuts = (
        quantiles(keyed, ["_all"], value, [p / 100 for p in levels])
        .select("quantiles")
        .scalar()
    )
    steps = F.array(*[F.lit(float(p)) for p in levels])
    place = F.array_position(F.transform("_cuts", lambda q: F.col(value) <= q), True)
    return (
        df.withColumn("_cuts", cuts)
        .withColumn("percentile", F.coalesce(F.get(steps, (place - 1).cast("int")), F.lit(100.0)))
        .withColumn("category", category(F.col("percentile")))
        .drop("_cuts")
    )


def value_band(col: Column) -> Column:
    """Band number 0..3 of the split metric; NULL stays NULL."""
    low, mid, high = SPLIT_BOUNDS
    return (
        F.when(col < low, 0).when(col < mid, 1).when(col < high, 2).when(col >= high, 3)
    )


def random_half(df: DataFrame, key: str, chosen: Column, seed: object, out: str) -> DataFrame:
    """Flag exactly half (rounded down) of the chosen rows."""
    marked = df.withColumn("_chosen", F.coalesce(chosen, F.lit(False)).cast("int"))
    ranked = O.draw_rank(marked, ["_chosen"], key, seed)
    take = (F.col("_chosen") == 1) & (F.col("_rank") < F.floor(F.col("_size") / 2))
    return ranked.withColumn(out, take.cast("int")).drop("_chosen", "_rank", "_size")


def half_per_band(df: DataFrame, key: str, metric: str, seed: object, out: str) -> DataFrame:
    """Flag exactly half (rounded down) of every value band; rows without a value get 0."""
    banded = df.withColumn("_band", value_band(F.col(metric)))
    ranked = O.draw_rank(banded, ["_band"], key, seed)
    take = F.col("_band").isNotNull() & (F.col("_rank") < F.floor(F.col("_size") / 2))
    return ranked.withColumn(out, F.coalesce(take, F.lit(False)).cast("int")).drop(
        "_band", "_rank", "_size"
    )


def arm_pattern(groups: int = 2, shares: list[Fraction] | None = None) -> list[int]:
    """One block: each arm as often as its share asks for."""
    shares = shares or [Fraction(1, groups)] * groups
    if sum(shares) != 1:
        raise ValueError("shares must add up to 1")
    size = lcm(*[s.denominator for s in shares])
    return [arm for arm, s in enumerate(shares) for _ in range(int(s * size))]


def block_randomize(
    df: DataFrame,
    key: str,
    strata: list[str],
    groups: int = 2,
    shares: list[Fraction] | None = None,
    seed: object = 42,
) -> tuple[DataFrame, DataFrame]:
    """Random arms in blocks within each stratum, and the balance table.

    Rows left over after the last full block take distinct places of one more block, so arm sizes
    inside a stratum differ from their share by less than one block."""
    for name in ("group", "treat"):
        if name in df.columns:
            raise ValueError(f"{name} must not be a column of the input")
    pattern = arm_pattern(groups, shares)
    ranked = O.draw_rank(df, strata, key, seed)
    text = F.concat_ws("|", *[F.coalesce(F.col(s).cast("string"), F.lit("")) for s in strata])
    place = (F.col("_rank") + S.draw_int(seed, text)) % len(pattern)
    arms = F.array(*[F.lit(a) for a in pattern])
    assigned = ranked.withColumn("group", F.get(arms, place.cast("int"))).drop("_rank", "_size")
    return assigned, balance(assigned, strata, groups)


def balance(df: DataFrame, strata: list[str], groups: int) -> DataFrame:
    """Rows per stratum and arm, arms as columns."""
    return df.groupBy(*strata).agg(
        *[F.count_if(F.col("group") == g).alias(f"group_{g}") for g in range(groups)]
    )


def stratified_split(
    df: DataFrame, label: str, key: str, seed: object = 42, share: float = 0.2
) -> DataFrame:
    """Train / val / test per label: `share` for test, then `share` of the rest for val."""
    ranked = O.draw_rank(df, [label], key, seed)
    test = F.ceil(F.col("_size") * share)
    val = F.ceil((F.col("_size") - test) * share)
    part = (
        F.when(F.col("_rank") < test, "test")
        .when(F.col("_rank") < test + val, "val")
        .otherwise("train")
    )
    return ranked.withColumn("part", part).drop("_rank", "_size")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    # one row per class
    every = W.partitionBy()
    return counts.withColumn(
        "weight",
        F.sum("rows").over(every) / (F.count(F.lit(1)).over(every) * F.col("rows")),
    )


def next_run(history: DataFrame, counter: str, first: int = 1) -> Column:
    """COALESCE(MAX(counter), first) + 1 as one value."""
    return history.agg((F.coalesce(F.max(counter), F.lit(first)) + 1).alias("n")).scalar()
