"""Mergeable summaries of bounded size: distinct counts (HyperLogLog) and quantiles (KLL).

Sketches are made once per small grain, for example day and channel, may be stored as they are, and merge to any coarser
grain without reading the rows again. `ordered.exact_quantiles` and exact distinct counts are the exact counterparts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12
K = 400


def distinct_error(lg_k: int = LG_K, deviations: float = 4.0) -> float:
    """Relative error of a merged distinct count that is exceeded once in some 16,000 times."""
    return deviations * 1.04 / math.sqrt(1 << lg_k)


def rank_error(k: int = K) -> float:
    """Rank error of a quantile, as a share of the rows, exceeded in about 1 of 100 cases (2.296 / k ** 0.9021)."""
    return 2.296 / k**0.9021


def distinct_sketches(df: DataFrame, keys: list[str], value: str, lg_k: int = LG_K) -> DataFrame:
    """One sketch of the distinct non-NULL values per key."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(value), lg_k).alias("sketch"))


def merge_distinct(sketches: DataFrame, keys: list[str]) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimates(sketches: DataFrame, out: str = "distinct") -> DataFrame:
    return sketches.withColumn(out, F.hll_sketch_estimate("sketch")).drop("sketch")


def quantile_sketches(df: DataFrame, keys: list[str], value: str, k: int = K) -> DataFrame:
    """One sketch of the non-NULL values per key."""
    rows = df.where(F.col(value).isNotNull())
    return rows.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def merge_quantiles(sketches: DataFrame, keys: list[str], k: int = K) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_quantiles(df: DataFrame, keys: list[str], value: str, levels: list[float], k: int = K) -> DataFrame:
    """Like ordered.exact_quantiles, one row per key with an array in level order, from one pass with a bounded sketch per
    key: each value's rank is off by at most about `rank_error(k)` of the rows. Values are members of the column."""
    points = F.array(*[F.lit(float(p)) for p in levels])
    made = quantile_sketches(df, keys, value, k)
    return made.select(*keys, F.kll_sketch_get_quantile_double("sketch", points).alias("quantiles"))
