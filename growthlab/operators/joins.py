"""Join shapes: null-safe, fan-out, look-ups, id sets. Skewed keys are left to adaptive execution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join in which NULL matches NULL; key columns are merged from both sides."""
    tagged = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = None
    for k in keys:
        eq = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = eq if cond is None else cond & eq
    joined = left.join(tagged, cond, how)
    for k in keys:
        joined = joined.withColumn(k, F.coalesce(F.col(k), F.col(f"_r_{k}")))
    return joined.drop(*[f"_r_{k}" for k in keys])


def lookup(df: DataFrame, col: str, table: dict, out: str, default: object = None) -> DataFrame:
    """Value -> label from a fixed dictionary, as a literal map (no join needed)."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    found = F.try_element_at(F.create_map(*entries), F.col(col))
    if default is not None:
        found = F.coalesce(found, F.lit(default))
    return df.withColumn(out, found)


def keep_ids(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    return df.join(ids.select(on), on, "left_semi")


def drop_ids(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    return df.join(ids.select(on).where(F.col(on).isNotNull()), on, "left_anti")


def in_window(ts: Column, anchor: Column, hours: int) -> Column:
    """Whole elapsed hours from the anchor within 0..hours; a part hour before it counts as 0."""
    return F.timestamp_diff("HOUR", anchor, ts).between(0, hours)


def mixed_pairs(df: DataFrame, keys: list[str], col: str, least: int = 2) -> DataFrame:
    """Key tuples holding at least `least` distinct values of a column."""
    return (
        df.groupBy(*keys)
        .agg(F.count_distinct(col).alias("_kinds"))
        .where(F.col("_kinds") >= least)
        .drop("_kinds")
    )
