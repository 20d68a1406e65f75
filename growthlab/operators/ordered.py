"""Ordered computations that stay balanced when one key owns a large share of the rows.

A plain window puts each key in a single task. The operators here range-partition the rows by
(key, order) instead, number the resulting slices, fix them with a reliable checkpoint, work
inside each (key, slice) and add what came before from a table of slice totals. Only rows that
a roll-up has already bounded (days of a user, weeks of a cohort) use plain windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthlab.functions import scalars as S
from growthlab.session import durable

_SLICE = "_slice"


def sliced(df: DataFrame, keys: list[str], order: list[str], slices: int | None = None) -> DataFrame:
    """Rows cut into ordered slices of similar size. The order columns must make rows unique
    (or be pre-aggregated) for a hot key to be split.

    Without a number the cluster's shuffle partition count applies, and adaptive execution merges
    slices that turn out small."""
    by = [F.col(c) for c in keys + order]
    ranged = df.repartitionByRange(slices, *by) if slices else df.repartitionByRange(*by)
    return durable(ranged.withColumn(_SLICE, F.spark_partition_id()))


def running_sum(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    out: str,
    slices: int | None = None,
    total: str | None = None,
) -> DataFrame:
    """Cumulative sum of value per key in the given order, current row included, and the key's
    whole sum if `total` names a column for it. Keys must not be NULL."""
    rows = sliced(df, keys, order, slices)
    totals = rows.groupBy(*keys, _SLICE).agg(F.sum(value).alias("_total"))
    before = W.partitionBy(*keys).orderBy(_SLICE).rowsBetween(W.unboundedPreceding, -1)
    whole = [F.sum("_total").over(W.partitionBy(*keys)).alias(total)] if total else []
    offsets = totals.select(
        *keys,
        _SLICE,
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"),
        *whole,
    )
    inside = (
        W.partitionBy(*keys, _SLICE)
        .orderBy(*order)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return (
        rows.withColumn(out, F.sum(value).over(inside))
        .join(offsets, keys + [_SLICE])
        .withColumn(out, F.col(out) + F.col("_before"))
        .drop("_before", _SLICE)
    )


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, levels: list[float], slices: int | None = None
) -> DataFrame:
    """Exact linearly interpolated quantiles per key: one row per key with an array in level order.

    Values are counted first, so copies collapse before the ordered pass; the ordered pass keeps
    only the two neighbours of every wanted position.
    """
    n, cum = "_n", "_cum"
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias(n))
    )
    ranked = running_sum(counts, keys, [value], n, cum, slices, total="_rows")
    targets = ", ".join(
        f"struct({i} AS level, {float(p)!r}D * (_rows - 1) AS at)" for i, p in enumerate(levels)
    )

    # each distinct value covers positions [_cum - _n, _cum)
    def covers(position: Column) -> Column:
        return (position >= F.col(cum) - F.col(n)) & (position < F.col(cum))

    low = F.floor("_hit.at")
    hits = (
        ranked.withColumn("_targets", F.expr(f"array({targets})"))
        .withColumn(
            "_hit",
            F.explode(
                F.filter(
                    "_targets",
                    lambda t: covers(F.floor(t["at"])) | covers(F.floor(t["at"]) + 1),
                )
            ),
        )
        .select(
            *keys,
            F.col("_hit.level").alias("_level"),
            (F.col("_hit.at") - low).alias("_share"),
            F.when(covers(low), F.col(value)).alias("_lo"),
            F.when(covers(low + 1), F.col(value)).alias("_hi"),
        )
    )
    per_level = hits.groupBy(*keys, "_level").agg(
        F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.max("_share").alias("_share")
    )
    point = F.col("_lo") + F.coalesce(F.col("_hi") - F.col("_lo"), F.lit(0.0)) * F.col("_share")
    return per_level.groupBy(*keys).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col("_level"), point.alias("q")))),
            lambda s: s["q"],
        ).alias("quantiles")
    )


def draw_rank(df: DataFrame, strata: list[str], key: str, seed: object, digits: int = 4) -> DataFrame:
    """0-based random rank of each row inside its stratum plus the stratum size (_rank, _size).

    The md5 draw is split by its leading hex digits; ranks are taken inside (stratum, digits) and
    shifted by the counts of the smaller prefixes, so one stratum is spread over many tasks.
    """
    rows = df.withColumn("_draw", S.draw(seed, F.col(key))).withColumn(
        "_cell", F.struct(*strata, F.substring("_draw", 1, digits).alias("_prefix"))
    )
    # struct keys compare NULL strata as equal, and window and join share one partitioning
    counts = rows.groupBy("_cell").agg(F.count(F.lit(1)).alias("_count"))
    stratum = W.partitionBy(*[F.col(f"_cell.{s}") for s in strata])
    before = stratum.orderBy("_cell._prefix").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "_cell",
        F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_before"),
        F.sum("_count").over(stratum).alias("_size"),
    )
    inside = W.partitionBy("_cell").orderBy("_draw", key)
    return (
        rows.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(offsets, "_cell")
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
        .drop("_draw", "_cell", "_before")
    )


def week_table(df: DataFrame, week: str = "su_week") -> DataFrame:
    """Distinct weeks with their 0-based position from the oldest and from the newest.

    One row per calendar week, so the single-partition window stays tiny."""
    weeks = df.select(week).where(F.col(week).isNotNull()).distinct()
    return weeks.withColumn(
        "_from_oldest", F.row_number().over(W.orderBy(F.col(week))) - 1
    ).withColumn("_from_newest", F.row_number().over(W.orderBy(F.col(week).desc())) - 1)


def four_week_bucket(df: DataFrame, week: str = "su_week", out: str = "month_group") -> DataFrame:
    """Label each week with the first week of its run of four."""
    weeks = week_table(df, week).withColumn(
        out,
        F.min(week).over(W.partitionBy(F.floor(F.col("_from_oldest") / 4))),
    )
    return df.join(F.broadcast(weeks.select(week, out)), week, "left")


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, out: str) -> DataFrame:
    """First k rows per key. k is small, so Spark drops the rest before the shuffle."""
    ranked = df.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(out) <= k)
