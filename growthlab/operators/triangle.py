"""Cohort-triangle operators on arrays: one slot per age, NULL where not observed.

Element-wise operators take and return Column expressions. Grouped ones take a frame of
(group, su_week, platform, traffic_type, values); that frame is already aggregated to one row
per cohort, so its size follows the calendar and the channel list, not the fact rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROW_ORDER = ["su_week", "platform", "traffic_type"]


def _empty() -> Column:
    return F.array().cast("array<double>")


def _at(arr: Column, i: Column) -> Column:
    """0-based element, NULL outside the array."""
    return F.get(arr, i)


def pack(df: DataFrame, prefix: str, ages: list[int], out: str) -> DataFrame:
    cols = [f"{prefix}{a}d" for a in ages]
    items = ", ".join(f"CAST({c} AS DOUBLE)" for c in cols)
    return df.withColumn(out, F.expr(f"array({items})")).drop(*cols)


def unpack(df: DataFrame, arr: str, prefix: str, ages: list[int]) -> DataFrame:
    rest = [f"`{c}`" for c in df.columns if c != arr]
    return df.selectExpr(*rest, *[f"get({arr}, {i}) AS {prefix}{a}d" for i, a in enumerate(ages)])


# ---------------------------------------------------------------- masks


def keep_first(arr: Column, count: Column) -> Column:
    """NULL every slot from position `count` on."""
    return F.transform(arr, lambda x, i: F.when(i < count, x))


def weeks_behind(week: Column, anchor: Column) -> Column:
    return F.floor(F.datediff(anchor, week) / 7)


def kept_relative(weeks: Column) -> Column:
    """Slots kept when the newest cohort keeps one and each older week one more."""
    return weeks + 1


def kept_by_run_date(weeks: Column) -> Column:
    """Slots kept counted from the run date; the cost column holds the first place."""
    total = F.when(weeks < 3, F.lit(2)).when(weeks < 4, F.lit(3)).otherwise(weeks)
    return total - 1


def mask_relative(df: DataFrame, arr: str = "values", week: str = "su_week") -> DataFrame:
    """Maturity mask against the newest week in the data."""
    # a cohort table has one row per week and channel, small enough for one window
    newest = F.max(week).over(W.partitionBy())
    keep = kept_relative(weeks_behind(F.col(week), newest))
    return (
        df.withColumn("_keep", keep)
        .withColumn(arr, keep_first(F.col(arr), F.col("_keep")))
        .drop("_keep")
    )


def mask_by_run_date(df: DataFrame, as_of: str, arr: str = "values", week: str = "su_week") -> DataFrame:
    keep = kept_by_run_date(weeks_behind(F.col(week), F.lit(as_of).cast("date")))
    return df.withColumn(arr, keep_first(F.col(arr), keep))


def mask_by_rank(df: DataFrame, weeks: DataFrame, arr: str = "values", week: str = "su_week") -> DataFrame:
    """Mask by the cohort's place from the newest (0-based _from_newest). The first age always
    stays; the newest cohort keeps one more, the next two more."""
    joined = df.join(F.broadcast(weeks.select(week, "_from_newest")), week, "left")
    return joined.withColumn(arr, keep_first(F.col(arr), F.col("_from_newest") + 2)).drop(
        "_from_newest"
    )


def null_zeros(arr: Column) -> Column:
    return F.transform(arr, lambda x: F.nullif(x, F.lit(0.0)))


# ---------------------------------------------------------------- growth and shape


def growth(arr: Column) -> Column:
    """Change against the age before; gaps are carried forward and zero growth becomes NULL."""
    start = F.struct(F.lit(None).cast("double").alias("prev"), _empty().alias("out"))

    def step(acc: Column, x: Column) -> Column:
        now = F.coalesce(x, acc["prev"])
        rate = F.nullif(F.try_divide(now, acc["prev"]) - 1, F.lit(0.0))
        return F.struct(now.alias("prev"), F.concat(acc["out"], F.array(rate)).alias("out"))

    return F.aggregate(arr, start, step, lambda acc: acc["out"])


def drop_plateaus(arr: Column) -> Column:
    """NULL a value already seen at an earlier age, from the second age on."""
    return F.transform(
        arr,
        lambda x, i: F.when(
            (i == 0) | ~F.coalesce(F.array_contains(F.slice(arr, 2, F.greatest(i - 1, F.lit(0))), x), F.lit(False)),
            x,
        ),
    )


def back_raise(arr: Column) -> Column:
    """Raise each value to its right neighbour where that is larger."""
    return F.transform(
        arr, lambda x, i: F.when(_at(arr, i + 1) > x, _at(arr, i + 1)).otherwise(x)
    )


def cap_rising(arr: Column, start: int) -> Column:
    """From position `start` on no value may exceed the one before it; a NULL restarts the cap."""
    tail = F.aggregate(
        F.slice(arr, start + 1, F.greatest(F.size(arr) - start, F.lit(0))),
        _empty(),
        lambda acc, x: F.concat(
            acc,
            F.array(
                F.when(
                    x > F.try_element_at(acc, F.lit(-1)), F.try_element_at(acc, F.lit(-1))
                ).otherwise(x)
            ),
        ),
    )
    return F.concat(F.slice(arr, 1, start), tail)


# ---------------------------------------------------------------- exposure


def exposure(users: DataFrame, arr: str = "users_cum") -> DataFrame:
    """Largest cumulative user count per (group, week) and age."""
    return _array_agg(users, ["group", "su_week"], arr, F.max, "exposure")


def mask_exposure(df: DataFrame, exposed: DataFrame, threshold: float, arr: str = "values") -> DataFrame:
    """NULL growth at ages where no row of the same group and week has enough users."""
    joined = df.join(exposed, ["group", "su_week"], "left")
    return joined.withColumn(
        arr,
        F.when(
            F.col("exposure").isNull(), F.col(arr)
        ).otherwise(
            F.zip_with(arr, "exposure", lambda x, n: F.when(n > F.lit(threshold), x))
        ),
    )


def omitted_cells(
    df: DataFrame, exposed: DataFrame, ages: list[int], threshold: float, arr: str = "values"
) -> DataFrame:
    """The cells mask_exposure blanks, with their value and user count."""
    cells = df.join(exposed, ["group", "su_week"]).select(
        "group",
        *ROW_ORDER,
        F.posexplode(
            F.zip_with(
                arr, "exposure", lambda x, n: F.struct(x.alias("value"), n.alias("users"))
            )
        ).alias("_i", "cell"),
    )
    return cells.where(~F.coalesce(F.col("cell.users") > threshold, F.lit(False))).select(
        "group",
        *ROW_ORDER,
        _age_label(F.col("_i"), ages).alias("age"),
        F.col("cell.value").alias("original_value"),
        F.col("cell.users").alias("users_count"),
    )


def _age_label(i: Column, ages: list[int]) -> Column:
    return F.get(F.array(*[F.lit(a) for a in ages]), i)


# ---------------------------------------------------------------- grouped statistics


def _array_agg(df: DataFrame, keys: list[str], arr: str, fn, out: str, size: int | None = None) -> DataFrame:
    """Slot-wise aggregate through (key, position) so any array length works."""
    long = df.select(*keys, F.posexplode(arr).alias("_i", "_v"))
    return (
        long.groupBy(*keys, "_i")
        .agg(fn("_v").alias("_v"))
        .groupBy(*keys)
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("_i", "_v"))), lambda s: s["_v"]
            ).alias(out)
        )
    )


def _bounds(df: DataFrame, k: float, least: int, arr: str) -> DataFrame:
    """Quartile bounds per (group, age) over the cohort rows."""
    long = df.select("group", F.posexplode(arr).alias("_i", "_v"))
    q = F.percentile("_v", F.array(F.lit(0.25), F.lit(0.75)))
    enough = F.count("_v") >= least
    stats = long.groupBy("group", "_i").agg(F.when(enough, q).alias("_q"))
    iqr = F.col("_q")[1] - F.col("_q")[0]
    return stats.select(
        "group",
        "_i",
        (F.col("_q")[0] - k * iqr).alias("low"),
        (F.col("_q")[1] + k * iqr).alias("high"),
    )


def winsorise(df: DataFrame, k: float = 1.0, least: int = 4, arr: str = "values") -> DataFrame:
    """Clip each (group, age) to its quartile bounds; groups with fewer values stay as they are."""
    limits = (
        _bounds(df, k, least, arr)
        .groupBy("group")
        .agg(
            F.array_sort(F.collect_list(F.struct("_i", "low", "high"))).alias("_limits")
        )
    )

    def bounded(x: Column, b: Column) -> Column:
        return (
            F.when(x < b["low"], b["low"]).when(x > b["high"], b["high"]).otherwise(x)
        )

    return (
        df.join(limits, "group", "left")
        .withColumn(arr, F.zip_with(arr, "_limits", bounded))
        .drop("_limits")
    )


def winsor_report(df: DataFrame, ages: list[int], k: float = 1.0, least: int = 4, arr: str = "values") -> DataFrame:
    """Per (group, age) with outliers: bounds, counts and the original values."""
    long = df.select("group", *ROW_ORDER, F.posexplode(arr).alias("_i", "_v"))
    joined = long.join(_bounds(df, k, least, arr), ["group", "_i"])
    below, above = F.col("_v") < F.col("low"), F.col("_v") > F.col("high")
    return (
        joined.groupBy("group", "_i", "low", "high")
        .agg(
            F.count_if(below).alias("below_count"),
            F.count_if(above).alias("above_count"),
            F.sort_array(F.collect_list(F.when(below, F.col("_v")))).alias("below_original"),
            F.sort_array(F.collect_list(F.when(above, F.col("_v")))).alias("above_original"),
        )
        .where(F.col("below_count") + F.col("above_count") > 0)
        .withColumn("total_outliers", F.col("below_count") + F.col("above_count"))
        .withColumn("age", _age_label(F.col("_i"), ages))
        .withColumnsRenamed({"low": "lower_bound", "high": "upper_bound"})
        .drop("_i")
    )


def peer_fill(df: DataFrame, peer: Column, arr: str = "values") -> DataFrame:
    """Fill missing growth of classed channels with the class mean of the week, else the mean of
    all channels that week."""
    classed = df.withColumn("_class", peer)
    by_class = _array_agg(
        classed.where(F.col("_class").isNotNull()), ["_class", "su_week"], arr, F.avg, "_near"
    )
    by_week = _array_agg(df, ["su_week"], arr, F.avg, "_far")
    joined = classed.join(by_class, ["_class", "su_week"], "left").join(
        by_week, "su_week", "left"
    )
    fill = F.transform(
        F.col(arr),
        lambda x, i: F.coalesce(x, _at(F.col("_near"), i), _at(F.col("_far"), i)),
    )
    return joined.withColumn(
        arr, F.when(F.col("_class").isNotNull(), fill).otherwise(F.col(arr))
    ).drop("_class", "_near", "_far")


def recency_all(df: DataFrame, arr: str = "values") -> DataFrame:
    """Mean per (group, age) over all rows with weights rising to the newest; NULLs add nothing
    and the weights are not rescaled for them."""
    w = W.partitionBy("group").orderBy(*ROW_ORDER)
    n = F.count(F.lit(1)).over(W.partitionBy("group"))
    place = F.row_number().over(w) - 1
    rows = df.select(
        "group", arr, F.exp(F.coalesce(F.try_divide(place, n - 1), F.lit(0.0))).alias("_w")
    )
    long = rows.select("group", "_w", F.posexplode(arr).alias("_i", "_v"))
    return _back_to_arrays(
        long.groupBy("group", "_i").agg(
            (
                F.coalesce(F.sum(F.col("_v") * F.col("_w")), F.lit(0.0)) / F.sum("_w")
            ).alias("_v")
        ),
        arr,
    )


def recency_last(df: DataFrame, depth: list[int], arr: str = "values") -> DataFrame:
    """Mean per (group, age) over the last `depth[age]` observed values, newest weighted most."""
    long = df.select("group", *ROW_ORDER, F.posexplode(arr).alias("_i", "_v"))
    slots = W.partitionBy("group", "_i")
    newest = slots.orderBy(F.col("_v").isNull(), *[F.desc(c) for c in ROW_ORDER])
    ranked = long.withColumn("_back", F.row_number().over(newest)).withColumn(
        "_n",
        F.least(F.count("_v").over(slots), F.get(F.array(*[F.lit(d) for d in depth]), F.col("_i"))),
    )
    used = F.col("_v").isNotNull() & (F.col("_back") <= F.col("_n"))
    weight = F.exp(
        F.coalesce(F.try_divide(F.col("_n") - F.col("_back"), F.col("_n") - 1), F.lit(0.0))
    )
    return _back_to_arrays(
        ranked.groupBy("group", "_i").agg(
            F.try_divide(
                F.sum(F.when(used, F.col("_v") * weight)), F.sum(F.when(used, weight))
            ).alias("_v")
        ),
        arr,
    )


def _back_to_arrays(long: DataFrame, arr: str) -> DataFrame:
    return long.groupBy("group").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_i", "_v"))), lambda s: s["_v"]
        ).alias(arr)
    )


# ---------------------------------------------------------------- multipliers


def with_overall(df: DataFrame, slots: int, arr: str = "values") -> DataFrame:
    """Add the row of column means; its group is NULL. One pass: a group's own mean is itself."""
    means = ", ".join(f"avg(get({arr}, {i}))" for i in range(slots))
    return df.rollup("group").agg(F.expr(f"array({means})").alias(arr))


def _column_means(slots: int, arr: str, least: float | None = None) -> Column:
    """Means of the values from `least` up over the whole multiplier table: one row per channel
    group plus the overall row."""
    kept = [f"get({arr}, {i})" for i in range(slots)]
    if least is not None:
        kept = [f"CASE WHEN {c} >= {least} THEN {c} END" for c in kept]
    return F.expr("array(" + ", ".join(f"avg({c}) OVER ()" for c in kept) + ")")


def repair_low(df: DataFrame, slots: int, least: float = 0.03, arr: str = "values") -> DataFrame:
    """Growth under the floor becomes the mean of the column's other values."""
    means = _column_means(slots, arr, least)
    return (
        df.withColumn("_means", means)
        .withColumn(
            arr, F.zip_with(arr, "_means", lambda x, m: F.when(x < least, m).otherwise(x))
        )
        .drop("_means")
    )


def to_multiplier(arr: Column) -> Column:
    return F.transform(arr, lambda x: x + 1)


def fill_column_mean(df: DataFrame, slots: int, start: int = 2, arr: str = "values") -> DataFrame:
    """Fill missing multipliers with the column mean from position `start` on."""
    means = _column_means(slots, arr)
    return (
        df.withColumn("_means", means)
        .withColumn(
            arr,
            F.transform(
                F.col(arr),
                lambda x, i: F.when(i >= start, F.coalesce(x, _at(F.col("_means"), i))).otherwise(x),
            ),
        )
        .drop("_means")
    )


OVERALL = "mean_overall"


def as_map(multipliers: DataFrame, arr: str = "values") -> Column:
    """The multiplier table as one map value: channel groups are a fixed short list."""
    entry = F.struct(F.coalesce("group", F.lit(OVERALL)).alias("k"), F.col(arr).alias("v"))
    return multipliers.agg(F.map_from_entries(F.collect_list(entry)).alias("m")).scalar()


def pick(multipliers: Column, group: Column, fallback: bool = True) -> Column:
    """The group's multipliers, else the overall row."""
    own = F.try_element_at(multipliers, group)
    if not fallback:
        return own
    return F.coalesce(own, F.try_element_at(multipliers, F.lit(OVERALL)))


def fill_slots(arr: Column, spare: Column) -> Column:
    return F.zip_with(arr, spare, lambda x, y: F.coalesce(x, y))


# ---------------------------------------------------------------- projection


def chain_ladder(values: Column, multipliers: Column) -> Column:
    """Fill each missing age from the one before times the multiplier; leading gaps stay."""
    pairs = F.zip_with(
        values, multipliers, lambda v, m: F.struct(v.alias("v"), m.alias("m"))
    )
    return F.aggregate(
        pairs,
        _empty(),
        lambda acc, p: F.concat(
            acc,
            F.array(F.coalesce(p["v"], F.try_element_at(acc, F.lit(-1)) * p["m"])),
        ),
    )


def breakeven_targets(cost: str, multipliers: str, ages: list[int], last: int = 63) -> dict[int, Column]:
    """Revenue needed at each age so that growth reaches the cost at `last` days, from the names
    of the cost and the multiplier-array columns."""
    wanted = [a for a in ages if a < last]
    final = ages.index(last)
    out = {}
    for i, age in enumerate(wanted):
        product = " * ".join(f"get({multipliers}, {j})" for j in range(final, i, -1))
        out[age] = F.expr(f"try_divide({cost}, {product})")
    return out


def above_mean_rows(df: DataFrame, volume: str = "total_users") -> DataFrame:
    return df.where(F.col(volume) > df.agg(F.avg(volume).alias("m")).scalar())


def frequent_groups(df: DataFrame, k: int = 21) -> DataFrame:
    """The k groups with most rows, ties by name."""
    return (
        df.groupBy("group").count().orderBy(F.desc("count"), "group").limit(k).select("group")
    )
