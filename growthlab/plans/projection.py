"""Weekly cohort revenue projection and break-even targets, and the matching actuals table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthlab.functions import scalars as S
from growthlab.functions import sums as A
from growthlab.functions.channels import CORE_CHANNELS, WIDE_CHANNELS, channel_group, peer_class
from growthlab.operators import cleaning as C
from growthlab.operators import ordered as O
from growthlab.operators import triangle as R
from growthlab.session import durable

KEYS = ["su_week", "group", "platform", "traffic_type"]

# How many of the newest growth rates enter the mean, for ages 14d, 21d, ...; 3 after.
PROD_DEPTH = [9, 8, 7, 6, 5, 5, 4, 4]
V2_DEPTH = [10, 10, 8, 8, 6, 6, 4, 4]


def depth_for(slots: int, listed: list[int]) -> list[int]:
    """Depth per array slot; the first age has no growth rate and takes the default."""
    tail = 3
    full = [tail] + listed + [tail] * slots
    return full[:slots]


@dataclass(frozen=True)
class Variant:
    """What differs between the published versions of the projection."""

    channels: list[str] = field(default_factory=lambda: list(CORE_CHANNELS))
    merge_traffic: bool = False
    large_rows_only: bool = True
    plateaus: bool = True
    mask_by_run_date: bool = True
    exposure_users: float | None = None
    winsor_k: float = 1.5
    winsor_least: int = 1
    peer_fill: bool = False
    depth: list[int] | None = None
    back_raise: bool = False
    early_cap: int | None = None
    final_cap: int | None = None
    fill_targets: bool = False
    ages: list[int] = field(default_factory=lambda: list(range(7, 141, 7)))


V11 = Variant(channels=list(WIDE_CHANNELS), back_raise=True, fill_targets=True)
V2 = Variant(channels=list(WIDE_CHANNELS), depth=V2_DEPTH, back_raise=True, final_cap=1)
PROD = Variant(
    merge_traffic=True,
    large_rows_only=False,
    plateaus=False,
    mask_by_run_date=False,
    exposure_users=50,
    winsor_k=1.0,
    winsor_least=4,
    peer_fill=True,
    depth=PROD_DEPTH,
    early_cap=2,
    final_cap=1,
    ages=list(range(7, 92, 7)),
)


def _measures(df: DataFrame) -> list[str]:
    keys = {"su_week", "channel_type_con", "platform", "traffic_type", "group"}
    return [c for c in df.columns if c not in keys]


def _kinds(*keys: str) -> Column:
    """Distinct traffic types per key. The input has one row per cohort, so a key's window holds
    weeks x platforms x traffic types."""
    return F.size(F.collect_set("traffic_type").over(W.partitionBy(*keys)))


def merge_traffic(df: DataFrame) -> DataFrame:
    """Channels seen with both traffic types become paid; their rows are summed (NULL keys drop)."""
    keys = ["su_week", "channel_type_con", "platform", "traffic_type"]
    both = _kinds("channel_type_con") == 2
    return (
        df.where(F.col("channel_type_con").isNotNull())
        .withColumn("_both", both)
        .withColumn(
            "traffic_type", F.when(F.col("_both"), F.lit("paid")).otherwise(F.col("traffic_type"))
        )
        .drop("_both")
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(*A.sums(_measures(df), "zero"))
    )


def classify(df: DataFrame, channels: list[str]) -> DataFrame:
    """Channel group, traffic by cost, app platform, mixed groups counted as paid."""
    cost = F.col("total_costs")
    named = (
        df.where(F.col("channel_type_con").isNotNull())
        .withColumn("group", channel_group(F.col("channel_type_con"), channels))
        .withColumn(
            "traffic_type",
            F.when(cost == 0, "organic").when(cost > 0, "paid").otherwise(F.col("traffic_type")),
        )
        .withColumn(
            "platform", F.when(F.col("group").contains("_app"), "app").otherwise(F.col("platform"))
        )
    )
    mixed = (F.col("_kinds") > 1) & (F.col("group") != "other")
    return (
        named.withColumn("_kinds", _kinds("su_week", "group"))
        .withColumn(
            "traffic_type", F.when(mixed, F.lit("paid")).otherwise(F.col("traffic_type"))
        )
        .drop("_kinds")
    )


def regroup(df: DataFrame, nulls: str, extra: list[str], ages: list[int]) -> DataFrame:
    """Sums per cohort; nulls says what a NULL cell does to its sum."""
    cols = extra + [f"interval_{a}d" for a in ages]
    return df.dropna(subset=KEYS).groupBy(*KEYS).agg(*A.sums(cols, nulls))


def _masked(df: DataFrame, variant: Variant, as_of: str, arr: str = "values") -> DataFrame:
    if variant.mask_by_run_date:
        return R.mask_by_run_date(df, as_of, arr)
    return R.mask_relative(df, arr)


def multiplier_table(rates: DataFrame, variant: Variant) -> DataFrame:
    """Growth rates -> one multiplier array per channel group plus the overall row (NULL group)."""
    slots = len(variant.ages)
    clipped = R.winsorise(rates, variant.winsor_k, variant.winsor_least)
    if variant.peer_fill:
        clipped = R.peer_fill(clipped, peer_class(F.col("group")))
    if variant.depth is None:
        table = R.recency_all(clipped)
    else:
        table = R.recency_last(clipped, depth_for(slots, variant.depth))
    arr = F.col("values")
    if variant.back_raise:
        table = table.withColumn("values", R.back_raise(arr))
    if variant.early_cap is not None:
        table = table.withColumn("values", R.cap_rising(arr, variant.early_cap))
    table = R.repair_low(R.with_overall(table, slots), slots)
    table = R.fill_column_mean(table.withColumn("values", R.to_multiplier(arr)), slots)
    if variant.final_cap is not None:
        table = table.withColumn("values", R.cap_rising(arr, variant.final_cap))
    return table


def cohort_values(
    source: DataFrame, variant: Variant, as_of: str
) -> tuple[DataFrame, DataFrame]:
    """(rows to project, growth rates) as arrays per cohort.

    The classified cohort table is checkpointed: it is calendar-sized, and both results start
    from it, so the facts are read once."""
    ages = variant.ages
    df = source.withColumn("su_week", F.to_date("su_week"))
    if variant.merge_traffic:
        df = merge_traffic(df)
    df = durable(classify(C.completed_weeks(df, as_of), variant.channels))

    if not variant.large_rows_only:
        cum = [f"users_cum_{a}d" for a in ages]
        rows = regroup(df, "zero", ["total_costs"] + cum, ages)
        rows = R.pack(R.pack(rows, "interval_", ages, "values"), "users_cum_", ages, "users_cum")
        rows = _masked(_masked(rows, variant, as_of), variant, as_of, "users_cum")
        rates = rows.withColumn("values", R.growth(F.col("values")))
        if variant.exposure_users is not None:
            rates = R.mask_exposure(rates, R.exposure(rows), variant.exposure_users)
        return rows.drop("users_cum"), rates

    large = R.above_mean_rows(df)
    large = large.join(R.frequent_groups(large), "group", "left_semi")
    basis = R.pack(regroup(large, "null", [], ages), "interval_", ages, "values")
    rates = _masked(basis, variant, as_of).withColumn("values", R.growth(F.col("values")))
    rows = R.pack(
        regroup(df, "strict", ["total_costs"], ages), "interval_", ages, "values"
    )
    if variant.plateaus:
        rows = rows.withColumn("values", R.drop_plateaus(F.col("values")))
    return _masked(rows, variant, as_of), rates


def _whole(col: Column) -> Column:
    return S.half_even(col).cast("bigint")


def project(source: DataFrame, variant: Variant, as_of: str) -> DataFrame:
    """Projected revenue per age and break-even targets for every complete cohort row.

    The last age only feeds the growth rates and is dropped from the published table."""
    ages = variant.ages
    rows, rates = cohort_values(source, variant, as_of)
    # a dozen rows; checkpointed so that their lineage is not repeated in every use
    table = R.as_map(durable(multiplier_table(rates, variant)))
    published = ages[:-1]
    group = F.col("group")
    projected = (
        rows.withColumn("_table", table)
        .withColumn("_mult", R.pick(F.col("_table"), group))
        .withColumn("_own", R.pick(F.col("_table"), group, fallback=variant.fill_targets))
        .withColumn("values", R.chain_ladder(F.col("values"), F.col("_mult")))
    )
    if variant.fill_targets:
        overall = F.try_element_at(F.col("_table"), F.lit(R.OVERALL))
        projected = projected.withColumn("_own", R.fill_slots(F.col("_own"), overall))
    targets = R.breakeven_targets("total_costs", "_own", ages)
    kept = projected.where(F.get("values", F.lit(0)) != 0).where(
        F.col("total_costs").isNotNull()
        & ~F.exists(F.slice("values", 1, len(published)), lambda x: x.isNull())
    )
    shaped = kept.select(
        F.col("group").alias("channel_group"),
        "su_week",
        "platform",
        "traffic_type",
        "total_costs",
        *[_whole(c).alias(f"target_{a}d") for a, c in targets.items()],
        *[
            F.expr(f"CAST(rint(get(values, {i})) AS BIGINT) AS prediction_{a}d")
            for i, a in enumerate(published)
        ],
    )
    bucketed = O.four_week_bucket(durable(shaped))
    stamped = C.stamp(
        bucketed.select(*shaped.columns, "month_group"), as_of
    ).withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm"))
    return C.place_column(stamped, "month_group", 2)


def actuals(source: DataFrame, ages: list[int], as_of: str) -> DataFrame:
    """Observed revenue per age, blanked by cohort age, no projection."""
    df = merge_traffic(source.withColumn("su_week", F.to_date("su_week")))
    df = classify(df, CORE_CHANNELS)
    packed = R.pack(df, "interval_", ages, "values").withColumn(
        "values", R.null_zeros(F.col("values"))
    )
    wide = R.unpack(packed, "values", "interval_", ages)
    rows = durable(
        R.pack(regroup(wide, "null", ["total_costs"], ages), "interval_", ages, "values")
    )
    rows = R.mask_by_rank(rows, O.week_table(rows))
    shaped = R.unpack(O.four_week_bucket(rows), "values", "actual_", ages).select(
        F.col("group").alias("channel_group"),
        "su_week",
        "month_group",
        "platform",
        "traffic_type",
        "total_costs",
        *[f"actual_{a}d" for a in ages],
    )
    return C.stamp(shaped, as_of).withColumn(
        "updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm")
    )
