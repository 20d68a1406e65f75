"""Daily channel report: signup conversion, day-0 ROAS, yesterday against the 7-day average."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthlab.functions import scalars as S
from growthlab.operators import joins as J
from growthlab.operators.cleaning import trailing
from growthlab.operators.ordered import top_per_group
from growthlab.session import durable

CHANNEL_KEYS = ["su_date", "platform", "channel", "channel_type", "channel_agg"]
METRICS = [
    "total_signups",
    "day0_conversions",
    "conversion_rate",
    "total_users",
    "paid_users",
    "d0_purchase_count",
    "d0_total_amount",
    "total_cost",
    "roas_d0",
]
COUNTS = ["total_signups", "day0_conversions", "total_users", "paid_users", "d0_purchase_count"]


def _channel_columns(df: DataFrame) -> DataFrame:
    label = S.channel_label(F.col("platform"), F.col("channel"), F.col("channel_type"))
    return df.withColumn("channel_agg", label).withColumn(
        "platform", F.lower(F.coalesce("platform", F.lit("unknown")))
    )


def _recent_signups(profile: DataFrame, touches: DataFrame, as_of: str) -> DataFrame:
    recent = profile.where(trailing(F.to_date("signup_date"), as_of, 8, 1))
    cols = ["user_id", "channel", "channel_type", "platform"]
    return _channel_columns(
        recent.join(touches.select(*cols), "user_id", "left").withColumn(
            "su_date", F.to_date("signup_date")
        )
    )


def signup_conversion(profile: DataFrame, touches: DataFrame, as_of: str) -> DataFrame:
    """Signups and same-day conversions per day and channel over the last eight days."""
    converted = F.count_if(F.col("su_date") == F.to_date("first_purchase_date"))
    return (
        _recent_signups(profile, touches, as_of)
        .groupBy(*CHANNEL_KEYS)
        .agg(F.count("user_id").alias("total_signups"), converted.alias("day0_conversions"))
        .withColumn(
            "conversion_rate",
            S.half_up(S.safe_div(F.col("day0_conversions"), F.col("total_signups")) * 100, 2),
        )
    )


def day0_roas(
    profile: DataFrame,
    purchase_days: DataFrame,
    touches: DataFrame,
    as_of: str,
    distinct_users: bool = False,
) -> DataFrame:
    """Signup-day purchases per day and channel.

    The published query joins purchases row by row, so a user with n purchases counts n times;
    the daily roll-up gives the same counts without the fan-out. distinct_users counts each once."""
    signups = _recent_signups(profile, touches, as_of)
    day0 = purchase_days.select(
        "user_id", F.col("purchase_date").alias("su_date"), "purchases", "amount"
    )
    n = F.coalesce(F.col("purchases"), F.lit(0))
    users = F.count(F.lit(1)) if distinct_users else F.sum(F.greatest(n, F.lit(1)))
    paid = F.count("purchases") if distinct_users else F.sum(n)
    return (
        signups.join(day0, ["user_id", "su_date"], "left")
        .groupBy(*CHANNEL_KEYS)
        .agg(
            users.alias("total_users"),
            paid.alias("paid_users"),
            F.sum(n).alias("d0_purchase_count"),
            F.sum("amount").alias("d0_total_amount"),
        )
    )


def daily_costs(costs: DataFrame, as_of: str) -> DataFrame:
    recent = _channel_columns(costs.where(trailing(F.col("day"), as_of, 8, 1)))
    return recent.groupBy("day", "platform", "channel", "channel_type", "channel_agg").agg(
        F.sum("cost").alias("cost")
    )


def funnel(profile: DataFrame, purchase_days: DataFrame, touches: DataFrame, as_of: str) -> DataFrame:
    """signup_conversion and day0_roas side by side from one pass over the signups: a signup meets at most one row of
    the (user, day) roll-up, so one aggregate counts both sides."""
    day0 = purchase_days.select("user_id", F.col("purchase_date").alias("su_date"), "purchases", "amount")
    n = F.coalesce(F.col("purchases"), F.lit(0))
    converted = F.count_if(F.col("su_date") == F.to_date("first_purchase_date"))
    return (
        _recent_signups(profile, touches, as_of)
        .join(day0, ["user_id", "su_date"], "left")
        .groupBy(*CHANNEL_KEYS)
        .agg(
            F.count("user_id").alias("total_signups"),
            converted.alias("day0_conversions"),
            F.sum(F.greatest(n, F.lit(1))).alias("total_users"),
            F.sum(n).alias("paid_users"),
            F.sum(n).alias("d0_purchase_count"),
            F.sum("amount").alias("d0_total_amount"),
        )
        .withColumn(
            "conversion_rate",
            S.half_up(S.safe_div(F.col("day0_conversions"), F.col("total_signups")) * 100, 2),
        )
    )


def combined_daily_summary(signups: DataFrame, roas: DataFrame, costs: DataFrame) -> DataFrame:
    """Both sides of the funnel on the same keys (NULL channels meet), with channel cost."""
    return with_costs(J.null_safe_join(signups, roas, CHANNEL_KEYS, "full"), costs)


def with_costs(both: DataFrame, costs: DataFrame) -> DataFrame:
    """The funnel with its channel's cost of the day and the return on it."""
    spend = costs.groupBy(F.col("day").alias("su_date"), "platform", "channel_agg").agg(
        F.sum("cost").alias("_cost")
    )
    rate = F.when(
        F.col("_cost") > 0, S.safe_div(F.col("d0_total_amount"), F.col("_cost")) * 100
    ).otherwise(F.lit(0.0))
    zero = ["conversion_rate", "d0_total_amount"] + COUNTS
    return (
        both.join(spend, ["su_date", "platform", "channel_agg"], "left")
        .withColumn("roas_d0", rate)
        .withColumn("total_cost", F.coalesce("_cost", F.lit(0.0)))
        .drop("_cost")
        .fillna(0, zero)
        .select(*CHANNEL_KEYS, *METRICS)
    )


def _by_segment(summary: DataFrame, costs: DataFrame) -> DataFrame:
    """Day totals overall and by platform from one grouping-sets pass, costs at the same grain."""
    sums = summary.groupingSets(
        [["su_date"], ["su_date", "platform"]], "su_date", "platform"
    ).agg(
        F.grouping("platform").alias("_all"),
        *[F.sum(c).alias(c) for c in COUNTS + ["d0_total_amount"]],
    )
    spend = costs.groupingSets([["day"], ["day", "platform"]], "day", "platform").agg(
        F.grouping("platform").alias("_all"), F.sum("cost").alias("_cost")
    )
    keyed = J.null_safe_join(
        sums, spend.withColumnRenamed("day", "su_date"), ["su_date", "platform", "_all"], "left"
    )
    return (
        keyed.withColumn("segment", F.when(F.col("_all") == 1, "Overall").otherwise("Platform"))
        .withColumn("platform", F.when(F.col("_all") == 1, "").otherwise(F.col("platform")))
        .withColumn("channel_agg", F.lit(""))
        .withColumn(
            "_rate", S.safe_div(F.col("day0_conversions"), F.col("total_signups")) * 100
        )
        .withColumn(
            "roas_d0",
            F.when(F.col("_cost") > 0, S.safe_div(F.col("d0_total_amount"), F.col("_cost")) * 100)
            .otherwise(F.lit(0.0)),
        )
        .withColumn("total_cost", F.coalesce("_cost", F.lit(0.0)))
    )


def _averages(rows: DataFrame, keys: list[str]) -> DataFrame:
    whole = COUNTS + ["d0_total_amount", "total_cost"]
    return rows.groupBy(*keys).agg(
        *[S.half_up(F.avg(c)).alias(c) for c in whole],
        S.half_up(F.avg("_rate"), 2).alias("conversion_rate"),
        S.half_up(F.avg("roas_d0"), 3).alias("roas_d0"),
    )


def _report_columns(df: DataFrame, period: str) -> DataFrame:
    return (
        df.withColumn("period", F.lit(period))
        .select(
            "period",
            "segment",
            "platform",
            "channel_agg",
            *[F.col(m).cast("double").alias(m) for m in METRICS],
        )
        .fillna(0.0, METRICS)
    )


def overall_platform_report(summary: DataFrame, costs: DataFrame, as_of: str) -> DataFrame:
    """Yesterday and the seven days before it, overall and per platform."""
    rows = _by_segment(summary, costs)
    yesterday = rows.where(trailing(F.col("su_date"), as_of, 1, 1)).withColumn(
        "conversion_rate", S.half_up(F.col("_rate"), 2)
    )
    week = _averages(
        rows.where(trailing(F.col("su_date"), as_of, 8, 2)),
        ["segment", "platform", "channel_agg"],
    )
    return _report_columns(yesterday, "Yesterday").unionByName(
        _report_columns(week, "7-Day Avg")
    )


def _rank_order() -> list:
    return [
        F.desc("total_signups"),
        F.asc("channel_agg"),
        F.asc_nulls_first("channel"),
        F.asc_nulls_first("channel_type"),
    ]


def top_channels(summary: DataFrame, as_of: str, first: int, last: int, k: int) -> DataFrame:
    """Top k channels by signups per platform between as_of - first and as_of - last days."""
    volume = (
        summary.where(trailing(F.col("su_date"), as_of, first, last))
        .where(F.col("channel_agg").isNotNull() & (F.col("channel_agg") != "unknown"))
        .groupBy("platform", "channel_agg", "channel", "channel_type")
        .agg(F.sum("total_signups").alias("total_signups"))
    )
    return top_per_group(volume, ["platform"], _rank_order(), k, "platform_rank")


def top_channels_yesterday(summary: DataFrame, as_of: str, k: int = 5) -> DataFrame:
    rows = summary.where(trailing(F.col("su_date"), as_of, 1, 1)).where(
        F.col("channel_agg").isNotNull() & (F.col("channel_agg") != "unknown")
    )
    ranked = top_per_group(rows, ["platform"], _rank_order(), k, "_rank")
    return _report_columns(
        ranked.withColumn("segment", F.lit(f"Top {k} Channels")).withColumn(
            "conversion_rate", F.round("conversion_rate", 2)
        ),
        "Yesterday",
    )


def top_channels_week(summary: DataFrame, as_of: str, k: int = 12) -> DataFrame:
    """Seven-day averages of the top channels; rows with a NULL channel drop out of the match."""
    top = top_channels(summary, as_of, 8, 2, k).select(
        F.col("platform").alias("t_platform"),
        F.col("channel").alias("t_channel"),
        F.col("channel_type").alias("t_type"),
        F.col("channel_agg").alias("t_agg"),
    )
    daily = (
        summary.where(trailing(F.col("su_date"), as_of, 8, 2))
        .withColumn(
            "_rate", S.safe_div(F.col("day0_conversions"), F.col("total_signups")) * 100
        )
    )
    joined = top.join(
        daily,
        (F.col("t_platform") == F.col("platform"))
        & (F.col("t_channel") == F.col("channel"))
        & F.col("t_type").eqNullSafe(F.col("channel_type")),
    ).select(
        F.col("t_platform").alias("platform"),
        F.col("t_agg").alias("channel_agg"),
        *COUNTS,
        "d0_total_amount",
        "total_cost",
        "_rate",
        "roas_d0",
    )
    week = _averages(joined, ["platform", "channel_agg"])
    return _report_columns(
        week.withColumn("segment", F.lit(f"Top {k} Channels")), "7-Day Avg"
    )


def ordered_report(report: DataFrame) -> DataFrame:
    period = F.when(F.col("period") == "Yesterday", 1).when(F.col("period") == "7-Day Avg", 2)
    segment = F.when(F.col("segment") == "Overall", 1).when(F.col("segment") == "Platform", 2)
    return report.orderBy(
        period.otherwise(3), segment.otherwise(3), "platform", F.desc("total_signups")
    )


def daily_marketing_report(
    profile: DataFrame, purchase_days: DataFrame, touches: DataFrame, costs: DataFrame, as_of: str
) -> DataFrame:
    """The whole report. The summary and the spend have one row per day and channel and feed every
    part, so they are checkpointed once and the facts are read once."""
    spend = durable(daily_costs(costs, as_of))
    summary = durable(with_costs(funnel(profile, purchase_days, touches, as_of), spend))
    parts = (
        overall_platform_report(summary, spend, as_of)
        .unionByName(top_channels_yesterday(summary, as_of))
        .unionByName(top_channels_week(summary, as_of))
    )
    return ordered_report(parts)
