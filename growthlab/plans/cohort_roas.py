"""Cohort revenue on exact day offsets against marketing cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthlab.functions import scalars as S
from growthlab.functions import sums as A
from growthlab.operators.cohort import REVENUE_DAYS, revenue_on_days


def daily_cohorts(
    profile: DataFrame, signed_days: DataFrame, touches: DataFrame, days: list[int] = REVENUE_DAYS
) -> DataFrame:
    """Users, payers and revenue per signup day and channel."""
    rev = revenue_on_days(signed_days, days).drop("signup_date")
    named = F.lower(F.concat("channel", F.lit("_"), "channel_type"))
    users = touches.select(
        "user_id",
        S.merge_restricted(named).alias("channel_type_con"),
        F.when(F.col("channel") == "organic", "organic")
        .otherwise(F.lower("traffic_type"))
        .alias("traffic_type"),
        F.lower("platform").alias("platform"),
    ).distinct()
    payers = profile.select(
        "user_id",
        "signup_date",
        F.when(F.col("first_purchase_date").isNotNull(), F.col("user_id")).alias("user_paid"),
    )
    keys = ["cohort_date", "channel_type_con", "platform", "traffic_type"]
    measures = [f"revenue_d{d}" for d in days]
    # one row per cohort and user first, so distinct users are plain counts afterwards
    per_user = (
        users.join(payers.join(rev, "user_id", "left"), "user_id", "left")
        .withColumn("cohort_date", F.to_date("signup_date"))
        .groupBy("user_id", *keys)
        .agg(F.max("user_paid").alias("user_paid"), *A.sums(measures, "null"))
    )
    return per_user.groupBy(*keys).agg(
        F.count("user_id").alias("total_users"),
        F.count("user_paid").alias("total_paid"),
        *[S.half_up(F.sum(c)).alias(c) for c in measures],
    )


def cohort_cost(costs: DataFrame, cost_grain: str = "month_start") -> DataFrame:
    """Cost per channel. 'month_start' labels a whole month's cost with its first day, so only
    cohorts of that day meet it (as published); 'day' keeps daily cost."""
    day = F.trunc("day", "month") if cost_grain == "month_start" else F.to_date("day")
    return costs.groupBy(
        day.alias("cohort_date"),
        S.spend_key(F.col("platform"), F.col("channel"), F.col("channel_type")).alias(
            "channel_type_con"
        ),
        F.lower("platform").alias("platform"),
        F.lit("paid").alias("traffic_type"),
    ).agg(S.half_up(F.sum("cost")).alias("daily_cost"))


def cohort_roas(
    cohorts: DataFrame, costs: DataFrame, days: list[int] = REVENUE_DAYS, cost_grain: str = "month_start"
) -> DataFrame:
    keys = ["cohort_date", "traffic_type", "platform", "channel_type_con"]
    cost = F.coalesce(F.col("daily_cost"), F.lit(0.0))
    joined = cohorts.join(cohort_cost(costs, cost_grain), keys, "left")
    return joined.select(
        "cohort_date",
        F.coalesce("channel_type_con", F.lit("organic")).alias("channel_type_con"),
        "platform",
        "traffic_type",
        "total_users",
        "total_paid",
        F.round(cost).alias("daily_cost"),
        *[
            F.when(
                cost > 0, S.half_up(S.safe_div(F.col(f"revenue_d{d}"), F.col("daily_cost")), 3)
            )
            .otherwise(F.lit(0.0))
            .alias(f"roas_d{d}")
            for d in days
        ],
        *[f"revenue_d{d}" for d in days],
    ).orderBy(F.desc("cohort_date"), "channel_type_con", "platform")
