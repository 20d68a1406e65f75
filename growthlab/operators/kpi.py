"""Payment KPIs: success rate, chargebacks, grades, period change, drill-down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthlab.functions import scalars as S
from growthlab.operators import joins as J

# Amount bands, alert levels.
AMOUNT_EDGES = [0, 50, 100, 200, 350, float("inf")]
AMOUNT_LABELS = ["0-50", "50-100", "100-200", "200-350", "350+"]
LOW_SAMPLE = 1000
GRADE_ALERT = 80.0


def amount_band(col: Column) -> Column:
    return S.band(col, AMOUNT_EDGES, AMOUNT_LABELS)


def payment_kpis(payments: DataFrame, by: list[str]) -> DataFrame:
    """Attempts, success rate, 3-D Secure fallback count and revenue per segment."""
    ok = F.col("status") == 1
    failed = F.col("status") == 6
    return (
        payments.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.count_if(ok | failed).alias("attempts"),
            F.count_if(ok).alias("successes"),
            F.count_if(failed).alias("failures"),
            F.count_if(F.col("threeds_type").isin("Y", "A")).alias("threeds_ok"),
            F.sum(F.when(ok, F.col("amount"))).alias("revenue"),
            F.avg(F.when(ok, F.col("amount"))).alias("avg_amount"),
        )
        .withColumn("success_rate", S.safe_div(F.col("successes"), F.col("attempts")) * 100)
        .withColumn("low_sample", (F.col("attempts") < LOW_SAMPLE).cast("int"))
    )


def chargeback_ratio(payments: DataFrame, chargebacks: DataFrame, by: list[str]) -> DataFrame:
    """Chargebacks per transaction and segment with their value, alert band and investigation flag.

    Segments that only one side has, and NULL segments, stay: without transactions the ratio is NULL and
    the alert "critical"."""
    paid = payments.groupBy(*by).agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("amount").alias("volume")
    )
    back = chargebacks.groupBy(*by).agg(
        F.count(F.lit(1)).alias("chargebacks"), F.sum("amount").alias("chargeback_value")
    )
    ratio = S.safe_div(F.col("chargebacks"), F.col("transactions")) * 100
    return (
        J.null_safe_join(paid, back, by, "full")
        .fillna(0, ["transactions", "volume", "chargebacks", "chargeback_value"])
        .withColumn("chargeback_ratio", ratio)
        .withColumn(
            "alert",
            F.when(F.col("chargeback_ratio") < 1, "good")
            .when(F.col("chargeback_ratio") <= 2, "concerning")
            .when((F.col("chargeback_ratio") > 2) | (F.col("chargebacks") > 0), "critical"),
        )
        .withColumn("investigation", F.coalesce(F.col("alert") == "critical", F.lit(False)).cast("int"))
        .withColumn("value_share", S.safe_div(F.col("chargeback_value"), F.col("volume")) * 100)
    )


def grade_distribution(tokens: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Users per redeem grade (no grade counts as 1), share of the segment and alert."""
    by = by or []
    grades = tokens.groupBy(*by, F.coalesce("grade", F.lit(1)).alias("grade")).agg(
        F.count(F.lit(1)).alias("users")
    )
    # a handful of grades per segment
    total = F.sum("users").over(W.partitionBy(*by))
    return grades.withColumn("share", F.col("users") / total * 100).withColumn(
        "alert", ((F.col("grade") == 1) & (F.col("share") > GRADE_ALERT)).cast("int")
    )


def period_change(
    payments: DataFrame, unit: str = "week", drop_points: float = 5.0, by: list[str] | None = None
) -> DataFrame:
    """Success rate per period against the period right before it (NULL where that one has no payments),
    with sample and investigation flags."""
    by = by or []
    rates = payment_kpis(
        payments.withColumn("period", F.to_date(F.date_trunc(unit, "day"))), by + ["period"]
    ).select(*by, "period", "attempts", "success_rate", "revenue", "low_sample")
    # one row per calendar period
    order = W.partitionBy(*by).orderBy("period")
    step = {"week": "7 days", "month": "1 month", "day": "1 day"}[unit]
    adjacent = F.lag("period").over(order) == F.to_date(F.col("period") - F.expr(f"INTERVAL {step}"))
    before = lambda c: F.when(adjacent, F.lag(c).over(order))
    change = F.col("success_rate") - before("success_rate")
    revenue_before = before("revenue")
    return (
        rates.withColumn("rate_change", change)
        .withColumn(
            "revenue_change_pct",
            S.safe_div(F.col("revenue") - revenue_before, revenue_before) * 100,
        )
        .withColumn(
            "investigation",
            F.when(F.col("rate_change") < -drop_points, "PERFORMANCE INVESTIGATION NEEDED"),
        )
    )


def drill_down(
    payments: DataFrame, dims: list[str], split_day: str, days: int
) -> DataFrame:
    """Success-rate change between two adjacent spans for every value of every dimension, ranked
    by the number of successes the change is worth."""
    split = F.lit(split_day).cast("date")
    span = (
        F.when(F.col("day").between(F.date_sub(split, days), F.date_sub(split, 1)), "before")
        .when(F.col("day").between(split, F.date_add(split, days - 1)), "after")
    )
    ok, tried = F.col("status") == 1, F.col("status").isin(1, 6)
    # reduce to one row per combination of dimension values before unpivoting
    cube = (
        payments.withColumn("_span", span)
        .where(F.col("_span").isNotNull())
        .groupBy(*dims)
        .agg(
            *[
                F.count_if((F.col("_span") == s) & c).alias(f"{s}_{n}")
                for s in ("before", "after")
                for n, c in (("ok", ok), ("tried", tried))
            ]
        )
    )
    counts = ["before_ok", "before_tried", "after_ok", "after_tried"]
    per_value = (
        cube.withColumns({d: F.col(d).cast("string") for d in dims})
        .unpivot(counts, dims, "dimension", "value")
        .groupBy("dimension", "value")
        .agg(*[F.sum(c).alias(c) for c in counts])
    )
    before = S.safe_div(F.col("before_ok"), F.col("before_tried")) * 100
    after = S.safe_div(F.col("after_ok"), F.col("after_tried")) * 100
    out = per_value.withColumn("rate_before", before).withColumn("rate_after", after)
    out = out.withColumn("delta", F.col("rate_after") - F.col("rate_before")).withColumn(
        "impact", F.abs(F.col("delta")) * F.col("after_tried") / 100
    )
    order = W.partitionBy("dimension").orderBy(
        F.desc(F.round("impact", 6)), F.asc_nulls_first("value")
    )
    # one row per value of a reporting dimension
    return out.withColumn("impact_rank", F.row_number().over(order))
