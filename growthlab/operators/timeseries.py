"""Rolling payment-series features per platform.

Input is one row per (platform, time bucket); a platform's window therefore grows with the
calendar (35,040 quarter hours a year), never with the number of payments. Window lengths are
row counts, as published, or the same numbers of buckets in time if a Clock is given.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthlab.functions import scalars as S

# Model feature order.
FEATURES = [
    "success_vs_rolling_expected",
    "volume_vs_rolling_expected",
    "success_vs_rolling_7day",
    "volume_vs_rolling_7day",
    "success_vs_1h_avg",
    "volume_vs_3h_avg",
    "success_ma_3h",
    "success_vs_7days_ago",
    "success_volatility_3h",
    "volume_volatility_3h",
    "success_trend_3h",
    "volume_momentum_1h",
]
# Share of points flagged per platform; DEFAULT_RATE elsewhere.
CONTAMINATION = {
    "PAYSAFE_CARD": 0.008,
    "WEB_WORLDPAY": 0.0061,
    "NUVEI_CARD": 0.01,
    "WEB_NUVEI": 0.008,
    "APP_IOS_NUVEI": 0.007,
    "WEB_PAYSAFE": 0.0057,
    "APP_IOS_WORLDPAY": 0.006,
    "NUVEI_APPLEPAY": 0.008,
    "APP_IOS_PAYSAFE": 0.0075,
    "PAYSAFE_APPLEPAY": 0.011,
    "WORLDPAY_APPLEPAY": 0.0105,
    "WORLDPAY_CARD": 0.009,
}
DEFAULT_RATE = 0.005


@dataclass(frozen=True)
class Clock:
    """Frames by time instead of by rows: a bucket's width in seconds, and the least share of a frame's buckets that must
    be there for its mean or spread to count."""

    seconds: int
    coverage: float = 0.5


@dataclass(frozen=True)
class Spans:
    """Window lengths in rows."""

    week: int = 168
    week_least: int = 24
    season: int = 336
    same_hour: int = 7
    hour: int = 4
    three_hours: int = 12
    least_rows: int = 96


def complete_rows(series: DataFrame) -> DataFrame:
    """Drop each platform's newest bucket, which is still filling; count what is left."""
    platform = W.partitionBy("platform")
    tagged = series.withColumn("max_hour", F.max("hour").over(platform))
    return tagged.where(F.col("hour") < F.col("max_hour")).withColumn(
        "records_analyzed", F.count(F.lit(1)).over(platform)
    )


def hour_factors(rated: DataFrame, spans: Spans = Spans()) -> DataFrame:
    """Hour-of-week factors from the last rows of each platform, clipped to 0.3..3."""
    newest = W.partitionBy("platform").orderBy(F.desc("hour"))
    recent = rated.withColumn("_back", F.row_number().over(newest)).where(
        F.col("_back") <= spans.season
    )
    overall = W.partitionBy("platform")
    n = F.sum("_n").over(overall)
    per_hour = recent.groupBy("platform", "hour_of_week").agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg("success_rate").alias("_sr"),
        F.avg("total").alias("_vol"),
        F.sum("success_rate").alias("_sr_sum"),
        F.sum("total").alias("_vol_sum"),
    )
    return per_hour.select(
        "platform",
        "hour_of_week",
        S.clip(F.try_divide("_sr", F.sum("_sr_sum").over(overall) / n), 0.3, 3.0).alias(
            "success_factor"
        ),
        S.clip(F.try_divide("_vol", F.sum("_vol_sum").over(overall) / n), 0.3, 3.0).alias(
            "volume_factor"
        ),
    )


def with_rate(series: DataFrame) -> DataFrame:
    total = S.swap_value(F.col("total"), 0, 1)
    return series.withColumn("success_rate", F.col("approved") / total).withColumn(
        "hour_of_week", S.hour_of_week(F.col("hour"))
    )


class _Frames:
    """Windows of a number of buckets, and single buckets before the current one, by rows or by time."""

    def __init__(self, clock: Clock | None) -> None:
        self.clock = clock

    def last(self, spec, length: int, every: int = 1):
        """The last `length` buckets of `spec`, which are `every` buckets apart."""
        if self.clock is None:
            return spec.orderBy("hour").rowsBetween(1 - length, 0)
        return spec.orderBy("_s").rangeBetween(1 - length * every * self.clock.seconds, 0)

    def before(self, col: Column | str, spec, length: int) -> Column:
        if self.clock is None:
            return F.lag(col, length).over(spec.orderBy("hour"))
        back = -length * self.clock.seconds
        return F.max(col).over(spec.orderBy("_s").rangeBetween(back, back))

    def least(self, rows: int, length: int) -> int:
        return rows if self.clock is None else max(rows, math.ceil(self.clock.coverage * length))


def _at_least(col: Column, fn, spec, least: int) -> Column:
    return F.when(F.count(col).over(spec) >= least, fn(col).over(spec))


def _div(a: Column, b: Column, zero: float) -> Column:
    return F.try_divide(a.cast("double"), S.swap_value(b, 0, zero))


def rolling_features(
    series: DataFrame, spans: Spans = Spans(), causal: bool = False, clean: bool = True, clock: Clock | None = None
) -> DataFrame:
    """The twelve features and their context for every row of (platform, hour, approved, total).

    causal=True builds the hour factors from the `season` rows before each row and fills what has no
    baseline yet with 1, for scoring history. With a clock all lengths are buckets of time: where buckets are
    missing, frames hold fewer rows instead of reaching further back, a bucket before is the one at that time or
    none, the trend runs over real time, and a mean or spread of a frame with too few of its buckets is missing."""
    base = with_rate(series)
    platform = W.partitionBy("platform")
    how = W.partitionBy("platform", "hour_of_week")
    order = platform.orderBy("hour")
    frames = _Frames(clock)
    place = "_rn"
    if clock is not None:
        base = base.withColumn("_s", F.unix_timestamp("hour")).withColumn("_b", F.col("_s") / F.lit(float(clock.seconds)))
        place = "_b"
    week, hour, three = (frames.last(platform, n) for n in (spans.week, spans.hour, spans.three_hours))
    per_week = 1 if clock is None else max(1, 7 * 86_400 // clock.seconds)
    same = frames.last(how, spans.same_hour, per_week)
    rate, total = F.col("success_rate"), F.col("total").cast("double")
    numbered = base.withColumn("_rn", F.row_number().over(order))
    if causal:
        at = "_rn" if clock is None else "_s"
        back = spans.season * (1 if clock is None else clock.seconds)
        by_hour = how.orderBy(at).rangeBetween(-back, -1)
        overall = platform.orderBy(at).rangeBetween(-back, -1) if clock else order.rowsBetween(-spans.season, -1)
        recent = F.lit(True)
    else:
        by_hour, overall = how, platform
        if clock is None:
            recent = F.col("_rn") > F.col("_rows") - spans.season
            numbered = numbered.withColumn("_rows", F.count(F.lit(1)).over(platform))
        else:
            recent = F.col("_s") > F.col("_newest") - spans.season * clock.seconds
            numbered = numbered.withColumn("_newest", F.max("_s").over(platform))

    def factor(c: Column) -> Column:
        used = F.when(recent, c)
        ratio = F.try_divide(F.avg(used).over(by_hour), F.avg(used).over(overall))
        return F.coalesce(S.clip(ratio, 0.3, 3.0), F.lit(1.0))

    def mean(c: Column, frame, length: int) -> Column:
        return F.avg(c).over(frame) if clock is None else _at_least(c, F.avg, frame, frames.least(1, length))

    seasonal = numbered.withColumn("success_factor", factor(rate)).withColumn(
        "volume_factor", factor(total)
    )
    week_least = frames.least(spans.week_least, spans.week)
    least_12 = frames.least(2, spans.three_hours)
    rolled = (
        seasonal.withColumn("rolling_7day_avg_success", _at_least(rate, F.avg, week, week_least))
        .withColumn("rolling_7day_avg_volume", _at_least(total, F.avg, week, week_least))
        .withColumn("_same_success", _at_least(rate, F.avg, same, 2))
        .withColumn("_same_volume", _at_least(total, F.avg, same, 2))
        .withColumn("total_4p", F.sum(total).over(hour))
        .withColumn("_approved_4p", F.sum("approved").over(hour))
        .withColumn("success_ma_1h", mean(rate, hour, spans.hour))
        .withColumn("success_ma_3h", mean(rate, three, spans.three_hours))
        .withColumn("volume_ma_3h", mean(total, three, spans.three_hours))
        .withColumn("success_volatility_3h", _at_least(rate, F.stddev_samp, three, least_12))
        .withColumn("volume_volatility_3h", _at_least(total, F.stddev_samp, three, least_12))
        .withColumn(
            "success_trend_3h",
            F.when(
                F.count(rate).over(three) >= frames.least(3, spans.three_hours),
                F.regr_slope("success_rate", place).over(three),
            ),
        )
        .withColumn("_total_before", frames.before(total, platform, spans.hour))
        .withColumn("_sr4", _div(F.col("_approved_4p"), F.col("total_4p"), 1.0))
        .withColumn("_sr4_before", frames.before("_sr4", platform, spans.week))
    )
    same_success = F.coalesce("_same_success", "rolling_7day_avg_success")
    same_volume = F.coalesce("_same_volume", "rolling_7day_avg_volume")
    sr4 = F.col("_sr4")
    featured = rolled.withColumns(
        {
            "success_vs_rolling_expected": S.clip(
                _div(sr4, same_success * F.col("success_factor"), 0.5), 0.1, 5.0
            ),
            "volume_vs_rolling_expected": S.clip(
                _div(F.col("total_4p"), same_volume * F.col("volume_factor") * 4, 10.0), 0.1, 5.0
            ),
            "success_vs_rolling_7day": S.clip(
                _div(rate, F.col("rolling_7day_avg_success"), 0.5), 0.1, 5.0
            ),
            "volume_vs_rolling_7day": S.clip(
                _div(total, F.col("rolling_7day_avg_volume"), 10.0), 0.1, 5.0
            ),
            "success_vs_1h_avg": F.coalesce(
                _div(rate, F.col("success_ma_1h"), 1.0), F.lit(1.0)
            ),
            "volume_vs_3h_avg": F.coalesce(_div(total, F.col("volume_ma_3h"), 1.0), F.lit(1.0)),
            "success_vs_7days_ago": F.coalesce(
                _div(sr4, F.col("_sr4_before"), 1.0), F.lit(1.0)
            ),
            "success_volatility_3h": F.coalesce("success_volatility_3h", F.lit(0.0)),
            "volume_volatility_3h": F.coalesce("volume_volatility_3h", F.lit(0.0)),
            "success_trend_3h": F.coalesce("success_trend_3h", F.lit(0.0)),
            "volume_momentum_1h": _momentum(total, F.col("_total_before")),
        }
    )
    keep = [c for c in featured.columns if not c.startswith("_")]
    out = featured.select(*keep)
    return clean_features(out, causal=causal) if clean else out


def _momentum(now: Column, before: Column) -> Column:
    """Relative change; a rise from zero is unbounded and later becomes 1, no history gives 0."""
    return (
        F.when(before.isNull(), F.lit(0.0))
        .when(before != 0, now / before - 1)
        .when(now > 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )


# the only features that can be missing: their baselines need a minimum of history
_OPEN = FEATURES[:4]


def clean_features(df: DataFrame, cols: list[str] = FEATURES, causal: bool = False) -> DataFrame:
    """NULL becomes the platform's median where that is positive, else 1 (always 1 if causal: a median looks
    ahead); infinities become 1.

    The exact median runs over one platform's calendar buckets, not over payments."""
    platform = W.partitionBy("platform")

    def fixed(c: str) -> Column:
        if causal or c not in _OPEN:
            return S.finite_or(F.coalesce(F.col(c), F.lit(1.0)), 1.0)
        m = F.percentile(c, F.lit(0.5)).over(platform)
        return S.finite_or(F.coalesce(F.col(c), F.when(m > 0, m), F.lit(1.0)), 1.0)

    return df.withColumns({c: fixed(c) for c in cols})


def latest(features: DataFrame) -> DataFrame:
    """Newest row of each platform."""
    newest = W.partitionBy("platform").orderBy(F.desc("hour"))
    return features.withColumn("_back", F.row_number().over(newest)).where(
        F.col("_back") == 1
    ).drop("_back")


def standardise(df: DataFrame, cols: list[str] = FEATURES, key: str = "platform") -> DataFrame:
    """Zero mean and unit (population) deviation per platform; constant columns stay centred."""
    stats = df.groupBy(key).agg(
        *[F.avg(c).alias(f"_a_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_d_{c}") for c in cols]
    )
    return (
        df.join(stats, key)
        .withColumns(
            {
                c: (F.col(c) - F.col(f"_a_{c}")) / S.swap_value(F.col(f"_d_{c}"), 0.0, 1.0)
                for c in cols
            }
        )
        .drop(*[f"_a_{c}" for c in cols], *[f"_d_{c}" for c in cols])
    )
