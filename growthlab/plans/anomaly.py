"""Payment anomaly scoring for all platforms in one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthlab.operators import forest as IF
from growthlab.operators import timeseries as TS
from growthlab.session import durable

MODEL_TYPE = "rolling_7day_hour_of_week"
_SCALED = [f"z_{c}" for c in TS.FEATURES]


@dataclass(frozen=True)
class Detector:
    """Fitted state; every frame has one row per platform."""

    forest: DataFrame
    scaler: DataFrame
    cuts: DataFrame

    def save(self, folder: str) -> None:
        for name in ("forest", "scaler", "cuts"):
            getattr(self, name).write.mode("overwrite").parquet(f"{folder}/{name}")

    @staticmethod
    def load(spark, folder: str) -> "Detector":
        return Detector(*[spark.read.parquet(f"{folder}/{n}") for n in ("forest", "scaler", "cuts")])


def contamination(platform: Column) -> Column:
    entries = [F.lit(x) for pair in TS.CONTAMINATION.items() for x in pair]
    return F.coalesce(
        F.try_element_at(F.create_map(*entries), platform), F.lit(TS.DEFAULT_RATE)
    )


def fit(
    series: DataFrame, spans: TS.Spans = TS.Spans(), seed: object = 42, trees: int = IF.TREES
) -> Detector:
    """Scaler, forest and cut-off of every platform with enough history."""
    enough = TS.complete_rows(series).where(F.col("records_analyzed") >= spans.least_rows)
    history = durable(TS.rolling_features(enough, spans))
    scaler = history.groupBy("platform").agg(
        *[F.avg(c).alias(f"_a_{c}") for c in TS.FEATURES],
        *[F.stddev_pop(c).alias(f"_d_{c}") for c in TS.FEATURES],
    )
    scaled = scale(history, scaler)
    forest = durable(IF.fit_forest(scaled, _SCALED, seed=seed, trees=trees))
    return Detector(forest, scaler, durable(cut_offs(score(scaled, forest))))


def scale(rows: DataFrame, scaler: DataFrame) -> DataFrame:
    """Scaled copies named z_<feature> beside the plain values."""

    def z(c: str) -> Column:
        spread = F.when(F.col(f"_d_{c}") != 0, F.col(f"_d_{c}")).otherwise(F.lit(1.0))
        return (F.col(c) - F.col(f"_a_{c}")) / spread

    scaled = rows.join(scaler, "platform").withColumns({f"z_{c}": z(c) for c in TS.FEATURES})
    return scaled.drop(*[c for c in scaler.columns if c != "platform"])


def score(scaled: DataFrame, forest: DataFrame) -> DataFrame:
    """Rows of one platform are scored a month of buckets at a time."""
    sliced = scaled.withColumn("_slice", F.date_format("hour", "yyyy-MM"))
    return IF.raw_scores(sliced, forest, _SCALED).drop("_slice", *_SCALED)


def cut_offs(scored: DataFrame) -> DataFrame:
    """Score quantile at the platform's contamination rate, over its calendar buckets."""
    rows = W.partitionBy("platform")
    at = contamination(F.col("platform")) * (F.count(F.lit(1)).over(rows) - 1)
    ranked = scored.select(
        "platform",
        "score",
        (F.row_number().over(rows.orderBy("score")) - 1).alias("_r"),
        at.alias("_at"),
    )
    low = F.max(F.when(F.col("_r") == F.floor("_at"), F.col("score")))
    high = F.max(F.when(F.col("_r") == F.floor("_at") + 1, F.col("score")))
    share = F.max(F.col("_at") - F.floor("_at"))
    return ranked.groupBy("platform").agg(
        (low + F.coalesce(high - low, F.lit(0.0)) * share).alias("cut_off")
    )


def decide(scored: DataFrame, cuts: DataFrame) -> DataFrame:
    margin = F.col("score") - F.col("cut_off")
    return (
        scored.join(cuts, "platform")
        .withColumn("anomaly_score", margin)
        .withColumn("is_anomaly", F.col("anomaly_score") < 0)
        .withColumn("confidence", F.abs("anomaly_score"))
        .drop("score", "cut_off")
    )


def score_history(
    series: DataFrame, detector: Detector, spans: TS.Spans = TS.Spans(), causal: bool = True
) -> DataFrame:
    """Anomaly decision for every complete bucket, from features that look at earlier buckets only;
    causal=False gives the published look, whose factors and medians cover the whole series."""
    rows = TS.complete_rows(series).where(F.col("records_analyzed") >= spans.least_rows)
    scaled = scale(TS.rolling_features(rows, spans, causal=causal), detector.scaler)
    return decide(score(scaled, detector.forest), detector.cuts)


def latest_records(
    series: DataFrame, detector: Detector, spans: TS.Spans = TS.Spans()
) -> DataFrame:
    """One record per platform for its newest complete bucket.

    Platforms that cannot be scored come back with the reason in `status`."""
    rows = TS.complete_rows(series)
    enough = rows.where(F.col("records_analyzed") >= spans.least_rows)
    newest = TS.latest(TS.rolling_features(enough, spans))
    asked = series.groupBy("platform").agg(F.max("hour").alias("max_hour_excluded"))
    kept = rows.groupBy("platform").agg(F.count(F.lit(1)).alias("records_analyzed"))
    asked = asked.join(kept, "platform", "left").fillna(0, ["records_analyzed"])
    return records(asked, newest, detector, spans)


def records(
    asked: DataFrame, newest: DataFrame, detector: Detector, spans: TS.Spans = TS.Spans()
) -> DataFrame:
    """The published record of every asked platform (platform, max_hour_excluded, records_analyzed), from the
    features of its newest complete bucket where it has enough of them."""
    decided = decide(
        score(scale(newest, detector.scaler), detector.forest), detector.cuts
    )
    values = F.create_map(*[x for c in TS.FEATURES for x in (F.lit(c), F.col(c))])
    context = F.struct(
        F.col("hour_of_week"),
        F.col("success_factor").alias("hour_of_week_success_factor"),
        F.col("volume_factor").alias("hour_of_week_volume_factor"),
        F.col("rolling_7day_avg_success").isNotNull().cast("int").alias(
            "rolling_7day_periods_available"
        ),
    )
    found = decided.select(
        "platform",
        "is_anomaly",
        "anomaly_score",
        "confidence",
        contamination(F.col("platform")).alias("contamination_rate"),
        F.col("hour").alias("prediction_timestamp"),
        values.alias("rolling_feature_values"),
        context.alias("rolling_context"),
        F.lit(MODEL_TYPE).alias("model_type"),
        F.lit(len(TS.FEATURES)).alias("features_count"),
    )
    status = (
        F.when(F.col("records_analyzed") == 0, "no data after excluding the newest hour")
        .when(F.col("records_analyzed") < spans.least_rows, "insufficient data")
        .when(F.col("anomaly_score").isNull(), "platform not available")
        .otherwise("ok")
    )
    return asked.join(found, "platform", "left").withColumn("status", status)
