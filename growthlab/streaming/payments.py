"""Payment events -> quarter-hour counts -> scores of the newest complete bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from growthlab.operators import timeseries as TS
from growthlab.plans import anomaly
from growthlab.streaming import history


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """An event table as a stream, one file or a folder of files; the schema is taken from what is
    already there. The last letter is written as a pattern because only patterns may name a file."""
    path = path.rstrip("/")
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def bucket_counts(
    events: DataFrame,
    platform: Column,
    approved: Column,
    width: str = "15 minutes",
    late: str = "1 hour",
) -> DataFrame:
    """Attempts and approvals per platform and time bucket; a bucket is emitted once the
    watermark has passed its end. State holds one counter pair per open bucket."""
    stamped = events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        platform.alias("platform"),
        approved.alias("_ok"),
    )
    if stamped.isStreaming:
        stamped = stamped.withWatermark("ts", late)
    return (
        stamped.groupBy(F.window("ts", width), "platform")
        .agg(F.count_if("_ok").alias("approved"), F.count(F.lit(1)).alias("total"))
        .select("platform", F.col("window.start").alias("hour"), "approved", "total")
    )


def write_counts(counts: DataFrame, table: str, state: str) -> StreamingQuery:
    """Append finished buckets to a Parquet table; offsets and state live in `state`."""
    return (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", table)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )


def score_batches(
    counts: DataFrame,
    table: str,
    detector: anomaly.Detector,
    sink: Callable[[DataFrame, int], None],
    state: str,
    spans: TS.Spans = TS.Spans(),
) -> StreamingQuery:
    """Append the finished buckets to `table`, take what is new there into the platforms' bounded histories, and score
    the newest complete bucket of every platform that got one. The table is read as a stream, so a trigger reads only
    its own buckets; a call after new events goes on where the last one ended."""
    write_counts(counts, table, f"{state}/counts").awaitTermination()
    fresh = counts.sparkSession.readStream.schema(counts.schema).parquet(table)

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        asked = rows.select("platform", "max_hour_excluded", "records_analyzed")
        newest = rows.where(F.col("hour").isNotNull()).drop("max_hour_excluded", "records_analyzed")
        try:
            sink(anomaly.records(asked, newest, detector, spans), batch_id)
        finally:
            rows.unpersist()

    return (
        history.newest_features(fresh, spans)
        .writeStream.outputMode("append")
        .foreachBatch(run)
        .option("checkpointLocation", f"{state}/scores")
        .trigger(availableNow=True)
        .start()
    )
