"""Readers: tables, SQL files, CSV, text lists, JSON records and configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlab.operators.cleaning import require_columns

SERIES_RECORD = (
    "platform_provider string, instances array<struct<approved: bigint, total: bigint, hour: timestamp>>"
)
CONFIG_RECORD = (
    "features array<string>, contamination_rates map<string, double>, platforms array<string>, "
    "performance struct<rate: double, status: string>, model_type string"
)


def parquet(spark: SparkSession, path: str, needed: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return require_columns(df, needed) if needed else df


def sql_text(spark: SparkSession, path: str) -> str:
    text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    if not text.strip():
        raise ValueError(f"SQL file is empty: {path}")
    return text


def sql_file(spark: SparkSession, path: str, args: dict | None = None) -> DataFrame:
    """Run the statement in a file, with named parameters."""
    return spark.sql(sql_text(spark, path).strip().rstrip(";"), args=args or {})


def user_values(profile: DataFrame, since: str) -> DataFrame:
    """user_id and value of users first buying after a day; filter and columns reach the scan."""
    return profile.where(F.col("first_purchase_date") > F.lit(since).cast("timestamp")).select(
        "user_id", "enp"
    )


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True)


def text_list(spark: SparkSession, path: str) -> list[str]:
    """Names in file order (feature lists: a few dozen lines)."""
    rows = spark.read.text(path, wholetext=True).collect()
    names = [line.strip() for r in rows for line in r[0].splitlines()]
    if not names:
        raise ValueError(f"no names in {path}")
    return names


def payment_requests(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Request documents (one per line, or one per file) -> one row per (platform, hour)."""
    raw = spark.read.json(path, schema=SERIES_RECORD, multiLine=multi_line)
    return raw.select(F.col("platform_provider").alias("platform"), F.inline("instances"))


def detector_config(spark: SparkSession, path: str) -> DataFrame:
    """Platforms with their contamination rate, from the configuration document."""
    raw = spark.read.json(path, schema=CONFIG_RECORD, multiLine=True)
    rates = raw.select(
        F.explode("platforms").alias("platform"), "contamination_rates", "model_type"
    )
    return rates.select(
        "platform",
        F.try_element_at("contamination_rates", F.col("platform")).alias("contamination_rate"),
        "model_type",
    )
