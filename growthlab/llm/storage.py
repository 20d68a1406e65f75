"""Written tables in the shared folder, and session settings for text work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from growthlab.session import fresh_folder, tune


def ready(spark: SparkSession) -> SparkSession:
    """Session options for rows that carry whole texts: small Arrow batches keep Python workers small."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage is cut, lost executors lose nothing."""
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    spark.sparkContext._jvm.System.gc()  # lets Spark drop shuffle files of finished jobs that nothing refers to
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*frames: DataFrame) -> None:
    """Delete stored frames that nothing lazy depends on any more."""
    for df in frames:
        forget_folders(df.sparkSession, *{f.rpartition("/")[0] for f in df.inputFiles()})


def forget_folders(spark: SparkSession, *folders: str) -> None:
    for name in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that an operator is about to make itself, so that extra input columns cannot clash."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])
