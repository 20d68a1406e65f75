"""Writers: replace, append, replace one key, CSV, text list."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def replace(df: DataFrame, path: str) -> None:
    """Write beside the target, then swap: a write that fails leaves the old rows as they are, and df may read them."""
    spark = df.sparkSession
    fresh = f"{path.rstrip('/')}-new-{uuid.uuid4().hex}"
    old = f"{path.rstrip('/')}-old-{uuid.uuid4().hex}"
    fs, place = _files(spark, path)
    try:
        df.write.parquet(fresh)
        had = fs.exists(place(path))
        if had and not fs.rename(place(path), place(old)):
            raise OSError(f"cannot move {path} aside")
        if not fs.rename(place(fresh), place(path)):
            if had:
                fs.rename(place(old), place(path))
            raise OSError(f"cannot put new rows at {path}")
        if had:
            fs.delete(place(old), True)
    finally:
        if fs.exists(place(fresh)):
            fs.delete(place(fresh), True)


def _files(spark: SparkSession, path: str):
    """The path's file system, and a function from text to its paths."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark._jsc.hadoopConfiguration()), place


def append_if_any(df: DataFrame, path: str) -> bool:
    """Append unless there is nothing to write."""
    if df.isEmpty():
        return False
    df.write.mode("append").parquet(path)
    return True


def replace_key(df: DataFrame, path: str, key: str, value: object) -> None:
    """Replace the rows of one key value and leave the other partitions alone.

    New rows are staged and put in place when the job commits (dynamic partition overwrite), so a write that fails
    leaves the old ones. A frame without rows of that value clears it: its partition is then dropped."""
    before = _partition_files(df.sparkSession, path, key, value)
    rows = df.where(F.col(key) == F.lit(value))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(key).parquet(path)
    after = _partition_files(df.sparkSession, path, key, value)
    fs, place = _files(df.sparkSession, path)
    for folder, names in before.items():
        if after.get(folder) == names:  # written files have new names: nothing came
            fs.delete(place(folder), True)


def _partition_files(spark: SparkSession, path: str, key: str, value: object) -> dict[str, set[str]]:
    """Files of the key value's partition by its folder."""
    fs, place = _files(spark, path)
    out = {}
    for status in fs.listStatus(place(path)) if fs.exists(place(path)) else []:
        name, equals, text = status.getPath().getName().partition("=")
        if status.isDirectory() and name == key and equals and unquote(text) == str(value):
            found = fs.listStatus(status.getPath())
            out[status.getPath().toString()] = {f.getPath().getName() for f in found}
    return out


def csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def text_list(df: DataFrame, names: list[str], path: str) -> None:
    """One name per line, in order, in a single small file."""
    spark = df.sparkSession
    rows = spark.createDataFrame([("\n".join(names),)], "value string")
    rows.coalesce(1).write.mode("overwrite").text(path)
