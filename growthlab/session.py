"""Session settings and the one place that cuts lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where the join's output partitioning was wanted downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options every operator here assumes. Partition counts stay the cluster's choice."""
    for key, value in _RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: spark.checkpoint.dir; where that is unset, one beside the tables
    of the warehouse. On a cluster one of the two must be set: the default warehouse is the driver's own folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local") and sc.getConf().get("spark.sql.warehouse.dir") is None:
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/growthlab-checkpoints"
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared root for written tables and streaming state."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later stages read fixed rows even after executors are lost."""
    shared_root(df.sparkSession)
    return df.checkpoint()


@contextmanager
def plain_planning(spark: SparkSession) -> Iterator[None]:
    """Plan without constraint propagation, which takes minutes over dozens of columns derived from each other."""
    key = "spark.sql.constraintPropagation.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)
