"""Session settings the plans are written for, and the shared folder for cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. Partition counts are left to AQE: start high, let it merge small ones.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or one in the warehouse if unset.

    Both are the cluster's own settings; nothing is written to a machine's temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def materialise(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write a frame as Parquet and read it back, so that later plans start at the files.

    Unlike a cached frame it survives the loss of executors, and unlike an RDD checkpoint later
    reads still prune columns and push filters.
    """
    spark = df.sparkSession
    path = f"{folder or shared_dir(spark) + '/' + uuid.uuid4().hex}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
