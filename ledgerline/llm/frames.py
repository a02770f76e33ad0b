"""What the operators share on the DataFrame side."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.session import shared_dir


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Python workers look for this package where the driver found it, whatever folder they start in.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """Let Python workers get their rows in portions that stay small with long texts.

    Only the size of the portions changes, for this session; no result depends on it.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return df


_workspace: ContextVar[str | None] = ContextVar("workspace", default=None)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that driver and executors share, in the open workspace if there is one."""
    return f"{_workspace.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """All that operators store inside the block goes with it.

    Their results are lazy and read what is stored, so a caller writes those it wants before the block ends,
    to a folder of its own, taken before the block began.
    """
    path = scratch(spark, "workspace")
    opened = _workspace.set(path)
    try:
        yield
    finally:
        _workspace.reset(opened)
        remove(spark, path)


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = path or scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class Scratch:
    """Intermediate tables of one run of an operator, which drops them as soon as it is past them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, scratch(spark, name)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def drop(self, *names: str) -> None:
        """Remove tables by name, or all of them."""
        for path in [f"{self.folder}/{name}" for name in names] or [self.folder]:
            remove(self.spark, path)


def whole_rows(docs: DataFrame, *beside: Column) -> DataFrame:
    """Each row as a struct `row`, beside other columns, whose names then cannot clash with its own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *beside)


def row_key(*columns: str) -> Column:
    """Two 64-bit hashes that tell rows apart by some columns; equal rows share it."""
    nulls = [F.col(c).isNull() for c in columns]
    return F.struct(
        F.xxhash64(*columns, *nulls).alias("a"),
        F.xxhash64(F.lit(1), *columns, *nulls).alias("b"),
    )


def crc_of_id(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))
