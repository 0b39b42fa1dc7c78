"""Session settings the operators are designed for, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution coalesces small partitions, splits skewed join partitions
# and switches to a broadcast once a side's measured size allows it.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


#: Whether Spark deletes a query's shuffle files when it has ended; else they stay until the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of what is written go as soon as it is written."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def shared_folder(spark: SparkSession) -> str:
    """This run's own folder in a place every executor can reach.

    The place is ``spark.checkpoint.dir``; where that is unset, the warehouse folder,
    which every session has.
    """
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{place.rstrip('/')}/tidewater/{spark.sparkContext.applicationId}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    The table is computed once, survives the loss of executors, and carries its
    true size, so that Spark's own broadcast threshold decides how to join it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Stage:
    """A place in the shared folder for one table at a time, which is made from the one before it.

    The one before is deleted once the next is written, and so are the shuffle files this took, so the disk holds two
    such tables and one table's shuffles at most, however many there are in a row.
    """

    def __init__(self):
        self.path: str | None = None

    def settle(self, df: DataFrame, name: str) -> DataFrame:
        spark = df.sparkSession
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        with freed_shuffles(spark):
            df.write.option("compression", "zstd").parquet(path)
        if self.path:
            _delete(spark, self.path)
        self.path = path
        return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_settled(spark: SparkSession) -> None:
    """Delete all that this run has settled; frames read from it are of no use afterwards."""
    _delete(spark, shared_folder(spark))
