"""Tables kept between the steps of an operator, and dropped when no later step reads them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tierflow.session import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    """Within it, Spark removes the shuffle files of a query once the query has ended.

    That suits a query whose only use is to write a table: later steps read the table.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


class Shelf:
    """Tables below the shared folder, by name."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.base = spark, scratch_path(spark, label)

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written once and read from there; a lost executor costs a reread."""
        with shuffles_cleaned(self.spark):
            df.write.option("compression", "zstd").parquet(f"{self.base}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.base}/{name}")

    def put_by(self, name: str, df: DataFrame, kind: str, count: int) -> list[DataFrame]:
        """``df`` in one pass as ``count`` tables, by a column of whole numbers from 0.

        They can be dropped one by one, as ``name/kind=number``.
        """
        key = "spark.sql.maxConcurrentOutputFileWriters"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, str(max(count, int(before))))  # rows need not be sorted by their table
        try:
            with shuffles_cleaned(self.spark):
                df.write.option("compression", "zstd").partitionBy(kind).parquet(f"{self.base}/{name}")
        finally:
            self.spark.conf.set(key, before)
        schema = df.drop(kind).schema
        found = []
        for number in range(count):
            path = f"{self.base}/{name}/{kind}={number}"
            folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
            found.append(self.spark.read.schema(schema).parquet(path))
        return found

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
