"""Tables that are stored as joins need them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store ``df`` in buckets of its keys, sorted by them, as a table of the session's catalog.

    Two tables with as many buckets of the same kinds of keys are joined bucket by bucket,
    without a shuffle of either. The rows of a bucket are gathered before the write, so a
    bucket is one file.
    """
    (
        df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    )
    return df.sparkSession.table(name)
