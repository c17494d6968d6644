"""Helpers shared by the corpus operators: reading, batches, scratch tables, hot-key joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tierflow.session import scratch_path

ROWS_AT_ONCE, BYTES_AT_ONCE = 512, 1 << 22


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there.

    It cuts the lineage: a lost executor costs a reread, and the rows are the same ones
    in every later use.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE, size: int = BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of bounded rows and bytes, so that the Python copies stay small.

    A row larger than the bound is a slice of its own.
    """
    def cut(batch):
        if batch.num_rows > rows or (batch.num_rows > 1 and batch.nbytes > size):
            half = batch.num_rows // 2 if batch.num_rows <= rows else rows
            yield from cut(batch.slice(0, half))
            yield from cut(batch.slice(half))
        elif batch.num_rows:
            yield batch

    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield from cut(batch.slice(start, rows))


def texts_of(column: pa.Array) -> list[str]:
    """The texts of a column, null as the empty text."""
    return [value or "" for value in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """The texts of a column as UTF-8, null as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def arrow_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, schema)],
        schema=schema,
    )


def remainder(name: str, modulus: int) -> F.Column:
    """crc32 of the key's text modulo ``modulus``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit(""))) % modulus


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = values.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def attach(rows: DataFrame, keyed: DataFrame, key: str, size: str, total: int, how: str = "inner",
           parts: int = 1000) -> DataFrame:
    """Join ``rows`` with the one row per key of ``keyed``, however uneven the keys are.

    ``keyed`` tells in ``size`` how many rows have a key, of ``total`` in all. At most
    ``parts`` keys can hold a ``parts``-th of the rows; only those are broadcast. Every
    other key is small, so the ordinary join deals it out evenly.
    """
    limit = max(1, -(-total // parts))
    hot = F.broadcast(keyed.filter(F.col(size) >= limit))
    rest = rows.join(F.broadcast(keyed.filter(F.col(size) >= limit).select(key)), key, "left_anti")
    return rows.join(hot, key, "inner").unionByName(
        rest.join(keyed.filter(F.col(size) < limit), key, how)
    )


def per_batch(df: DataFrame, work: Callable, schema: str, names: list[str], **needed) -> DataFrame:
    """``work(batches, **needed)`` over the named columns of ``df``."""
    return df.select(*names).mapInArrow(lambda batches: work(batches, **needed), schema)


def numbered(df: DataFrame, name: str, label: str = "numbered") -> DataFrame:
    """``df`` stored, with each row's place in the present order from 0.

    A row's place is its place in its partition behind all earlier partitions; only the
    partitions' sizes, one row each, are summed in one task and broadcast.
    """
    held = stored(df.withColumn("_id", F.monotonically_increasing_id()), label)
    part = F.shiftright("_id", 33)
    counts = held.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return (
        held.withColumn("_part", part).join(F.broadcast(counts), "_part")
        .withColumn(name, F.col("_before") + F.col("_id") - F.shiftleft("_part", 33))
        .drop("_id", "_part", "_before")
    )


def positions(df: DataFrame, order: list, name: str, label: str = "ordered") -> DataFrame:
    """``df`` with each row's place in the given order, from 0, dealt out by ranges of the order."""
    return numbered(df.repartitionByRange(*order).sortWithinPartitions(*order), name, label)
