"""Running state over long ordered groups, and global numbering."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from tierflow.session import checkpointed


def _as_before(column: pa.Array, last: pa.Array | None) -> np.ndarray:
    """Is each value equal to the one before it, NULL to NULL? The first is compared with ``last``."""
    before = pa.concat_arrays([column.slice(0, 1) if last is None else last, column.slice(0, len(column) - 1)])
    both_null = pc.and_(column.is_null(), before.is_null())
    same = pc.or_(pc.fill_null(pc.equal(column, before), False), both_null)
    return same.to_numpy(zero_copy_only=False)


def _folded(batches, group: list[str], hour: str):
    """Falls since the group's start in this partition, and the partition's first and last row.

    ``_edge`` is 1 on the first row, 2 on the last, 3 on an only one; ``_lead`` holds on the
    rows of the first group.
    """
    held, last, falls, lead = None, None, 0, True
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema.names
        same = np.ones(batch.num_rows, bool)
        for name in group:
            same &= _as_before(batch.column(name), None if last is None else last.column(name))
        hours = batch.column(hour).to_numpy(zero_copy_only=False)
        before = np.concatenate([[hours[0] if last is None else last.column(hour)[0].as_py()], hours[:-1]])
        step = np.cumsum(same & (hours < before)) + falls
        # What was counted up to a group's start does not count in it.
        starts = np.flatnonzero(~same)
        base = np.zeros(batch.num_rows, np.int64)
        base[starts] = step[starts]
        inside = step - np.maximum.accumulate(base)
        leads = np.cumsum(~same) == 0 if lead else np.zeros(batch.num_rows, bool)
        lead, falls = bool(leads[-1]), int(inside[-1])
        edge = np.zeros(batch.num_rows, np.int32)
        if held is None:
            edge[0] = 1
        else:
            yield held
        held = pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(inside), pa.array(leads), pa.array(edge)], [*names, "_inside", "_lead", "_edge"])
        last = batch.slice(batch.num_rows - 1, 1)
    if held is not None:
        edge = held.column("_edge").to_numpy().copy()
        edge[-1] += 2
        yield held.set_column(held.num_columns - 1, "_edge", pa.array(edge))


def day_offsets(
    df: DataFrame, group: list[str], order: list[str], hour: str, name: str = "day_offset",
) -> DataFrame:
    """Days passed since the start of each group: one more whenever the hour falls.

    Rows without an hour must have been removed. ``order`` is unique within a group.

    This is a prefix scan. The rows are dealt out by ranges of group and order, so a group
    of any size lies in as many partitions as it fills; each partition counts for itself
    and is summed up by its first and its last row. The summaries, two rows a partition, are
    scanned, and what they carry over is added to the rows of each partition's first group.
    The rows are shuffled once.
    """
    keys = [f"_g{i}" for i in range(len(group))]
    keyed = df.withColumns({k: F.col(g) for k, g in zip(keys, group)} | {"_hour": F.col(hour).cast("int")})
    laid = keyed.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    shape = T.StructType([*laid.schema.fields]).add("_inside", "long").add("_lead", "boolean").add("_edge", "integer")
    counted = laid.mapInArrow(lambda batches: _folded(batches, keys, "_hour"), shape)
    counted = checkpointed(counted.withColumn("_part", F.spark_partition_id()))

    edges = counted.filter("_edge > 0").select("_part", "_edge", "_hour", "_inside", "_lead", F.struct(*keys).alias("_group"))
    first = edges.filter("_edge IN (1, 3)").select("_part", F.col("_group").alias("first"), F.col("_hour").alias("opens"))
    last = edges.filter("_edge IN (2, 3)").select(
        "_part", F.col("_group").alias("last"), F.col("_hour").alias("closes"), F.col("_inside").alias("falls"), F.col("_lead").alias("single"))
    # One row per partition of the sort, so these windows are small by construction.
    line = Window.orderBy("_part")
    ends = first.join(last, "_part").withColumns({
        "goes_on": F.coalesce(F.col("first").eqNullSafe(F.lag("last").over(line)) & F.lag("_part").over(line).isNotNull(), F.lit(False)),
        "through": F.coalesce(F.lag("single").over(line), F.lit(False)),
        "adds": F.coalesce(F.lag("falls").over(line) + (F.col("opens") < F.lag("closes").over(line)).cast("long"), F.lit(0)),
    })
    chain = F.sum((~(F.col("goes_on") & F.col("through"))).cast("int")).over(line.rowsBetween(Window.unboundedPreceding, 0))
    ends = ends.withColumn("chain", chain).withColumn("adds", F.when(F.col("goes_on"), F.col("adds")).otherwise(0))
    to_here = Window.partitionBy("chain").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    carried = ends.select("_part", F.sum("adds").over(to_here).alias("_carried"))
    offset = F.col("_inside") + F.when(F.col("_lead"), F.col("_carried")).otherwise(0)
    return counted.join(F.broadcast(carried), "_part").select(*df.columns, offset.cast("int").alias(name))


def global_row_number(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number all rows by ``order``, which has to be unique.

    The rows are range-partitioned; each is numbered within its partition and shifted by
    the sizes of the partitions before it. A range's number and the places in it follow from
    the sort, so no row is gathered anywhere; only the sizes are summed, one row each.
    """
    ordering = [F.asc_nulls_last(c) for c in order]
    # The identifier holds the partition in its upper bits and the position below them.
    ranked = checkpointed(df.orderBy(*ordering).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = ranked.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # One row per partition of the sort, so this window is small by construction.
    before = F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")
    sizes = sizes.select("_part", before.alias("_before"))
    position = F.col("_id") - F.shiftleft(part, 33)
    return (
        ranked.join(sizes, part == F.col("_part"), "inner")
        .select(*df.columns, (F.col("_before") + position + 1).cast("int").alias(name))
    )
