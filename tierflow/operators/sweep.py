"""Range joins by a plane sweep over ranges of the axis.

Cut points, quantiles of the values, part the axis into ranges of about as many values each.
Rows go to their value's range and bands to every range they reach into. In a range rows and
bands come in order, a band at its low end; a task holds the bands that are open at the
moment and no others. Sorted values make it simple to find what a band holds: one run of
them. So no value is looked up by itself, none has to be made distinct, and no result is
joined back.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

ROWS_PER_RANGE = 1 << 14
PAIRS_AT_ONCE = 1 << 22
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def axis_type(*kinds: T.DataType) -> str:
    """Whole numbers are compared as such, everything else as doubles, as Spark does."""
    return "bigint" if all(isinstance(k, _INTEGRAL) for k in kinds) else "double"


def cut_points(df: DataFrame, column: str, most: int) -> list:
    """Quantiles of a column that part it into up to ``most`` ranges, in order.

    Only these few numbers come to the driver. A value with more rows than a range should
    have is several cut points in a row.
    """
    ranges = most
    fractions = [i / ranges for i in range(1, ranges)]
    cuts = F.percentile_approx(column, F.array(*map(F.lit, fractions)), 10 * ranges) if fractions else F.lit(None)
    count, found = df.select(F.count(column), cuts).first()
    wanted = min(most, max(1, count // ROWS_PER_RANGE))
    if not found or wanted == 1:
        return []
    step = ranges / wanted
    picked = [found[min(len(found) - 1, int(i * step) - 1)] for i in range(1, wanted)]
    return [cut for cut in picked if abs(cut) != float("inf") and cut == cut]


def place(column: str, cuts: Sequence, inclusive: bool, kind: str) -> Column:
    """The number of cut points below a column, or up to it: a binary search as an expression."""
    sign = "<=" if inclusive else "<"

    def search(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        return (f"CASE WHEN CAST('{cuts[middle]!r}' AS {kind}) {sign} {column} THEN {search(middle + 1, high)} "
                f"ELSE {search(low, middle)} END")

    return F.expr(f"CAST({search(0, len(cuts))} AS int)")


def _swept(at, low, high) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(value, band) places of all matches, and (value, -1) of values without any, in pieces."""
    step = max(1, PAIRS_AT_ONCE // max(1, len(low)))
    for start in range(0, len(at), step):
        own = at[start:start + step]
        first, last = np.searchsorted(own, low, "left"), np.searchsorted(own, high, "right")
        count = np.maximum(last - first, 0)
        band = np.repeat(np.arange(len(low)), count)
        value = np.arange(len(band)) - np.repeat(np.cumsum(count) - count - first, count)
        alone = np.flatnonzero(np.bincount(value, minlength=len(own)) == 0)
        yield np.concatenate([value, alone]) + start, np.concatenate([band, np.full(len(alone), -1)])


def _sweep(batches, n_rows: int, n_bands: int):
    """Batches hold: _at, _high, _kind, the columns of the rows, the columns of the bands."""
    low, high, bands = np.zeros(0), np.zeros(0), None
    for batch in batches:
        kind = batch.column(2).to_numpy(zero_copy_only=False)
        at = batch.column(0)
        empty = at.is_null().to_numpy(zero_copy_only=False)
        at = at.fill_null(0).to_numpy(zero_copy_only=False)
        new = np.flatnonzero(kind == 0)
        columns = batch.columns[3 + n_rows:]
        if len(new):
            opened = pa.Table.from_arrays([c.take(pa.array(new)) for c in columns], names=[str(i) for i in range(n_bands)])
            bands = opened if bands is None else pa.concat_tables([bands, opened])
            low = np.concatenate([low, at[new]]) if len(low) else at[new]
            ends = batch.column(1).take(pa.array(new)).to_numpy(zero_copy_only=False)
            high = np.concatenate([high, ends]) if len(high) else ends
        rows = np.flatnonzero(kind == 1)
        nulls, rows = rows[empty[rows]], rows[~empty[rows]]
        held = [c.combine_chunks() for c in bands.columns] if bands is not None else [pa.nulls(1, c.type) for c in columns]
        found = [(np.arange(len(nulls)), np.full(len(nulls), -1), nulls)] if len(nulls) else []
        found += [(value, band, rows) for value, band in _swept(at[rows], low, high)]
        for value, band, source in found:
            own, theirs = pa.array(source[value]), pa.array(np.where(band < 0, 0, band), mask=band < 0)
            yield pa.RecordBatch.from_arrays(
                [c.take(own) for c in batch.columns[3:3 + n_rows]] + [c.take(theirs) for c in held],
                names=batch.schema.names[3:])
        if len(rows) and bands is not None:
            # What lies behind the last value holds none of the values to come.
            open_ = np.flatnonzero(high >= at[rows[-1]])
            if len(open_) < len(high):
                low, high, bands = low[open_], high[open_], bands.take(pa.array(open_)).combine_chunks()


def sweep_join(df: DataFrame, value: Column, bands: DataFrame, low: str, high: str, columns: dict[str, str]) -> DataFrame:
    """Left range join: every band with ``low <= value <= high`` of each row, or NULLs without one.

    The columns of the bands come under the names that ``columns`` maps to them. A range that
    is full of one value is dealt over several tasks, each of which gets the bands around it.
    Rows without a value are spread over all tasks. NaN lies in no band.
    """
    side = bands.select(F.col(low).alias("_low"), F.col(high).alias("_high"), *[F.col(c).alias(f"_b{i}") for i, c in enumerate(columns.values())])
    valued = df.withColumn("_value", value)
    kind = axis_type(valued.schema["_value"].dataType, side.schema["_low"].dataType, side.schema["_high"].dataType)
    side = side.withColumns({"_low": F.col("_low").cast(kind), "_high": F.col("_high").cast(kind)}).filter("_low <= _high")
    valued = valued.withColumn("_value", F.col("_value").cast(kind))
    if kind == "double":
        valued = valued.withColumn("_value", F.when(~F.isnan("_value"), F.col("_value")))
        side = side.filter(~F.isnan("_high"))
    cuts = cut_points(valued, "_value", int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = len(cuts) + 1

    # A value on a cut point may go to either side of it, so equal values are dealt out evenly.
    own = F.monotonically_increasing_id()
    first, last = place("_value", cuts, False, kind), place("_value", cuts, True, kind)
    part = F.coalesce(first + F.pmod(own, last - first + 1), F.pmod(own, F.lit(parts))).cast("int")
    names = [f"_r{i}" for i in range(len(df.columns))]
    rows = valued.select(
        part.alias("_part"), F.col("_value").alias("_at"), F.lit(None).cast(kind).alias("_high"), F.lit(1).alias("_kind"),
        *[F.col(c).alias(n) for c, n in zip(df.columns, names)],
        *[F.lit(None).cast(side.schema[f"_b{i}"].dataType).alias(f"_b{i}") for i in range(len(columns))])
    reach = F.explode(F.sequence(place("_low", cuts, False, kind), place("_high", cuts, True, kind)))
    spans = side.select(
        reach.alias("_part"), F.col("_low").alias("_at"), "_high", F.lit(0).alias("_kind"),
        *[F.lit(None).cast(df.schema[c].dataType).alias(n) for c, n in zip(df.columns, names)],
        *[f"_b{i}" for i in range(len(columns))])
    met = rows.unionAll(spans).repartitionById(parts, F.col("_part")).drop("_part").sortWithinPartitions(
        F.asc_nulls_first("_at"), "_kind")
    shape = T.StructType([T.StructField(n, df.schema[c].dataType) for c, n in zip(df.columns, names)]
                         + [T.StructField(f"_b{i}", side.schema[f"_b{i}"].dataType) for i in range(len(columns))])
    n_rows, n_bands = len(names), len(columns)
    return met.mapInArrow(lambda batches: _sweep(batches, n_rows, n_bands), shape).toDF(*df.columns, *columns)
