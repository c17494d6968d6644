"""Lookups in dimensions, bands and fixed maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierflow.operators.sweep import sweep_join


def dim_lookup(
    df: DataFrame, dim: DataFrame, on: str, dim_key: str, columns: dict[str, str]
) -> DataFrame:
    """Left lookup of dimension columns by a key; ``columns`` maps output to dimension names.

    There is no broadcast hint: Spark broadcasts the dimension when its measured size
    allows it, and otherwise joins by sorting, splitting skewed keys.
    """
    side = dim.select(F.col(dim_key).alias("_dim"), *[F.col(c).alias(n) for n, c in columns.items()])
    return df.join(side, F.col(on) == F.col("_dim"), "left").drop("_dim")


FEW_BANDS = 64


def band_lookup(
    df: DataFrame,
    value: Column,
    bands: DataFrame,
    low: str,
    high: str,
    columns: dict[str, str],
    few: int = FEW_BANDS,
) -> DataFrame:
    """Left range lookup: every band with ``low <= value <= high``, or NULLs without one.

    Up to ``few`` bands, which are read first, become literals that each row is compared
    with, without any shuffle. More bands are found by a sweep over sorted ranges, see
    ``sweep_join``. Both give the same rows.
    """
    side = bands.select(F.col(low).alias("_low"), F.col(high).alias("_high"), *[
        F.col(c).alias(n) for n, c in columns.items()])
    read = side.limit(few + 1).collect()
    if len(read) > few:
        return sweep_join(df, value, bands, low, high, columns)
    known = F.broadcast(df.sparkSession.createDataFrame(read, side.schema))
    valued = df.withColumn("_value", value)
    return valued.join(known, F.col("_value").between(F.col("_low"), F.col("_high")), "left").select(*df.columns, *columns)


def orphans(
    df: DataFrame, foreign_keys: dict[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Per foreign key: rows in all, rows with a NULL key, and rows without a partner.

    Keys are counted before they are looked up, so the join sees each key once however
    many rows carry it, and the table is read once for all keys.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("fk"), F.col(name).cast("string").alias("key"))
        for name in foreign_keys
    ]))
    used = df.select(pairs.alias("p")).groupBy("p.fk", "p.key").agg(F.count(F.lit(1)).alias("n"))
    known = None
    for name, (dim, key) in foreign_keys.items():
        part = dim.select(F.lit(name).alias("fk"), F.col(key).cast("string").alias("key")).distinct()
        known = part if known is None else known.unionAll(part)
    known = known.withColumn("known", F.lit(True))
    joined = used.join(known, ["fk", "key"], "left")
    missing = F.col("key").isNotNull() & F.col("known").isNull()
    return joined.groupBy("fk").agg(
        F.sum("n").alias("total_rows"),
        F.sum(F.when(F.col("key").isNull(), F.col("n")).otherwise(0)).alias("null_rows"),
        F.sum(F.when(missing, F.col("n")).otherwise(0)).alias("orphan_rows"),
    )


