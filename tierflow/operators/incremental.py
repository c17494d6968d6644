"""Incremental bounds, audit stamps and rolling windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: the lower bound of a first run.
FIRST_RUN = "2020-01-01 00:00:00"


def high_water(df: DataFrame | None, column: str, days: int = 2) -> Column:
    """``max(column) - days`` as a scalar subquery, or a fixed early time without state.

    The bound is computed inside the query: Spark evaluates it once and pushes the
    comparison down to the scans that use it. An empty state has no latest time; it gets
    the early time too, else no later run would ever load anything.
    """
    first = F.lit(FIRST_RUN).cast("timestamp_ntz")
    if df is None:
        return first
    bound = F.coalesce(F.max(column) - F.make_dt_interval(F.lit(days)), first)
    return df.select(bound.alias("bound")).scalar()


def since_day(as_of: str, days: int = 1) -> Column:
    """Midnight of the day ``days`` before ``as_of``."""
    return F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz")


def stamped(
    df: DataFrame, state: DataFrame | None, as_of: Column, key: str = "id",
    created: str = "created_at", updated: str = "updated_at",
) -> DataFrame:
    """Add audit columns; the creation stamp of a key that the state knows is kept.

    The state is reduced to its earliest stamp per key, so duplicates in it cannot
    multiply rows.
    """
    if state is None:
        return df.withColumn(created, as_of).withColumn(updated, as_of)
    known = (
        state.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_known"))
        .agg(F.min(created).alias("_created"))
    )
    joined = df.join(known, F.col(key) == F.col("_known"), "left")
    return joined.select(
        *df.columns,
        F.coalesce(F.col("_created"), as_of).alias(created),
        as_of.alias(updated),
    )
