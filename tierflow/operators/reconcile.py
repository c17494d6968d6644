"""Bring two feeds of the same entities and times together."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tierflow.operators.dedup import latest_by_key
from tierflow.operators.merge import spread_null_keys

_SAFE_KEYS = ["_city", "_no_city", "_time"]
_PLAIN_KEYS = ["_city", "_time"]


def _prepared(
    df: DataFrame, prefix: str, time: str, since: Column | None, keep: str | None
) -> DataFrame:
    """Bound one input by its own time and, unless it is keyed, keep one row per key.

    In an unkeyed input the city enters as a NULL-safe pair of columns, so that the window
    and the join use the same partitioning.
    """
    rows = df.filter(F.col(time).isNotNull() if since is None else F.col(time) >= since)
    rows = rows.withColumnRenamed(time, "_time")
    if keep is None:
        rows, keys = rows.withColumnRenamed("city", "_city"), _PLAIN_KEYS
    else:
        keys = _SAFE_KEYS
        rows = rows.withColumns(
            {"_city": F.coalesce("city", F.lit("")), "_no_city": F.col("city").isNull()}
        ).drop("city")
        rows = latest_by_key(rows, keys, "scraped_ts", keep)
    others = [F.col(c).alias(prefix + c) for c in rows.columns if c not in keys]
    return rows.select(*keys, *others, F.lit(True).alias(prefix + "here"))


def reconcile(
    actual: DataFrame,
    forecast: DataFrame,
    shared: Mapping[str, str],
    actual_only: list[str],
    forecast_only: list[str],
    since: Column | None = None,
    keep: str = "first",
    prefer: str = "forecast",
    unique_inputs: bool = False,
) -> DataFrame:
    """Full outer reconciliation of two feeds on (city, time), one row per pair.

    ``shared`` maps an output name to the measure both feeds carry; the preferred feed
    wins and the other fills its gaps. Rows without a time are left out.

    * The time bound filters both inputs before the join, where it reaches the scans. A
      bound on the joined time would stay above a full outer join.
    * The choice between several scrapes of one (city, time) is made per input, ahead of
      the join, so many versions of one key never multiply into pairs. The join reuses
      the partitioning of that step: one shuffle per input in all.
    * Rows without a city match nothing, but compete for one place per time.
    * ``unique_inputs`` says that both inputs are keyed tables: one row per (city, time)
      and no row without a city. The step ahead of the join is then left out.
    """
    if prefer not in ("forecast", "actual"):
        raise ValueError("prefer must be 'forecast' or 'actual'")
    choice = None if unique_inputs else keep
    keys = _PLAIN_KEYS if unique_inputs else _SAFE_KEYS
    a = _prepared(actual, "a_", "event_ts", since, choice)
    f = _prepared(forecast, "f_", "forecast_ts", since, choice)
    joined = a.join(f, keys, "full")

    first, second = ("f_", "a_") if prefer == "forecast" else ("a_", "f_")
    hidden = {}
    if not unique_inputs:
        one, two = F.col(first + "scraped_ts"), F.col(second + "scraped_ts")
        beaten = (two < one) if keep == "first" else (two > one)
        beaten = F.coalesce(beaten, one.isNull() & two.isNotNull())
        rivals = F.col("_no_city") & F.col("a_here").isNotNull() & F.col("f_here").isNotNull()
        hidden = {first: rivals & beaten, second: rivals & ~beaten}

    def side(prefix: str, column: str) -> Column:
        value = F.col(prefix + column)
        return F.when(~hidden[prefix], value) if hidden else value

    def either(column: str) -> Column:
        return F.coalesce(side(first, column), side(second, column))

    city = F.col("_city") if unique_inputs else F.when(~F.col("_no_city"), F.col("_city"))
    return joined.select(
        F.coalesce(side("a_", "province"), side("f_", "province")).alias("province"),
        city.alias("city"),
        F.col("_time").alias("event_ts"),
        *[either(column).alias(name) for name, column in shared.items()],
        *[side("a_", c).alias(c) for c in actual_only],
        *[side("f_", c).alias(c) for c in forecast_only],
        either("scraped_ts").alias("scraped_ts"),
    )


def full_outer(actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """The plain full outer join on (city, time): every row and every pair of both feeds.

    Output columns carry the prefixes ``act_`` and ``fc_``. Rows with a NULL key, which
    match nothing, are spread over the tasks.
    """
    a = spread_null_keys(actual, ["city", "event_ts"], "spread")
    f = spread_null_keys(forecast, ["city", "forecast_ts"], "spread")
    a = a.select(*[F.col(c).alias(f"act_{c}") for c in a.columns])
    f = f.select(*[F.col(c).alias(f"fc_{c}") for c in f.columns])
    condition = [
        F.col("act_city") == F.col("fc_city"),
        F.col("act_event_ts") == F.col("fc_forecast_ts"),
        F.col("act_spread") == F.col("fc_spread"),
    ]
    return a.join(f, condition, "full").drop("act_spread", "fc_spread")


def union_tagged(feeds: Mapping[str, DataFrame], tag: str = "data_source") -> DataFrame:
    """UNION ALL by name with the feed's name in a column; absent columns read NULL."""
    result = None
    for name, df in feeds.items():
        tagged = df.withColumn(tag, F.lit(name))
        result = tagged if result is None else result.unionByName(tagged, allowMissingColumns=True)
    return result


def times_in_either(
    actual: DataFrame, forecast: DataFrame, scraped_since: Column | None = None
) -> DataFrame:
    """The distinct times of the reconciled feeds, optionally bounded by scrape time.

    Without a bound this is a distinct union: the full outer join would not add or drop a
    time. With a bound, a pair counts by the scrape time of its forecast row. All that is
    needed for it are maxima per (city, time), which aggregate ahead of the shuffle and
    so need no join and no window.
    """
    both = actual.select("city", F.col("event_ts").alias("ts"), F.col("scraped_ts").alias("a_at"),
                         F.lit(None).cast("timestamp_ntz").alias("f_at"), F.lit(0).alias("is_f"))
    both = both.unionAll(
        forecast.select("city", F.col("forecast_ts").alias("ts"), F.lit(None).cast("timestamp_ntz"),
                        F.col("scraped_ts"), F.lit(1))
    ).filter(F.col("ts").isNotNull())
    if scraped_since is None:
        return both.select("ts").distinct()
    # 1 = a forecast row without scrape time, for which the actual row's time counts.
    unstamped = F.when((F.col("is_f") == 1) & F.col("f_at").isNull(), 1).otherwise(0)
    per_key = both.groupBy("city", "ts").agg(
        F.max("a_at").alias("a_at"),
        F.max("f_at").alias("f_at"),
        F.max("is_f").alias("has_f"),
        F.max(unstamped).alias("unstamped"),
    )
    actual_counts = (F.col("has_f") == 0) | (F.col("unstamped") == 1) | F.col("city").isNull()
    inside = (F.col("f_at") >= scraped_since) | (actual_counts & (F.col("a_at") >= scraped_since))
    return per_key.filter(inside).select("ts").distinct()
