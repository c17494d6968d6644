"""Star schema: dimensions, the fact and checks on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierflow import schemas
from tierflow.functions import text as tx, times
from tierflow.functions.keys import entity_hour_key, surrogate_key
from tierflow.operators import lookup
from tierflow.operators.incremental import high_water, stamped
from tierflow.operators.merge import upsert
from tierflow.operators.partials import Partial
from tierflow.operators.reconcile import reconcile, times_in_either
from tierflow.operators.running import global_row_number

# Measures carried by both feeds: output name to the column of the typed tables.
MEASURES = {
    "aqi": "aqi_val",
    "weather_condition": "weather_condition",
    "temp_val": "temp_val",
    "humidity_val": "humidity_val",
    "wind_val": "wind_val",
}
ACTUAL_ONLY = ["aqi_status", "main_pollutant", "pollutant_val", "wind_dir", "alert"]
FORECAST_ONLY = ["observation_ts"]


def reconciled(actual: DataFrame, forecast: DataFrame, **options) -> DataFrame:
    return reconcile(actual, forecast, MEASURES, ACTUAL_ONLY, FORECAST_ONLY, **options)


def fact_rows(
    actual: DataFrame, forecast: DataFrame, state: DataFrame | None = None,
    days: int = 2, with_event_ts: bool = False, **options,
) -> DataFrame:
    """Fact rows from the bound of the state on, or all of them without a state.

    The foreign keys are hashes of the natural keys, so no dimension is joined.
    """
    since = high_water(state, "scraped_ts", days)
    rows = reconciled(actual, forecast, since=since, **options)
    keyed = rows.withColumns({
        "id": entity_hour_key(F.col("city"), F.col("event_ts"), 6),
        "city_id": surrogate_key(F.col("city")),
        "aqi_id": surrogate_key(F.col("aqi_status")),
        "date_id": times.date_key(F.col("event_ts")),
    })
    extra = ["event_ts"] if with_event_ts else []
    return keyed.select(*schemas.FACT.names, *extra)


def fact_merged(actual: DataFrame, forecast: DataFrame, state: DataFrame, days: int = 2, **options) -> DataFrame:
    """The fact table after an incremental run on top of its state.

    A run makes rows from the bound on only, and a row's key follows from its city and time.
    So the rows of the state that lie before the hour of the bound cannot be matched; they
    pass as they are, and the merge sees the others.
    """
    bound = times.date_key(high_water(state, "scraped_ts", days))
    recent = F.coalesce(F.col("date_id") >= bound, F.lit(True))
    merged = upsert(state.filter(recent), fact_rows(actual, forecast, state, days, **options), "id")
    return state.filter(~recent).unionByName(merged)


#: What is kept of the actual table per partition, so that its dimensions need not read it.
CITY_PARTIAL = Partial(
    "city", lambda: {"city": tx.normalised(F.col("city")), "province": tx.normalised(F.col("province"))},
    {"first_seen": ("min", "scraped_ts")},
)
CATEGORY_PARTIAL = Partial(
    "category", lambda: {"category": F.col("aqi_status")},
    {"min_val": ("min", "aqi_val"), "max_val": ("max", "aqi_val"), "first_seen": ("min", "scraped_ts")},
)


def dim_city(
    actual: DataFrame, as_of: Column, state: DataFrame | None = None, country: str = "Indonesia"
) -> DataFrame:
    pairs = actual.select(
        tx.normalised(F.col("city")).alias("city"), tx.normalised(F.col("province")).alias("province")
    ).distinct()
    return city_rows(pairs, as_of, state, country)


def city_rows(
    pairs: DataFrame, as_of: Column, state: DataFrame | None = None, country: str = "Indonesia"
) -> DataFrame:
    """The city dimension of distinct (city, province) pairs."""
    rows = pairs.select(
        surrogate_key(F.col("city")).alias("id"), "city", "province", F.lit(country).alias("country")
    )
    return stamped(rows, state, as_of)


def dim_category(actual: DataFrame, as_of: Column, state: DataFrame | None = None) -> DataFrame:
    rows = actual.groupBy(F.col("aqi_status").alias("category")).agg(
        F.min("aqi_val").alias("min_val"), F.max("aqi_val").alias("max_val")
    )
    return category_rows(rows, as_of, state)


def category_rows(ranges: DataFrame, as_of: Column, state: DataFrame | None = None) -> DataFrame:
    """The category dimension of one range per category."""
    rows = ranges.select(surrogate_key(F.col("category")).alias("id"), "category", "min_val", "max_val")
    return stamped(rows, state, as_of)


def dim_date(
    actual: DataFrame, forecast: DataFrame, as_of: Column, state: DataFrame | None = None,
    days: int = 2, grain: str = "exact",
) -> DataFrame:
    """Calendar rows of all times in either feed.

    With a state only times scraped within ``days`` of the latest actual scrape are given.
    ``grain='hour'`` truncates times first, which keeps ids unique when minutes differ.
    """
    if grain not in ("exact", "hour"):
        raise ValueError("grain must be 'exact' or 'hour'")
    since = None if state is None else high_water(actual, "scraped_ts", days)
    stamps = times_in_either(actual, forecast, since)
    if grain == "hour":
        # date_trunc would pass through the session zone.
        ts = F.col("ts")
        hour = F.make_timestamp_ntz(F.year(ts), F.month(ts), F.day(ts), F.hour(ts), F.lit(0), F.lit(0))
        stamps = stamps.select(hour.alias("ts")).distinct()
    parts = times.calendar_columns(F.col("ts"))
    return stamped(stamps.select(*[c.alias(n) for n, c in parts.items()]), state, as_of)


def with_current_flags(dates: DataFrame, as_of: Column) -> DataFrame:
    return dates.withColumns(times.current_flags(F.col("full_date_time"), as_of))


def build_dimension(df: DataFrame, natural_key: list[str], attributes: dict[str, Column]) -> DataFrame:
    """A dimension keyed by the hash of its natural key, with aggregated attributes."""
    grouped = df.groupBy(*natural_key)
    rows = grouped.agg(*[c.alias(n) for n, c in attributes.items()]) if attributes else df.select(*natural_key).distinct()
    return rows.select(
        surrogate_key(*[F.col(c) for c in natural_key]).alias("id"), *natural_key, *attributes
    )


def category_palette(df: DataFrame, category: Column, value: str) -> DataFrame:
    """Categories with their ranges, numbered by range, with display colours."""
    ranges = df.groupBy(category.alias("category")).agg(
        F.min(value).alias("min_val"), F.max(value).alias("max_val")
    )
    numbered = global_row_number(ranges, ["min_val", "category"], "aqi_range_id")
    return numbered.select(
        "aqi_range_id", "category", "min_val", "max_val",
        tx.category_colour(F.col("category")).alias("color_code"),
    )


def fact_with_lookups(
    actual: DataFrame, forecast: DataFrame, cities: DataFrame, categories: DataFrame,
    since: Column | None = None,
) -> DataFrame:
    """The older fact: actual values first, latest scrape, keys looked up in the dimensions.

    The category is the one whose observed range holds the value; overlapping ranges give
    several rows, a gap gives NULL.
    """
    rows = reconciled(actual, forecast, since=since, keep="last", prefer="actual")
    rows = rows.withColumn("fact_id", entity_hour_key(F.col("city"), F.col("event_ts"), 6))
    rows = lookup.dim_lookup(rows, cities, "city", "city", {"city_id": "id"})
    rows = lookup.band_lookup(rows, F.col("aqi"), categories, "min_val", "max_val", {"aqi_id": "id"})
    return rows.select(
        "fact_id", "event_ts", "city_id", "aqi", "aqi_id", "weather_condition", "temp_val",
        "humidity_val", "wind_val", "pollutant_val", "main_pollutant", "wind_dir", "alert",
        F.col("scraped_ts").alias("load_ts"), "observation_ts",
    )


# The columns that the older fact merge overwrites when a key is matched.
FACT_LOOKUP_UPDATES = [
    "city_id", "aqi", "aqi_id", "main_pollutant", "pollutant_val", "weather_condition",
    "temp_val", "humidity_val", "wind_val", "wind_dir", "alert", "load_ts",
]


def star_integrity(fact: DataFrame, cities: DataFrame, categories: DataFrame, dates: DataFrame) -> DataFrame:
    return lookup.orphans(fact, {
        "city_id": (cities, "id"), "aqi_id": (categories, "id"), "date_id": (dates, "id"),
    })
