"""Raw feeds to typed, keyed, deduplicated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierflow import schemas
from tierflow.functions import text as tx, times
from tierflow.functions.keys import entity_hour_key
from tierflow.operators.dedup import latest_by_key, version_order
from tierflow.operators.reconcile import union_tagged


def clean_actual(
    raw: DataFrame, strict: bool = False, since: str | None = None,
    new_year_fix: bool = False, reject: bool = True,
) -> DataFrame:
    """Typed columns of the raw actual feed. Unreadable values are NULL, or errors if strict.

    ``since`` limits the scan to rows scraped from that time text on.
    """
    rows = raw.filter(tx.usable_observation(F.col("observation_ts"))) if reject else raw
    if since is not None:
        rows = rows.filter(F.col("scraped_ts") >= since)
    scraped = times.from_text(F.col("scraped_ts"), strict)
    return rows.select(
        tx.normalised(F.col("province")).alias("province"),
        tx.normalised(F.col("city")).alias("city"),
        times.observed_at(
            F.col("observation_ts"), scraped, new_year_fix=new_year_fix, strict=strict
        ).alias("event_ts"),
        tx.digits_only(F.col("aqi"), strict).alias("aqi_val"),
        "aqi_status",
        "main_pollutant",
        tx.number_from_text(F.col("concentration"), "double", strict).alias("pollutant_val"),
        F.col("weather").alias("weather_condition"),
        tx.number_from_text(F.col("temperature"), "double", strict).alias("temp_val"),
        tx.number_from_text(F.col("humidity"), "int", strict).alias("humidity_val"),
        tx.number_from_text(F.col("wind_speed"), "double", strict).alias("wind_val"),
        F.col("wind_direction").alias("wind_dir"),
        "alert",
        scraped.alias("scraped_ts"),
    )


def clean_forecast(raw: DataFrame, strict: bool = False, since: str | None = None) -> DataFrame:
    """Typed columns of the raw forecast feed."""
    rows = raw.filter(tx.usable_observation(F.col("observation_ts")))
    if since is not None:
        rows = rows.filter(F.col("scraped_ts") >= since)
    scraped = times.from_text(F.col("scraped_ts"), strict)
    return rows.select(
        tx.normalised(F.col("province")).alias("province"),
        tx.normalised(F.col("city")).alias("city"),
        times.from_text(F.col("forecast_ts"), strict).alias("forecast_ts"),
        times.clock_on_scrape_day(F.col("observation_ts"), scraped, strict).alias("observation_ts"),
        tx.plain_int(F.col("aqi"), strict).alias("aqi_val"),
        F.col("weather").alias("weather_condition"),
        tx.number_from_text(F.col("temperature"), "double", strict).alias("temp_val"),
        tx.number_from_text(F.col("wind_speed"), "double", strict).alias("wind_val"),
        tx.number_from_text(F.col("humidity"), "int", strict).alias("humidity_val"),
        scraped.alias("scraped_ts"),
    )


def silver_actual(raw: DataFrame, **options) -> DataFrame:
    """Latest scrape per (city, event_ts) of the actual feed."""
    rows = latest_by_key(clean_actual(raw, **options), ["city", "event_ts"], "scraped_ts")
    keyed = rows.withColumn("id", entity_hour_key(F.col("city"), F.col("event_ts"), 3))
    return keyed.select(*schemas.SILVER_ACTUAL.names)


def silver_forecast(raw: DataFrame, **options) -> DataFrame:
    """Latest scrape per (city, forecast_ts) of the forecast feed."""
    rows = latest_by_key(clean_forecast(raw, **options), ["city", "forecast_ts"], "scraped_ts")
    keyed = rows.withColumn("id", entity_hour_key(F.col("city"), F.col("forecast_ts"), 3))
    return keyed.select(*schemas.SILVER_FORECAST.names)


def cast_rejects(raw: DataFrame, cleaned_columns: dict[str, tuple[str, Column]]) -> DataFrame:
    """Per cleaned column: how many non-NULL raw texts could not be read.

    ``cleaned_columns`` maps an output name to the raw column and its cleaning expression.
    """
    counts = [
        F.count_if(F.col(source).isNotNull() & cleaned.isNull()).alias(name)
        for name, (source, cleaned) in cleaned_columns.items()
    ]
    return raw.agg(F.count(F.lit(1)).alias("total_rows"), *counts)


def actual_rejects(raw: DataFrame) -> DataFrame:
    """Counts of unreadable values in the usable rows of the actual feed."""
    scraped = times.from_text(F.col("scraped_ts"))
    return cast_rejects(raw.filter(tx.usable_observation(F.col("observation_ts"))), {
        "event_ts": ("observation_ts", times.observed_at(F.col("observation_ts"), scraped)),
        "aqi_val": ("aqi", tx.digits_only(F.col("aqi"))),
        "pollutant_val": ("concentration", tx.number_from_text(F.col("concentration"))),
        "temp_val": ("temperature", tx.number_from_text(F.col("temperature"))),
        "humidity_val": ("humidity", tx.number_from_text(F.col("humidity"), "int")),
        "wind_val": ("wind_speed", tx.number_from_text(F.col("wind_speed"))),
    })


def unified_hourly(raw_actual: DataFrame, raw_forecast: DataFrame, year: int | None = None) -> DataFrame:
    """Both feeds in one hourly table: an actual row beats forecasts, then the latest wins.

    This older form takes rows as they come, without rejecting marker texts.
    """
    def common(df: DataFrame, event_ts: Column) -> DataFrame:
        return df.withColumns({
            "city": tx.normalised(F.col("city")),
            "event_ts": event_ts,
            "aqi": tx.plain_int(F.col("aqi")),
            "temp_c": tx.number_from_text(F.col("temperature")),
            "humidity_pct": tx.number_from_text(F.col("humidity"), "int"),
            "wind_speed_kmh": tx.number_from_text(F.col("wind_speed")),
            "scraped_ts": times.from_text(F.col("scraped_ts")),
        }).drop("province", "temperature", "humidity", "wind_speed", "observation_ts", "forecast_ts")

    scraped = times.from_text(F.col("scraped_ts"))
    both = union_tagged({
        "aqi_index": common(raw_actual, times.observed_at(F.col("observation_ts"), scraped, year)),
        "forecast_weather": common(raw_forecast, times.from_text(F.col("forecast_ts"))),
    })
    rank = F.when(F.col("data_source") == "aqi_index", 1).otherwise(2)
    rows = latest_by_key(both, ["city", "event_ts"], "scraped_ts", priority=rank)
    keyed = rows.withColumn("silver_record_id", entity_hour_key(F.col("city"), F.col("event_ts"), 3))
    return keyed.select(*schemas.UNIFIED_HOURLY.names)


# How versions of a key rank, for merging a run into the rows of earlier ones.
ACTUAL_ORDER = version_order(schemas.SILVER_ACTUAL, ["id", "city", "event_ts"], "scraped_ts")
FORECAST_ORDER = version_order(schemas.SILVER_FORECAST, ["id", "city", "forecast_ts"], "scraped_ts")

# Columns that the older merges overwrite when a key is matched.
UNIFIED_UPDATES = [c for c in schemas.UNIFIED_HOURLY.names if c not in ("silver_record_id", "city", "event_ts")]
ACTUAL_UPDATES = [
    c for c in schemas.SILVER_ACTUAL.names if c not in ("id", "province", "city", "event_ts", "scraped_ts")
]
FORECAST_UPDATES = [c for c in schemas.SILVER_FORECAST.names if c not in ("id", "province", "city")]
FORECAST_VALUE_UPDATES = ["aqi_val", "weather_condition", "temp_val", "wind_val", "humidity_val"]
