"""Declared table schemas. Readers always pass one; nothing is inferred."""

from pyspark.sql import types as T


def _struct(kind, names):
    return [T.StructField(name, kind, True) for name in names.split()]


_TS = T.TimestampNTZType()

RAW_ACTUAL = T.StructType(_struct(
    T.StringType(),
    "province city aqi aqi_status main_pollutant concentration weather temperature "
    "humidity wind_speed wind_direction alert observation_ts scraped_ts",
))

RAW_FORECAST = T.StructType(_struct(
    T.StringType(),
    "province city forecast_ts aqi weather temperature wind_speed humidity "
    "observation_ts scraped_ts",
))

SILVER_ACTUAL = T.StructType(
    _struct(T.StringType(), "id province city")
    + _struct(_TS, "event_ts")
    + _struct(T.IntegerType(), "aqi_val")
    + _struct(T.StringType(), "aqi_status main_pollutant")
    + _struct(T.DoubleType(), "pollutant_val")
    + _struct(T.StringType(), "weather_condition")
    + _struct(T.DoubleType(), "temp_val")
    + _struct(T.IntegerType(), "humidity_val")
    + _struct(T.DoubleType(), "wind_val")
    + _struct(T.StringType(), "wind_dir alert")
    + _struct(_TS, "scraped_ts")
)

SILVER_FORECAST = T.StructType(
    _struct(T.StringType(), "id province city")
    + _struct(_TS, "forecast_ts observation_ts")
    + _struct(T.IntegerType(), "aqi_val")
    + _struct(T.StringType(), "weather_condition")
    + _struct(T.DoubleType(), "temp_val wind_val")
    + _struct(T.IntegerType(), "humidity_val")
    + _struct(_TS, "scraped_ts")
)

UNIFIED_HOURLY = T.StructType(
    _struct(T.StringType(), "silver_record_id city")
    + _struct(_TS, "event_ts")
    + _struct(T.IntegerType(), "aqi")
    + _struct(T.StringType(), "aqi_status main_pollutant concentration weather")
    + _struct(T.DoubleType(), "temp_c")
    + _struct(T.IntegerType(), "humidity_pct")
    + _struct(T.DoubleType(), "wind_speed_kmh")
    + _struct(T.StringType(), "wind_direction alert")
    + _struct(_TS, "scraped_ts")
    + _struct(T.StringType(), "data_source")
)

DIM_CITY = T.StructType(
    _struct(T.StringType(), "id city province country") + _struct(_TS, "created_at updated_at")
)

DIM_CATEGORY = T.StructType(
    _struct(T.StringType(), "id category")
    + _struct(T.IntegerType(), "min_val max_val")
    + _struct(_TS, "created_at updated_at")
)

DIM_DATE = T.StructType(
    _struct(T.LongType(), "id")
    + _struct(_TS, "full_date_time")
    + _struct(T.DateType(), "full_date")
    + _struct(T.LongType(), "year_val quarter_val")
    + _struct(T.StringType(), "quarter_name")
    + _struct(T.IntegerType(), "semester_val")
    + _struct(T.StringType(), "semester_name")
    + _struct(T.LongType(), "month_val")
    + _struct(T.StringType(), "month_name")
    + _struct(T.LongType(), "week_of_year")
    + _struct(T.IntegerType(), "week_of_month")
    + _struct(T.LongType(), "day_val")
    + _struct(T.StringType(), "day_name")
    + _struct(T.LongType(), "hour_val")
    + _struct(T.BooleanType(), "is_weekend")
    + _struct(_TS, "created_at updated_at")
)

FACT = T.StructType(
    _struct(T.StringType(), "id city_id aqi_id")
    + _struct(T.LongType(), "date_id")
    + _struct(T.IntegerType(), "aqi")
    + _struct(T.StringType(), "weather_condition")
    + _struct(T.DoubleType(), "temp_val")
    + _struct(T.IntegerType(), "humidity_val")
    + _struct(T.DoubleType(), "wind_val pollutant_val")
    + _struct(T.StringType(), "main_pollutant wind_dir alert")
    + _struct(_TS, "scraped_ts observation_ts")
)

STORED_PAGES = T.StructType(
    _struct(T.StringType(), "url province city html") + _struct(_TS, "fetched_ts")
)

LOCATIONS = T.StructType([
    T.StructField("province", T.StringType(), True),
    T.StructField("cities", T.ArrayType(T.StringType()), True),
])

# Older column names of the raw tables, mapped to the present ones.
RENAMED_COLUMNS = {"observation_time": "observation_ts", "scraped_at": "scraped_ts"}
