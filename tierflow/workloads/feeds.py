"""Raw feeds derived from ``events`` and stored pages derived from ``customer``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierflow.functions.times import timestamp_text

ACTUAL_TYPES = ["click", "view", "error"]
FORECAST_TYPES = ["purchase", "signup"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hour_text():
    hour = F.lpad(F.hour("ts").cast("string"), 2, "0")
    return F.concat(hour, F.lit(":00, "), F.date_format(F.to_date("ts"), "MMM dd"))


def _observation():
    return (
        F.when(F.col("event_id") % 97 == 0, "N/A")
        .when(F.col("event_id") % 89 == 0, "Air quality")
        .otherwise(_hour_text())
    )


def _with_unit(unit: str, integral: bool = False):
    value = F.floor("value").cast("int") if integral else F.col("value")
    return F.concat(value.cast("string"), F.lit(unit))


def _place():
    return {
        "province": F.concat(F.lit(" Region "), (F.col("user_id") % 5).cast("string"), F.lit(" ")),
        "city": F.concat(F.lit("  City "), (F.col("user_id") % 20).cast("string"), F.lit(" ")),
    }


def raw_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").filter(F.col("event_type").isin(ACTUAL_TYPES))
    columns = _place() | {
        "aqi": _with_unit("*", integral=True),
        "aqi_status": F.col("event_type"),
        "main_pollutant": F.when(F.col("event_id") % 3 == 0, "PM2.5").otherwise("PM10"),
        "concentration": F.when(F.col("event_id") % 11 == 0, "-").otherwise(_with_unit(" µg/m³")),
        "weather": F.when(F.col("event_id") % 4 == 0, "Rain").otherwise("Clear Sky"),
        "temperature": _with_unit("°"),
        "humidity": _with_unit("%", integral=True),
        "wind_speed": _with_unit(" km/h"),
        "wind_direction": F.when(F.col("event_id") % 2 == 0, "North").otherwise("South West"),
        "alert": F.lit("No Alert"),
        "observation_ts": _observation(),
        "scraped_ts": timestamp_text(F.col("ts"), 6),
    }
    return events.select(*[c.alias(n) for n, c in columns.items()])


def raw_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").filter(F.col("event_type").isin(FORECAST_TYPES))
    columns = _place() | {
        "forecast_ts": F.concat(F.substring(F.col("ts").cast("string"), 1, 13), F.lit(":00:00")),
        "aqi": F.floor("value").cast("int").cast("string"),
        "weather": F.when(F.col("event_id") % 4 == 0, "Rain").otherwise("Clear Sky"),
        "temperature": _with_unit("°"),
        "wind_speed": F.when(F.col("event_id") % 13 == 0, "-").otherwise(_with_unit(" km/h")),
        "humidity": _with_unit("%", integral=True),
        "observation_ts": _observation(),
        "scraped_ts": timestamp_text(F.col("ts"), 6),
    }
    return events.select(*[c.alias(n) for n, c in columns.items()])


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _page_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer to make a page of, fetched 37 minutes after the one before."""
    # A page is far larger, and far more work, than the row it is made from. The narrow rows
    # are spread before they grow. Without a number Spark would judge by their present size
    # and join the partitions again.
    rows = table(spark, sf_dir, "customer").repartition(2 * spark.sparkContext.defaultParallelism, "c_custkey")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    rows = rows.withColumn("ts", F.timestamp_add("MINUTE", F.col("c_custkey") * 37, start))
    return rows.select(
        F.concat(F.lit("region-"), (F.col("c_nationkey") % 5).cast("string")).alias("province"),
        F.concat(F.lit("new-city-"), F.col("c_nationkey").cast("string")).alias("city"),
        F.col("ts").alias("fetched_ts"), F.col("c_custkey").alias("number"),
        F.lower("c_mktsegment").alias("status"), F.abs("c_acctbal").alias("value"),
        _hour_text().alias("hour_text"),
    )


def current_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page with a current observation per customer; every fifth one lacks its card."""
    angle = F.floor(F.col("value") * 7).cast("int") % 360
    code = F.lpad((F.col("number") % 14).cast("string"), 2, "0")
    card = _text(
        '<div class="p-4 bg-white rounded"><div><img alt="weather condition icon" src="/icons/weather-',
        code, 'd.svg"><p>', F.col("value"), '°</p><p>', F.floor("value").cast("int"),
        '%</p></div><p>', F.col("value"), ' km/h</p><img alt="wind direction icon" style="transform:rotate(',
        angle, 'deg)"></div>',
    )
    html = _text(
        "<!DOCTYPE html><html><head><script>var p='<p class=\"truncate\">x</p>';</script></head><body>",
        '<div><p class="text-sm truncate">',
        F.when(F.col("number") % 3 == 0, "Now").otherwise(_text("Alert &amp; ", F.col("status"))),
        '</p></div><div class="card aqi-bg-yellow"><p class="text-lg font-medium"> ',
        F.floor("value").cast("int"), '* </p><p class="font-body-l-medium">', F.col("status"),
        '</p></div><div class="font-body-m-medium"><p>Main pollutant</p><p>PM2.5</p><p>',
        F.col("value"), '&nbsp;µg/m³</p></div>',
        F.when(F.col("number") % 5 == 0, "").otherwise(card),
        '<h2>Air quality • ', F.col("hour_text"), ' Local time</h2></body></html>',
    )
    return _page_base(spark, sf_dir).withColumn("html", _damaged(html, F.col("number") % 11 == 5))


def _damaged(html, when):
    """Some pages begin with a marked section of an unknown kind, on which the parser gives up."""
    return F.when(when, F.concat(F.lit("<![foo bar]]>"), html)).otherwise(html)


def forecast_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per customer with a table of six cells, some of which cannot be read.

    Cell i shows the hour i * 5 hours after the scrape; cell 0 says ``Now``. Cell 3 has no
    readable hour on every seventh page, and cell 2 a metric without value on every ninth.
    """
    hour = F.hour("fetched_ts")

    def cell(i):
        broken_hour = (F.col("number") % 7 == 0) & (i == 3)
        clock = (
            F.when(i == 0, "Now").when(broken_hour, "--")
            .otherwise(_text(F.lpad(((hour + i * 5) % 24).cast("string"), 2, "0"), ":00"))
        )
        broken_metric = (F.col("number") % 9 == 0) & (i == 2)
        metric = F.when(broken_metric, "<b>?</b>").otherwise(
            _text('<p class="font-medium">', F.col("value"), ' km/h</p>')
        )
        code = F.lpad(((F.col("number") + i) % 14).cast("string"), 2, "0")
        return _text(
            '<td><p class="max-w-12"> ', clock, ' </p><img src="/img/ic-w-', code, 'd.svg">',
            '<div class="aqi-bg-green w-8">', F.floor("value").cast("int") + i,
            '</div><p class="font-medium">', F.col("value"), '°</p>',
            '<div class="flex flex-col items-center">', metric, '</div>',
            '<div class="flex flex-col items-center"><p class="font-medium">', i * 10, '%</p></div></td>',
        )

    cells = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(5)), cell), "")
    html = _text(
        '<html><body><h2>Now at ', F.col("hour_text"), '</h2><table><tr>', cells,
        '<td>no clock</td></tr></table></body></html>',
    )
    return _page_base(spark, sf_dir).withColumn("html", _damaged(html, F.col("number") % 13 == 5))
