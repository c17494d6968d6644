"""The layered tables on storage: raw pages to the star schema, run by run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tierflow import schemas
from tierflow.operators.merge import upsert
from tierflow.operators.partials import Partial
from tierflow.plans import gold, silver
from tierflow.session import scratch_path
from tierflow.sources import commits, pages as pg, tables
from tierflow.sources.tables import month_of, table_path
from tierflow.streaming.trigger import run_when_all_changed


def load_pages(pages: DataFrame, base: str) -> dict[str, int]:
    """Parse stored pages once and append both raw tables and the quarantine.

    The parsed records are stored for the time of the load, so each page is parsed once
    whatever is derived from it. Returns what became of pages and cells, counted while the
    records were written.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "parsed-pages")
    seen = Observation("outcomes")
    parsed = pg.parsed_pages(pages)
    parsed.observe(seen, *[c.alias(n) for n, c in pg.outcome_counts().items()]).write.parquet(path)
    parsed = spark.read.schema(parsed.schema).parquet(path)
    rows = {
        "raw_aqi_index": pg.parsed_current(parsed),
        "raw_weather_forecast": pg.forecast_rows(pg.parsed_cells(parsed)),
        "page_quarantine": pg.parsed_quarantine(parsed),
    }
    added = {name: tables.append(df, table_path(base, "bronze", name)) for name, df in rows.items()}
    tables.drop_table(spark, path)
    return {**{name: count or 0 for name, count in seen.get.items()}, **added}


def load_raw(pages: DataFrame, base: str) -> dict[str, int]:
    """Append the rows of stored pages to both raw tables. Returns the rows added to each."""
    outcomes = load_pages(pages, base)
    return {name: outcomes[name] for name in ("raw_aqi_index", "raw_weather_forecast")}


SILVER_KINDS = {"p_city": "string", "p_month": "string"}
PARTIALS = (gold.CITY_PARTIAL, gold.CATEGORY_PARTIAL)


@dataclass(frozen=True)
class Feed:
    """How a raw table becomes its typed one."""

    raw: str
    raw_schema: StructType
    table: str
    clean: Callable[..., DataFrame]
    time: str
    order: list[tuple[str, bool]]
    options: dict
    partials: tuple[Partial, ...] = ()

    def partitions(self) -> dict[str, Column]:
        return {"p_city": F.col("city"), "p_month": month_of(self.time)}


FEEDS = {
    "actual": Feed(
        "raw_aqi_index", schemas.RAW_ACTUAL, "aqi_index", silver.silver_actual, "event_ts",
        silver.ACTUAL_ORDER, {}, PARTIALS,
    ),
    # The time of observation changes from scrape to scrape, the city does not.
    "forecast": Feed(
        "raw_weather_forecast", schemas.RAW_FORECAST, "weather_forecast", silver.silver_forecast,
        "observation_ts", silver.FORECAST_ORDER, {"scope": ["p_city"]},
    ),
}


def refresh_feed(
    spark: SparkSession, base: str, name: str, batch: str, since: str | None = None,
    full_refresh: bool = False,
) -> bool:
    """Clean the raw files that have come since the last run and merge them. Was there any?

    A ledger beside the table holds the raw files that it has seen, so a run reads new files
    only. The files of a run are claimed before they are read and entered once their rows
    are in the table; a run that is lost in between is repeated with the same files, and
    merging their rows again changes nothing.

    Rows without a key are left out of the stored tables: as they match nothing, each run
    would add them once more. ``since`` is a time text; with it all raw files are read, and
    none is entered, as their older rows are left out.
    """
    feed = FEEDS[name]
    raw, path = table_path(base, "bronze", feed.raw), table_path(base, "silver", feed.table)
    if full_refresh:
        tables.drop_table(spark, path)
        commits.forget(spark, path)
        for partial in feed.partials:
            partial.drop(spark, path)
    if since is None:
        rows = commits.scan_files(spark, raw, feed.raw_schema, commits.claim_files(spark, raw, path, batch))
    else:
        rows = tables.scan(spark, raw, feed.raw_schema)
    if rows is None:
        commits.settle_files(spark, path, batch)
        return False

    def published(merged: DataFrame, high: datetime | None) -> None:
        for partial in feed.partials:
            partial.write(merged, path, feed.partitions())
        commits.record_batch(spark, path, batch, high)

    # One version per key is what cleaning leaves, so the keys need no check.
    tables.upsert_table(
        feed.clean(rows, since=since), path, "id", feed.partitions(), [feed.time], batch,
        published=published, high="scraped_ts", newer_by=feed.order, drop_null_keys=True, check_unique=False,
        **feed.options,
    )
    commits.settle_files(spark, path, batch)
    return True


def refresh_silver(
    spark: SparkSession, base: str, batch: str, since: str | None = None,
    full_refresh: bool = False,
) -> None:
    """Bring both typed tables up to date with their raw tables."""
    for name in FEEDS:
        refresh_feed(spark, base, name, batch, since, full_refresh)


def gold_on_change(
    spark: SparkSession, base: str, state: str, as_of: Column, **options
) -> StreamingQuery:
    """Refresh the star once both typed tables have changed since it was last refreshed."""
    paths = {name: table_path(base, "silver", feed.table) for name, feed in FEEDS.items()}
    return run_when_all_changed(
        spark, paths, state, lambda run: refresh_gold(spark, base, run, as_of, **options)
    )


def silver_tables(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    kinds = SILVER_KINDS
    return (
        tables.scan_partitioned(
            spark, table_path(base, "silver", "aqi_index"), schemas.SILVER_ACTUAL, kinds
        ).drop(*kinds),
        tables.scan_partitioned(
            spark, table_path(base, "silver", "weather_forecast"), schemas.SILVER_FORECAST, kinds
        ).drop(*kinds),
    )


def silver_partial(spark: SparkSession, base: str, partial: Partial) -> DataFrame:
    """What is kept of the actual table, merged over its partitions."""
    return partial.read(spark, table_path(base, "silver", "aqi_index"), schemas.SILVER_ACTUAL, SILVER_KINDS)


# dim_date lies in folders by year; the other dimensions are small.
DIMENSION_FOLDERS = {"dim_date": "p_year"}
KEPT_VERSIONS = 5


def dimension(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest version of a dimension, or None."""
    latest = tables.latest_version(spark, path)
    return None if latest is None else spark.read.parquet(latest).drop(*DIMENSION_FOLDERS.values())


def refresh_dimension(
    spark: SparkSession, path: str, build: Callable[[DataFrame | None], DataFrame],
    full_refresh: bool = False, partitions: dict[str, Column] | None = None, keep: int | None = KEPT_VERSIONS,
) -> DataFrame:
    """Merge a dimension into its latest version and write the result as a new one.

    Rows without a key would match nothing and be added by every run, so they are left out.
    The newest ``keep`` versions stay for those who read them.
    """
    state = None if full_refresh else dimension(spark, path)
    merged = upsert(state, build(state), "id", drop_null_keys=True)
    tables.write_version(merged, path, keep, partitions)
    return dimension(spark, path)


def refresh_gold(
    spark: SparkSession, base: str, batch: str, as_of: Column, full_refresh: bool = False,
    grain: str = "hour",
) -> None:
    """Bring the dimensions and the fact up to date with the typed tables."""
    actual, forecast = silver_tables(spark, base)

    def refresh(name, build, **options):
        refresh_dimension(spark, table_path(base, "gold", name), build, full_refresh, **options)

    pairs = silver_partial(spark, base, gold.CITY_PARTIAL)
    refresh("dim_city", lambda state: gold.city_rows(pairs, as_of, state))
    ranges = silver_partial(spark, base, gold.CATEGORY_PARTIAL)
    refresh("dim_aqi", lambda state: gold.category_rows(ranges, as_of, state))
    refresh(
        "dim_date", lambda state: gold.dim_date(actual, forecast, as_of, state, grain=grain),
        partitions={DIMENSION_FOLDERS["dim_date"]: F.col("year_val").cast("int")},
    )

    path = table_path(base, "gold", "fact_aqi_weather")
    if full_refresh:
        tables.drop_table(spark, path)
    state = fact_table(spark, base) if tables.exists(spark, path) else None
    rows = gold.fact_rows(actual, forecast, state, unique_inputs=True)
    # A fact key holds the city, and the day's partition follows from it too.
    tables.upsert_table(
        rows, path, "id",
        {"p_city_id": F.col("city_id"), "p_month": F.floor(F.col("date_id") / 10000).cast("int")},
        ["date_id"], batch,
    )


def fact_table(spark: SparkSession, base: str) -> DataFrame:
    kinds = {"p_city_id": "string", "p_month": "integer"}
    return tables.scan_partitioned(
        spark, table_path(base, "gold", "fact_aqi_weather"), schemas.FACT, kinds
    ).drop(*kinds)


def register_views(spark: SparkSession, base: str) -> list[str]:
    """Make the tables known to ``spark.sql`` as views named ``layer_table``."""
    actual, forecast = silver_tables(spark, base)
    views = {
        "bronze_raw_aqi_index": tables.scan(
            spark, table_path(base, "bronze", "raw_aqi_index"), schemas.RAW_ACTUAL
        ),
        "bronze_raw_weather_forecast": tables.scan(
            spark, table_path(base, "bronze", "raw_weather_forecast"), schemas.RAW_FORECAST
        ),
        "silver_aqi_index": actual,
        "silver_weather_forecast": forecast,
        "gold_fact_aqi_weather": fact_table(spark, base),
    }
    for name in ("dim_city", "dim_aqi", "dim_date"):
        rows = dimension(spark, table_path(base, "gold", name))
        if rows is not None:
            views[f"gold_{name}"] = rows
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
