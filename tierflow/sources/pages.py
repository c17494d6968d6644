"""Turn stored web pages into raw feed rows.

Reading the markup is the only Python on the data path. Spark hands Arrow batches of pages
to it and gets one nested record per page back; all interpretation of the texts (labels,
defaults, times, routing by unit) is done with column expressions afterwards, and no step
shuffles: everything about a page lies in its row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from itertools import accumulate, pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tierflow.functions import text as tx, times
from tierflow.sources.markup import Page

_STR = T.StringType()
_TEXTS = T.ArrayType(_STR)

CURRENT_RECORD = T.StructType([
    T.StructField("alert", _STR), T.StructField("aqi", _STR), T.StructField("aqi_status", _STR),
    T.StructField("details", _TEXTS), T.StructField("icon", _STR),
    T.StructField("measures", _TEXTS), T.StructField("wind_style", _STR),
    T.StructField("heading", _STR),
])

CELL = T.StructType([
    T.StructField("pos", T.IntegerType()), T.StructField("clock", _STR),
    T.StructField("hour", T.IntegerType()), T.StructField("day_offset", T.IntegerType()),
    T.StructField("icon", _STR), T.StructField("aqi", _STR), T.StructField("temperature", _STR),
    T.StructField("wind_speed", _STR), T.StructField("humidity", _STR),
    T.StructField("error", _STR),
])

FORECAST_RECORD = T.StructType([
    T.StructField("heading", _STR), T.StructField("cells", T.ArrayType(CELL)),
])

# Both parts of a page read at once, each with the reason if it cannot be read.
PARSED_RECORD = T.StructType([
    T.StructField("current", CURRENT_RECORD), T.StructField("current_error", _STR),
    T.StructField("forecast", FORECAST_RECORD), T.StructField("forecast_error", _STR),
    T.StructField("html", _STR),
])

PAGE_RECORD = T.StructType([
    T.StructField("lang", _STR), T.StructField("title", _STR), T.StructField("h1", _STR),
    T.StructField("country", _STR),
])

FAILURE = T.StructType([T.StructField("html", _STR), T.StructField("error", _STR)])

ITEM = T.StructType([
    T.StructField("pos", T.IntegerType()), T.StructField("href", _STR),
    T.StructField("label", _STR), T.StructField("error", _STR),
])


# What is made of so many pages is handed on before the next ones are read, however many
# rows an Arrow batch has.
PAGES_AT_ONCE = 64

# What a page can do to the tokenizer. Anything else is a failure of the job, not of the page.
UNREADABLE = (AssertionError, ValueError)


def reason_of(problem: Exception) -> str:
    return f"{type(problem).__name__}: {problem}"


def read_pages(
    df: DataFrame, read: Callable[[dict], object], record: T.DataType, html: str = "html",
    extra: tuple[str, ...] = (), aside: tuple[type[Exception], ...] = UNREADABLE,
) -> DataFrame:
    """Replace the page text by the record that ``read`` makes of it.

    ``read`` gets a dict of the page text and the ``extra`` columns. Other columns pass
    through Python as they are, as Arrow buffers. A page that cannot be read has no record
    but the reason in ``page_error``; it never stops the others. Only the errors of ``aside``
    count as that, every other one stops the job. With an empty ``aside`` each page has its
    record, which suits results that have no place for a reason.
    """
    kept = [name for name in df.columns if name != html]
    schema = T.StructType([df.schema[name] for name in kept]).add("record", record).add("page_error", _STR)
    arrow = to_arrow_type(record)
    needed = (html, *extra)

    def read_part(part: pa.RecordBatch) -> pa.RecordBatch:
        columns = [part.column(name).to_pylist() for name in needed]
        records, errors = [], []
        for row in zip(*columns):
            record_, error = None, None
            try:
                record_ = read(dict(zip(("html", *extra), row)))
            except aside as problem:
                error = reason_of(problem)
            records.append(record_)
            errors.append(error)
        arrays = [part.column(name) for name in kept]
        return pa.RecordBatch.from_arrays(
            [*arrays, pa.array(records, type=arrow), pa.array(errors, type=pa.string())],
            names=[*kept, "record", "page_error"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, PAGES_AT_ONCE):
                yield read_part(batch.slice(first, PAGES_AT_ONCE))
            del batch  # before the next one comes

    return df.mapInArrow(run, schema)


def read_current(row: dict) -> dict:
    """The texts of the current-observation part of a page."""
    return current_part(Page(row["html"]))


def current_part(page: Page) -> dict:
    badge = page.first(None, "div", part="aqi-bg-")
    info = page.first(None, "div", token="font-body-m-medium")
    icon = page.first(None, "img", alt="weather condition icon")
    card = page.enclosing(icon, "div", "bg-white") if icon else None
    arrow = page.first(card, "img", alt="wind direction icon") if card else None
    return {
        "alert": page.text(page.first(None, "p", token="truncate")),
        "aqi": page.text(page.first(badge, "p", token="text-lg")) if badge else None,
        "aqi_status": page.text(page.first(badge, "p", token="font-body-l-medium")) if badge else None,
        "details": [page.text(p) for p in page.below(info, "p")] if info else None,
        "icon": icon.attrs.get("src", "") if icon else None,
        "measures": [page.text(p) for p in page.below(card, "p")] if card else None,
        "wind_style": arrow.attrs.get("style") if arrow else None,
        "heading": page.text(page.first(None, "h2")),
    }


def falls(hours: list[int]) -> list[int]:
    """Days passed at each of the hours: one more whenever the hour is below the one before."""
    return list(accumulate((int(b < a) for a, b in pairwise(hours)), initial=0)) if hours else []


def _metric(page: Page, cells: list, index: int) -> str:
    if index >= len(cells):
        return "-"
    value = page.raw_text(page.first(cells[index], "p", token="font-medium"))
    if value is None:
        raise ValueError("metric without a value")
    return value


def read_forecast(row: dict) -> dict:
    """The cells of the forecast table, in order; unreadable ones carry an error.

    A cell with a readable hour moves the date on even if the rest of it is unreadable.
    """
    return forecast_part(Page(row["html"]), row["fetch_hour"])


def forecast_part(page: Page, fetch_hour: int | None) -> dict:
    table = page.first(None, "table")
    cells = []
    for pos, item in enumerate(page.below(table, "td") if table else ()):
        mark = page.first(item, "p", token="max-w-12")
        if mark is None:
            continue
        clock = page.text(mark)
        cell = dict.fromkeys(CELL.fieldNames()) | {"pos": pos, "clock": clock}
        try:
            now = clock.lower() == "now"
            hour = fetch_hour if now else int(clock.split(":")[0])
            if hour is None:
                raise ValueError("fetch time is missing")
            if not -2**31 <= hour < 2**31:
                raise ValueError("hour out of range")
            cell["hour"] = hour
        except ValueError:
            cell["error"] = "unreadable hour"
            cells.append(cell)
            continue
        try:
            icon = page.first(item, "img")
            metrics = list(page.below(item, "div", exact="flex flex-col items-center"))
            degrees = (page.raw_text(p) for p in page.below(item, "p", token="font-medium"))
            cell.update(
                icon=icon.attrs.get("src") if icon else None,
                aqi=page.text(page.first(item, "div", part="aqi-bg-")),
                temperature=next((t for t in degrees if "°" in t), None),
                wind_speed=_metric(page, metrics, 0),
                humidity=_metric(page, metrics, 1),
            )
        except ValueError as problem:
            cell["error"] = str(problem)
        cells.append(cell)
    dated = [cell for cell in cells if cell["hour"] is not None]
    for cell, offset in zip(dated, falls([cell["hour"] for cell in dated])):
        cell["day_offset"] = offset
    return {"heading": page.text(page.first(None, "h2")), "cells": cells}


def read_both(row: dict) -> dict:
    """Both parts of a page that is parsed once; the page itself is kept if one cannot be read."""
    parts = dict.fromkeys(PARSED_RECORD.fieldNames())

    def attempt(name, make):
        try:
            parts[name] = make()
        except UNREADABLE as problem:
            parts[f"{name}_error"], parts["html"] = reason_of(problem), row["html"]

    try:
        page = Page(row["html"])
    except UNREADABLE as problem:
        return parts | dict.fromkeys(("current_error", "forecast_error"), reason_of(problem)) | {"html": row["html"]}
    attempt("current", lambda: current_part(page))
    attempt("forecast", lambda: forecast_part(page, row["fetch_hour"]))
    return parts


def read_page_info(row: dict) -> dict:
    """Language, title, main heading and country link of a page."""
    page = Page(row["html"], lenient=True)
    root = page.first(None, "html")
    return {
        "lang": root.attrs.get("lang") if root else None,
        "title": page.text(page.first(None, "title")),
        "h1": page.text(page.first(None, "h1")),
        "country": page.text(page.first(None, "a", href=row["country_href"])),
    }


def read_items(row: dict) -> list[dict]:
    """The list items of a page that hold a link, in order."""
    page = Page(row["html"], lenient=True)
    items = []
    for pos, entry in enumerate(page.below(None, "li")):
        link = page.first(entry, "a")
        if link is None:
            continue
        href, label = link.attrs.get("href"), page.text(link)
        error = None if href and label else "link without target or label"
        items.append({"pos": pos, "href": href, "label": label, "error": error})
    return items


def current_rows(pages: DataFrame, labels: Mapping[str, str] = tx.WEATHER_LABELS) -> DataFrame:
    """One raw row of fourteen text columns per stored page."""
    read = read_pages(pages.select("province", "city", "fetched_ts", "html"), read_current, CURRENT_RECORD)
    return _current_columns(read.filter(F.col("page_error").isNull()), labels)


def _current_columns(read: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    def field(name):
        return F.col(f"record.{name}")

    measures = tx.routed_measures(F.coalesce(field("measures"), F.array().cast("array<string>")))
    complete = F.coalesce(F.size(field("details")) >= 2, F.lit(False))
    return read.select(
        tx.slug_to_title(F.col("province")).alias("province"),
        tx.slug_to_title(F.col("city")).alias("city"),
        tx.or_default(field("aqi"), "N/A").alias("aqi"),
        tx.or_default(field("aqi_status"), "N/A").alias("aqi_status"),
        F.when(complete, F.get(field("details"), F.lit(1))).otherwise("N/A").alias("main_pollutant"),
        F.when(complete, tx.plain_spaces(F.try_element_at(field("details"), F.lit(-1))))
        .otherwise("N/A").alias("concentration"),
        tx.or_default(tx.current_weather(field("icon"), labels), "N/A").alias("weather"),
        measures["temperature"].alias("temperature"),
        measures["humidity"].alias("humidity"),
        measures["wind_speed"].alias("wind_speed"),
        tx.or_default(tx.compass_point(field("wind_style")), "N/A").alias("wind_direction"),
        tx.alert_text(field("alert")).alias("alert"),
        tx.observation_from_heading(field("heading")).alias("observation_ts"),
        F.substring(F.col("fetched_ts").cast("string"), 1, 19).alias("scraped_ts"),
    )


def forecast_cells(pages: DataFrame) -> DataFrame:
    """All table cells of the stored pages, with their position, date offset and error."""
    wanted = pages.select(
        "province", "city", "fetched_ts", "html", F.hour("fetched_ts").alias("fetch_hour")
    )
    return _cells(read_pages(wanted, read_forecast, FORECAST_RECORD, extra=("fetch_hour",)))


def _cells(read: DataFrame) -> DataFrame:
    return read.select(
        "province", "city", "fetched_ts", F.col("record.heading").alias("heading"),
        F.inline("record.cells"),
    )


def parsed_pages(pages: DataFrame) -> DataFrame:
    """Every page with the record of both its parts, each page parsed once.

    Store it, and derive from it ``parsed_current``, ``parsed_cells`` and
    ``parsed_quarantine``.
    """
    wanted = pages.select(
        "province", "city", "fetched_ts", "html", F.hour("fetched_ts").alias("fetch_hour")
    )
    return read_pages(wanted, read_both, PARSED_RECORD, extra=("fetch_hour",)).drop("page_error", "fetch_hour")


def _part(parsed: DataFrame, name: str) -> DataFrame:
    read = parsed.filter(F.col(f"record.{name}_error").isNull())
    return read.select("province", "city", "fetched_ts", F.col(f"record.{name}").alias("record"))


def parsed_current(parsed: DataFrame, labels: Mapping[str, str] = tx.WEATHER_LABELS) -> DataFrame:
    """The rows of ``current_rows``, of parsed pages."""
    return _current_columns(_part(parsed, "current"), labels)


def parsed_cells(parsed: DataFrame) -> DataFrame:
    """The cells of ``forecast_cells``, of parsed pages."""
    return _cells(_part(parsed, "forecast"))


def parsed_quarantine(parsed: DataFrame) -> DataFrame:
    """The parts that could not be read, with the page and the reason."""
    failed = None
    for feed in ("current", "forecast"):
        error = F.col(f"record.{feed}_error")
        part = parsed.filter(error.isNotNull()).select(
            F.lit(feed).alias("feed"), "province", "city", "fetched_ts",
            F.col("record.html").alias("html"), error.alias("error"),
        )
        failed = part if failed is None else failed.unionByName(part)
    return failed


# Reasons for which a cell is left out; any other text counts as "other".
CELL_REASONS = {"unreadable_hour": "unreadable hour", "metric_without_value": "metric without a value"}


def outcome_counts() -> dict[str, Column]:
    """What became of parsed pages and their cells: names to aggregates."""
    cells = F.coalesce(F.col("record.forecast.cells"), F.array().cast(FORECAST_RECORD["cells"].dataType))

    def of_cells(test):
        return F.sum(F.size(F.filter(cells, test)).cast("long"))

    def with_reason(text):
        return lambda c: c["error"] == text

    known = [F.lit(text) for text in CELL_REASONS.values()]
    return {
        "pages": F.count(F.lit(1)),
        "current_read": F.count_if(F.col("record.current_error").isNull()),
        "current_rejected": F.count_if(F.col("record.current_error").isNotNull()),
        "forecast_rejected": F.count_if(F.col("record.forecast_error").isNotNull()),
        "cells_read": of_cells(lambda c: c["error"].isNull()),
        **{f"cells_{name}": of_cells(with_reason(text)) for name, text in CELL_REASONS.items()},
        "cells_other": of_cells(lambda c: c["error"].isNotNull() & ~c["error"].isin(*known)),
    }


def forecast_rows(cells: DataFrame, labels: Mapping[str, str] = tx.WEATHER_LABELS) -> DataFrame:
    """The raw forecast rows of the readable cells."""
    date = F.date_add(F.to_date("fetched_ts"), F.col("day_offset"))
    return cells.filter(F.col("error").isNull()).select(
        tx.slug_to_title(F.col("province")).alias("province"),
        tx.slug_to_title(F.col("city")).alias("city"),
        times.hour_stamp(date, F.col("hour")).alias("forecast_ts"),
        tx.or_default(F.col("aqi"), "N/A").alias("aqi"),
        tx.forecast_weather(F.col("icon"), labels).alias("weather"),
        tx.or_default(F.col("temperature"), "N/A").alias("temperature"),
        "wind_speed",
        "humidity",
        tx.observation_from_heading(F.col("heading")).alias("observation_ts"),
        F.substring(F.col("fetched_ts").cast("string"), 1, 19).alias("scraped_ts"),
    )


def quarantine(df: DataFrame) -> DataFrame:
    """The rejected cells or items with their reasons."""
    return df.filter(F.col("error").isNotNull())


def page_quarantine(pages: DataFrame, feed: str) -> DataFrame:
    """The pages of a feed (``current`` or ``forecast``) that cannot be read, with the reason.

    Only their texts leave Python; what the others hold is not kept.
    """
    wanted = pages.select("province", "city", "fetched_ts", "html", F.hour("fetched_ts").alias("fetch_hour"))
    read = {"current": read_current, "forecast": read_forecast}[feed]

    def failure(row: dict) -> dict | None:
        try:
            read(row)
        except UNREADABLE as problem:
            return {"html": row["html"], "error": reason_of(problem)}

    failed = read_pages(wanted, failure, FAILURE, extra=("fetch_hour",)).filter(F.col("record").isNotNull())
    return failed.select(F.lit(feed).alias("feed"), "province", "city", "fetched_ts", "record.html", "record.error")


# A sign that begins no character reference, or one without its semicolon.
BARE_REFERENCE = "&(?!#?[A-Za-z0-9]+;)"


def page_info(
    pages: DataFrame, country_href: str = "/indonesia", country: str = "Indonesia", bare_references: bool = True
) -> DataFrame:
    """Language, title, country and city named by the main heading of each page.

    Every page has its row, as no part of a page stops its reading. A browser reads ``&amp``
    without its semicolon as a reference too. Without ``bare_references`` it stays as it is
    written.
    """
    if not bare_references:
        pages = pages.withColumn("html", F.regexp_replace("html", BARE_REFERENCE, "&amp;"))
    wanted = pages.withColumn("country_href", F.lit(country_href))
    read = read_pages(wanted, read_page_info, PAGE_RECORD, extra=("country_href",), aside=())
    city = F.replace(F.col("record.h1"), F.lit("Air quality in "), F.lit(""))
    return read.select(
        *[c for c in pages.columns if c != "html"],
        F.col("record.lang").alias("lang"),
        F.col("record.title").alias("title"),
        tx.or_default(F.col("record.country"), country).alias("country"),
        tx.trimmed(city).alias("city_named"),
    )


def page_items(pages: DataFrame) -> DataFrame:
    """One row per linked list item of each page; no part of a page stops its reading."""
    read = read_pages(pages, read_items, T.ArrayType(ITEM), aside=())
    return read.select(*[c for c in pages.columns if c != "html"], F.inline("record"))
