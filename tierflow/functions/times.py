"""Time parsing, time text and calendar columns.

All times are zone-less (``timestamp_ntz``). The functions avoid expressions that pass
through the session time zone, so results do not depend on that setting.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def from_text(value: Column, strict: bool = False) -> Column:
    return value.cast("timestamp_ntz") if strict else value.try_cast("timestamp_ntz")


def _wall_clock(instant: Column) -> Column:
    """The UTC wall clock of an instant, whatever the session zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def parsed(value: Column, pattern: str, strict: bool = False) -> Column:
    """Parse with a pattern; text that does not fit gives NULL, or an error when strict."""
    zoned = F.concat(value, F.lit(" +00:00"))
    parse = F.to_timestamp if strict else F.try_to_timestamp
    pattern = pattern + " XXX"
    return _wall_clock(parse(zoned, pattern) if strict else parse(zoned, F.lit(pattern)))


def observed_at(
    observation: Column, scraped: Column, year: int | None = None,
    new_year_fix: bool = False, strict: bool = False,
) -> Column:
    """Timestamp of a year-less text such as ``9:05, Mar 3``.

    The year is that of the scrape unless given. With ``new_year_fix`` a December text
    scraped in January belongs to the year before.
    """
    if year is not None:
        used = F.lit(year)
    else:
        used = F.year(scraped)
        if new_year_fix:
            late = (F.month(scraped) == 1) & observation.contains("Dec")
            used = F.when(late, used - 1).otherwise(used)
    text = F.concat(observation, F.lit(", "), used.cast("string"))
    return parsed(text, "H:mm, MMM d, yyyy", strict)


def clock_on_scrape_day(observation: Column, scraped: Column, strict: bool = False) -> Column:
    """The clock part of an observation text on the date of the scrape."""
    clock = F.split_part(observation, F.lit(","), F.lit(1))
    text = F.concat(F.to_date(scraped).cast("string"), F.lit(" "), clock)
    return parsed(text, "yyyy-MM-dd H:mm", strict)


def timestamp_text(ts: Column, digits: int) -> Column:
    """``yyyy-MM-dd HH:mm:ss.fff`` with a fixed number of fraction digits.

    Spark prints only the fraction digits that matter, so the text is filled up.
    """
    text = ts.cast("string")
    dotted = F.when(F.length(text) == 19, F.concat(text, F.lit("."))).otherwise(text)
    return F.rpad(dotted, 20 + digits, "0")


def date_key(ts: Column) -> Column:
    """``yyyyMMddHH`` as a BIGINT."""
    day = F.year(ts).cast("bigint") * 10000 + F.month(ts) * 100 + F.day(ts)
    return day * 100 + F.hour(ts)


def calendar_columns(ts: Column) -> dict[str, Column]:
    """The calendar attributes of the date dimension."""
    date = ts.cast("date")
    quarter, month, day = F.quarter(ts), F.month(ts), F.day(ts)
    first_half = month <= 6
    return {
        "id": date_key(ts),
        "full_date_time": ts,
        "full_date": date,
        "year_val": F.year(ts).cast("bigint"),
        "quarter_val": quarter.cast("bigint"),
        "quarter_name": F.concat(F.lit("Q"), quarter.cast("string")),
        "semester_val": F.when(first_half, 1).otherwise(2),
        "semester_name": F.when(first_half, "S1").otherwise("S2"),
        "month_val": month.cast("bigint"),
        "month_name": F.date_format(date, "MMMM"),
        "week_of_year": F.weekofyear(ts).cast("bigint"),
        "week_of_month": (F.floor((day - 1) / 7) + 1).cast("int"),
        "day_val": day.cast("bigint"),
        "day_name": F.date_format(date, "EEEE"),
        "hour_val": F.hour(ts).cast("bigint"),
        "is_weekend": F.weekday(ts) >= 5,
    }


def current_flags(ts: Column, as_of: Column) -> dict[str, Column]:
    """Whether a time lies on the day, in the month or in the year of ``as_of``."""
    same_year = F.year(ts) == F.year(as_of)
    return {
        "is_current_day": ts.cast("date") == as_of.cast("date"),
        "is_current_month": same_year & (F.month(ts) == F.month(as_of)),
        "is_current_year": same_year,
    }


def local_stamp(as_of_utc: str, zone: str = "Asia/Jakarta") -> Column:
    """An audit stamp: a given UTC time as the wall clock of a zone."""
    utc = F.lit(as_of_utc).cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def hour_of_text(clock: Column, scraped: Column) -> Column:
    """Hour of a text such as ``23:00``; ``now`` is the hour of the scrape."""
    hour = F.split_part(clock, F.lit(":"), F.lit(1)).try_cast("int")
    return F.when(F.lower(clock) == "now", F.hour(scraped)).otherwise(hour)


def hour_stamp(date: Column, hour: Column) -> Column:
    """Text ``yyyy-MM-dd HH:00:00``."""
    text = F.format_string("%02d", hour)
    return F.concat(date.cast("string"), F.lit(" "), text, F.lit(":00:00"))
