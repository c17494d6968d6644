from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tierflow.functions import text as tx, times
from tierflow.functions.keys import entity_hour_key, surrogate_key


def values(spark, inputs, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("x"))).collect()]


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_surrogate_key_vectors(spark):
    def key(city, at):
        return one(spark, entity_hour_key(F.lit(city), ts(at), 3))

    assert key("depok", "2026-02-06 22:00:00") == "B0113C9810E088ECEBB68152C51E5EF3"
    assert key("depok", "2026-02-06 23:00:00") == "52F131821AC0568F48828E471B2B505F"
    plain = one(spark, surrogate_key(F.lit("jakarta"), F.lit("16:00, Feb 06")))
    assert plain == "EA526707807AF31FA7702F65ECD0DAE6"


def test_surrogate_key_of_null_is_null(spark):
    assert one(spark, surrogate_key(F.lit("a"), F.lit(None).cast("string"))) is None


def test_timestamp_text_digits(spark):
    at = ts("2026-03-10 14:05:09.5")
    assert one(spark, times.timestamp_text(at, 3)) == "2026-03-10 14:05:09.500"
    assert one(spark, times.timestamp_text(at, 6)) == "2026-03-10 14:05:09.500000"
    assert one(spark, times.timestamp_text(ts("2026-03-10 14:05:09.123456"), 3)) == "2026-03-10 14:05:09.123"


def test_dirty_numbers(spark):
    assert values(spark, ["75*", "N/A", "-5", None], tx.digits_only) == [75, None, 5, None]
    texts = ["16.9 µg/m³", "30°", "15.5 km/h", "-", "-3.5°", "1.2.3", ""]
    assert values(spark, texts, tx.number_from_text) == [16.9, 30.0, 15.5, None, -3.5, None, None]
    assert values(spark, ["70%", "65.5%"], lambda x: tx.number_from_text(x, "int")) == [70, None]


def test_strict_casts_fail(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, ["N/A"], lambda x: tx.digits_only(x, strict=True))
    with pytest.raises(Exception):
        values(spark, ["14.00, Mar 10"], lambda x: times.observed_at(x, ts("2026-03-10"), strict=True))


def test_observed_at(spark):
    texts = ["9:05, Mar 3", "14:00, Mar 10", "14.00, Mar 10", "14:00, Feb 30", "N/A", None]
    got = values(spark, texts, lambda x: times.observed_at(x, ts("2026-03-10 14:05:09")))
    assert got == [datetime(2026, 3, 3, 9, 5), datetime(2026, 3, 10, 14), None, None, None, None]
    assert values(spark, ["1:00, Feb 29"], lambda x: times.observed_at(x, ts("2026-01-01"), year=2024)) == [
        datetime(2024, 2, 29, 1)
    ]


def test_new_year_correction(spark):
    texts = ["23:00, Dec 31", "00:00, Jan 01"]
    scraped = ts("2027-01-01 00:05:00")
    assert values(spark, texts, lambda x: times.observed_at(x, scraped)) == [
        datetime(2027, 12, 31, 23), datetime(2027, 1, 1)
    ]
    assert values(spark, texts, lambda x: times.observed_at(x, scraped, new_year_fix=True)) == [
        datetime(2026, 12, 31, 23), datetime(2027, 1, 1)
    ]


def test_times_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # 02:30 does not exist on that day in that zone.
        at = "2024-03-10 02:30:00"
        assert values(spark, ["2:30, Mar 10"], lambda x: times.observed_at(x, ts(at))) == [datetime(2024, 3, 10, 2, 30)]
        assert one(spark, times.timestamp_text(ts(at), 3)) == at + ".000"
        assert one(spark, times.date_key(ts(at))) == 2024031002
        assert values(spark, ["2:30, Mar 10"], lambda x: times.clock_on_scrape_day(x, ts(at))) == [
            datetime(2024, 3, 10, 2, 30)
        ]
        assert one(spark, times.calendar_columns(ts(at))["day_name"]) == "Sunday"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_clock_on_scrape_day(spark):
    got = values(spark, ["9:05, Mar 9", "14:00", "x, y"], lambda x: times.clock_on_scrape_day(x, ts("2026-03-10 14:05:09")))
    assert got == [datetime(2026, 3, 10, 9, 5), datetime(2026, 3, 10, 14), None]


def test_usable_observation(spark):
    got = values(spark, ["N/A", "Air quality", None, "14:00, Mar 10"], tx.usable_observation)
    assert got == [False, False, None, True]


def test_normalised_and_title(spark):
    assert values(spark, ["\t West JAVA \n", None], tx.normalised) == ["west java", None]
    assert values(spark, ["west-java"], tx.slug_to_title) == ["West Java"]


def test_compass(spark):
    texts = [f"rotate({a}deg)" for a in (0, 180, 157, 158, 202, 203, 270, -45, 720)] + ["none", None]
    assert values(spark, texts, tx.compass_point) == [
        "South", "North", "North West", "North", "North", "North East", "East", "South West", "South", "N/A", "N/A",
    ]


def test_compass_of_every_degree(spark):
    names = tx.COMPASS
    got = values(spark, [f"rotate({a}deg)" for a in range(360)], tx.compass_point)
    assert got == [names[int(((a + 180) % 360 + 22.5) // 45) % 8] for a in range(360)]


def test_bands_and_colours(spark):
    got = values(spark, [50, 51, 100, 150, 200, 201, None], tx.index_band, "int")
    assert got == ["Good", "Moderate", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy", "Very Unhealthy", "Very Unhealthy"]
    assert values(spark, ["Good", "new", None], tx.category_colour) == ["#00E400", "#CCCCCC", "#CCCCCC"]


def test_weather_labels(spark):
    paths = ["/i/weather-01d.svg", "/i/weather-77.svg", "/i/other.svg", "", "/i/weather-"]
    assert values(spark, paths, tx.current_weather) == ["Clear Sky", "Unknown (77)", "N/A", "N/A", "Unknown ()"]
    paths = ["/i/ic-w-10n.svg", "/i/ic-w-77.svg", "/i/ic-w.svg", "", None]
    assert values(spark, paths, tx.forecast_weather) == ["Rain", "Code 77", "Error Parsing Code", "Unknown", "Unknown"]


def test_observation_captures(spark):
    headings = ["Now • 14:00, Mar 10 Local time", "Updated 4.05, Mar 3", "no time in this long heading", None]
    assert values(spark, headings, tx.observation_from_heading) == [
        "14:00, Mar 10", "4.05, Mar 3", "is long heading", "N/A"
    ]
    headings = ["a • b • 14:00, Mar 10 Local time ", "plain", None]
    assert values(spark, headings, tx.observation_after_bullet) == ["14:00, Mar 10", "N/A", "N/A"]


def test_routing_last_wins(spark):
    df = spark.createDataFrame([(["1°", "5 km/h", "9%", "2°", "3° 4 km/h"],), ([],)], "x array<string>")
    routed = tx.routed_measures(F.col("x"))
    got = [tuple(r) for r in df.select(*routed.values()).collect()]
    assert got == [("3° 4 km/h", "5 km/h", "9%"), ("N/A", "N/A", "N/A")]


def test_defaults(spark):
    got = values(spark, ["16.9\u00a0µg", None], lambda x: tx.or_default(tx.plain_spaces(x), "N/A"))
    assert got == ["16.9 µg", "N/A"]
    assert values(spark, ["NOW", "Now", "Smog", None], tx.alert_text) == ["No Alert", "No Alert", "Smog", "No Alert"]


def test_calendar(spark):
    parts = times.calendar_columns(ts("2026-03-07 14:00:00"))
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first().asDict()
    assert row == {
        "id": 2026030714, "full_date_time": datetime(2026, 3, 7, 14), "full_date": date(2026, 3, 7),
        "year_val": 2026, "quarter_val": 1, "quarter_name": "Q1", "semester_val": 1,
        "semester_name": "S1", "month_val": 3, "month_name": "March", "week_of_year": 10,
        "week_of_month": 1, "day_val": 7, "day_name": "Saturday", "hour_val": 14, "is_weekend": True,
    }
    assert one(spark, times.calendar_columns(ts("2027-01-01"))["week_of_year"]) == 53


def test_local_stamp(spark):
    assert one(spark, times.local_stamp("2026-01-31 20:00:00")) == datetime(2026, 2, 1, 3)


def test_hours(spark):
    got = values(spark, ["Now", "23:00", "7", "x"], lambda x: times.hour_of_text(x, ts("2026-03-10 14:05:09")))
    assert got == [14, 23, 7, None]
    assert one(spark, times.hour_stamp(F.lit("2026-03-10").cast("date"), F.lit(7))) == "2026-03-10 07:00:00"


def test_current_flags(spark):
    flags = times.current_flags(F.col("t"), ts("2026-03-10 09:00:00"))
    df = spark.createDataFrame(
        [(datetime(2026, 3, 10, 23),), (datetime(2026, 3, 1),), (datetime(2025, 3, 10),)], "t timestamp_ntz"
    )
    assert [tuple(r) for r in df.select(*flags.values()).collect()] == [
        (True, True, True), (False, True, True), (False, False, False)
    ]
