from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tierflow import schemas
from tierflow.functions import times
from tierflow.operators.merge import upsert
from tierflow.plans import gold, lakehouse, silver
from tierflow.sources import tables
from tierflow.sources.tables import table_path
from tierflow.streaming.feed import PARTITION_TYPES, merge_actual_batch, stream_actual
from tierflow.workloads import feeds

SF = "/root/testdata/sf0.001"


def page(city, fetched, observed, aqi, hours):
    cells = "".join(
        f'<td><p class="max-w-12">{h:02d}:00</p><img src="/i/ic-w-01d.svg"><div class="aqi-bg-x">{aqi + h}</div>'
        f'<p class="font-medium">2{h % 10}°</p><div class="flex flex-col items-center"><p class="font-medium">{h} km/h</p></div>'
        f'<div class="flex flex-col items-center"><p class="font-medium">{50 + h}%</p></div></td>' for h in hours
    )
    status = "Good" if aqi <= 50 else "Moderate"
    html = (
        f'<div class="aqi-bg-x"><p class="text-lg">{aqi}</p><p class="font-body-l-medium">{status}</p></div>'
        f"<h2>{observed}</h2><table><tr>{cells}</tr></table>"
    )
    return ("u", "west-java", city, html, fetched)


def stored(spark, *pages):
    return spark.createDataFrame(list(pages), schemas.STORED_PAGES)


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def run(spark, base, number, pages, **options):
    added = lakehouse.load_raw(pages, base)
    lakehouse.refresh_silver(spark, base, f"run-{number}", **options)
    stamp = times.local_stamp(f"2026-03-1{number} 00:00:00")
    lakehouse.refresh_gold(spark, base, f"run-{number}", stamp, **options)
    return added


def snapshot(spark, base):
    fact = lakehouse.fact_table(spark, base)
    dims = {
        n: lakehouse.dimension(spark, table_path(base, "gold", n))
        for n in ("dim_city", "dim_aqi", "dim_date")
    }
    return fact, dims


def test_two_runs_from_pages_to_star(spark, base, rows):
    at = datetime(2026, 3, 10, 14, 5)
    first = stored(spark, page("depok", at, "14:00, Mar 10", 40, [15, 16]), page("bogor", at, "13:00, Mar 10", 70, [15]))
    assert run(spark, base, 0, first) == {"raw_aqi_index": 2, "raw_weather_forecast": 3}
    fact, dims = snapshot(spark, base)
    assert fact.count() == 5 and dims["dim_city"].count() == 2 and dims["dim_date"].count() == 4

    second = stored(spark, page("depok", at + timedelta(hours=1), "15:00, Mar 10", 90, [16, 17]), page("serang", at, "N/A at all", 10, []))
    run(spark, base, 1, second)
    fact, dims = snapshot(spark, base)
    depok = gold.surrogate_key(F.lit("depok"))
    got = rows(fact.filter(F.col("city_id") == depok), "date_id", "aqi", "aqi_id", "temp_val")
    good, moderate = (spark.range(1).select(gold.surrogate_key(F.lit(s))).first()[0] for s in ("Good", "Moderate"))
    assert got == [
        (2026031014, 40, good, None),       # actual only
        (2026031015, 55, moderate, 25.0),   # both: the forecast value wins, the category is observed
        (2026031016, 106, None, 26.0),      # forecast only, the later scrape
        (2026031017, 107, None, 27.0),
    ]
    created = {r.city: (r.created_at, r.updated_at) for r in dims["dim_city"].collect()}
    assert created["depok"] == (datetime(2026, 3, 10, 7), datetime(2026, 3, 11, 7))
    assert set(created) == {"depok", "bogor"}
    broken = gold.star_integrity(fact, dims["dim_city"], dims["dim_aqi"], dims["dim_date"]).filter("orphan_rows > 0")
    assert rows(broken) == []

    assert "gold_dim_date" in lakehouse.register_views(spark, base)
    joined = spark.sql("""
        SELECT c.city, count(*) AS n FROM gold_fact_aqi_weather f JOIN gold_dim_city c ON f.city_id = c.id
        JOIN gold_dim_date d ON f.date_id = d.id WHERE d.day_name = 'Tuesday' GROUP BY c.city""")
    assert rows(joined) == [("bogor", 2), ("depok", 4)]

    before = rows(fact)
    run(spark, base, 2, stored(spark, *[]))
    assert rows(snapshot(spark, base)[0]) == before
    run(spark, base, 3, stored(spark, *[]), full_refresh=True)
    fact, dims = snapshot(spark, base)
    assert rows(fact) == before
    assert {r.created_at for r in dims["dim_city"].collect()} == {datetime(2026, 3, 13, 7)}


def test_minutes_make_date_keys_collide_unless_truncated(spark, rows):
    actual = spark.createDataFrame(
        [("1", "a", datetime(2026, 3, 10, 14, 0), datetime(2026, 3, 10)), ("2", "b", datetime(2026, 3, 10, 14, 30), datetime(2026, 3, 10))],
        "id string, city string, event_ts timestamp_ntz, scraped_ts timestamp_ntz",
    )
    forecast = actual.filter("false").withColumnRenamed("event_ts", "forecast_ts")
    stamp = times.local_stamp("2026-03-10 00:00:00")
    assert [r.id for r in gold.dim_date(actual, forecast, stamp).collect()] == [2026031014] * 2
    assert [r.full_date_time for r in gold.dim_date(actual, forecast, stamp, grain="hour").collect()] == [datetime(2026, 3, 10, 14)]


def test_declared_schemas_hold(spark):
    actual, forecast = silver.silver_actual(feeds.raw_actual(spark, SF)), silver.silver_forecast(feeds.raw_forecast(spark, SF))
    stamp = times.local_stamp("2026-03-10 00:00:00")

    def shape(schema):
        return [(f.name, f.dataType) for f in schema]

    for df, schema in (
        (feeds.raw_actual(spark, SF), schemas.RAW_ACTUAL), (feeds.raw_forecast(spark, SF), schemas.RAW_FORECAST),
        (actual, schemas.SILVER_ACTUAL), (forecast, schemas.SILVER_FORECAST),
        (silver.unified_hourly(feeds.raw_actual(spark, SF), feeds.raw_forecast(spark, SF)), schemas.UNIFIED_HOURLY),
        (gold.dim_city(actual, stamp), schemas.DIM_CITY), (gold.dim_category(actual, stamp), schemas.DIM_CATEGORY),
        (gold.dim_date(actual, forecast, stamp), schemas.DIM_DATE), (gold.fact_rows(actual, forecast), schemas.FACT),
    ):
        assert shape(df.schema) == shape(schema)


def test_bound_reaches_the_scans(spark, tmp_path):
    actual, forecast = silver.silver_actual(feeds.raw_actual(spark, SF)), silver.silver_forecast(feeds.raw_forecast(spark, SF))
    for name, df in (("a", actual), ("f", forecast)):
        df.write.parquet(str(tmp_path / name))
    rows = gold.fact_rows(spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "f")))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_ts,2020" in plan and "GreaterThanOrEqual(forecast_ts,2020" in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_stream_equals_batch_in_any_order(spark, base, rows):
    raw = feeds.raw_actual(spark, SF).withColumn("_n", F.crc32("scraped_ts") % 3)
    want = rows(silver.silver_actual(raw.drop("_n")))
    landing, path = f"{base}/landing", f"{base}/silver/aqi_index"
    for part in (2, 0, 1):
        raw.filter(F.col("_n") == part).drop("_n").write.mode("append").parquet(landing)
        stream_actual(spark, landing, path, f"{base}/checkpoint").awaitTermination()

    def stored_rows():
        got = tables.scan_partitioned(spark, path, schemas.SILVER_ACTUAL, PARTITION_TYPES)
        return rows(got.drop(*PARTITION_TYPES))

    assert stored_rows() == want
    # A batch delivered again changes nothing.
    merge_actual_batch(raw.filter("_n = 2").drop("_n"), path, "again")
    assert stored_rows() == want


def test_look_back_leaves_out_old_scrapes(spark, base):
    raw = feeds.raw_actual(spark, SF)
    raw.write.parquet(f"{base}/landing")
    stream_actual(spark, f"{base}/landing", f"{base}/t", f"{base}/c", look_back="2024-01-20").awaitTermination()
    assert spark.read.parquet(f"{base}/t").agg(F.min("scraped_ts")).first()[0] >= datetime(2024, 1, 20)


def test_older_merges_leave_their_columns(spark, rows):
    actual = silver.silver_actual(feeds.raw_actual(spark, SF)).limit(50)
    changed = actual.withColumns({"scraped_ts": F.lit(datetime(2030, 1, 1)).cast("timestamp_ntz"), "wind_val": F.lit(-1.0)})
    got = upsert(actual, changed, "id", update_cols=silver.ACTUAL_UPDATES)
    assert rows(got.drop("wind_val")) == rows(actual.drop("wind_val"))
    assert {r.wind_val for r in got.collect()} == {-1.0}
    assert not {"id", "province", "city"} & set(silver.FORECAST_UPDATES)
    assert "observation_ts" not in gold.FACT_LOOKUP_UPDATES


def test_overlapping_categories_cannot_be_merged(spark):
    actual, forecast = silver.silver_actual(feeds.raw_actual(spark, SF)), silver.silver_forecast(feeds.raw_forecast(spark, SF))
    stamp = times.local_stamp("2026-03-10 00:00:00")
    rows = gold.fact_with_lookups(actual, forecast, gold.dim_city(actual, stamp), gold.dim_category(actual, stamp))
    with pytest.raises(Exception, match="duplicate source key"):
        upsert(rows.limit(0), rows, "fact_id", update_cols=gold.FACT_LOOKUP_UPDATES).collect()


def test_stored_lookup_prunes_folders(spark):
    from tierflow.workloads.queries import QUERIES

    plan = QUERIES["stored_lookup"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "p_city" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "forecast_ts" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_fact_shuffles_each_input_once(spark):
    from tierflow.workloads.queries import QUERIES

    plan = QUERIES["fact_reconciled"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_dimensions_do_not_grow_by_rows_without_a_key(spark, tmp_path):
    from pyspark.sql import functions as F
    from tierflow.functions import times
    from tierflow.plans import gold, lakehouse

    rows = spark.createDataFrame([("Good", 5), (None, 7)], "aqi_status string, aqi_val int")
    stamp = times.local_stamp("2026-01-01 00:00:00")
    for _ in range(3):
        table = lakehouse.refresh_dimension(spark, str(tmp_path / "dim"), lambda state: gold.dim_category(rows, stamp, state))
    assert [r.category for r in table.collect()] == ["Good"]
    assert table.filter(F.col("id").isNull()).count() == 0
