"""Ledger, look-back, trigger and partial aggregates."""

import os
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tierflow import schemas
from tierflow.functions import times
from tierflow.operators.dedup import latest_by_key, version_order
from tierflow.operators.merge import upsert, upsert_in_place
from tierflow.plans import gold, lakehouse
from tierflow.sources import commits, tables
from tierflow.sources.tables import table_path
from tierflow.streaming import feed
from tierflow.streaming.feed import late_rows, merge_actual_batch
from tierflow.streaming.trigger import run_when_all_changed


def raw(spark, *scrapes):
    """Raw rows from (city, observation, value, scrape time, status)."""
    names = schemas.RAW_ACTUAL.names
    rows = []
    for city, observed, value, scraped, *status in scrapes:
        row = dict.fromkeys(names) | {"province": "p", "city": city, "aqi": str(value), "observation_ts": observed,
                                      "scraped_ts": scraped, "aqi_status": status[0] if status else "Good"}
        rows.append(tuple(row[n] for n in names))
    return spark.createDataFrame(rows, schemas.RAW_ACTUAL)


def land(spark, base, *scrapes):
    tables.append(raw(spark, *scrapes).coalesce(1), table_path(base, "bronze", "raw_aqi_index"))


def silver_rows(spark, base):
    df = tables.scan_partitioned(spark, table_path(base, "silver", "aqi_index"), schemas.SILVER_ACTUAL, lakehouse.SILVER_KINDS)
    return sorted((r.city, r.event_ts.hour, r.aqi_val) for r in df.collect())


def files(base):
    return sorted(Path(base, "bronze/raw_aqi_index").glob("part-*.parquet"))


@pytest.fixture(params=["plain", "a b+c%20d"])
def base(tmp_path, request):
    return str(tmp_path / request.param)


def test_a_run_reads_new_files_only(spark, base):
    land(spark, base, ("a", "01:00, Mar 10", 1, "2026-03-10 01:05:00"))
    assert lakehouse.refresh_feed(spark, base, "actual", "0")
    # Nobody can read the first file now, and its time is as it was.
    old = files(base)[0]
    at = os.stat(old)
    old.write_bytes(b"x" * at.st_size)
    os.utime(old, ns=(at.st_atime_ns, at.st_mtime_ns))
    for crc in Path(base, "bronze/raw_aqi_index").glob(".*.crc"):
        crc.unlink()
    os.utime(old, (at.st_atime - 100, at.st_mtime))
    land(spark, base, ("a", "02:00, Mar 10", 2, "2026-03-10 02:05:00"), ("a", "01:00, Mar 10", 9, "2026-03-10 00:05:00"))
    os.utime(files(base)[0] if files(base)[0] != old else files(base)[1])
    assert lakehouse.refresh_feed(spark, base, "actual", "1")
    assert silver_rows(spark, base) == [("a", 1, 1), ("a", 2, 2)]  # the older scrape of 01:00 has not won
    assert not lakehouse.refresh_feed(spark, base, "actual", "2")
    path = table_path(base, "silver", "aqi_index")
    assert commits.new_files(spark, table_path(base, "bronze", "raw_aqi_index"), path).count() == 0


def test_files_are_left_out_while_planning(spark, tmp_path):
    path = str(tmp_path / "raw")
    for number in range(3):
        spark.range(number, number + 1).coalesce(1).write.mode("append").parquet(path)
    parts = sorted(Path(path).glob("part-*.parquet"), key=lambda p: os.stat(p).st_mtime_ns)
    for age, part in zip((300, 200, 0), parts):
        os.utime(part, (os.stat(part).st_atime, os.stat(parts[-1]).st_mtime - age))
    new = commits.new_files(spark, path, str(tmp_path / "t")).orderBy(F.desc("modified")).limit(2)
    got = commits.scan_files(spark, path, spark.range(1).schema, new)
    assert got.count() == 2
    got.collect()
    plan = got._jdf.queryExecution().executedPlan()
    scans = [plan]
    read = []
    while scans:
        node = scans.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            scans.append(node.executedPlan())
        if name.endswith("QueryStageExec"):
            scans.append(node.plan())
        if name == "FileSourceScanExec" and "file_modification_time" in node.toString():
            read.append(node.metrics().apply("numFiles").value())
        scans += [node.children().apply(i) for i in range(node.children().size())]
    assert read == [2]


def test_a_run_lost_between_merge_and_ledger_is_repeated(spark, base, monkeypatch):
    land(spark, base, ("a", "01:00, Mar 10", 1, "2026-03-10 01:05:00"))
    settle = commits.settle_files

    def lost(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(commits, "settle_files", lost)
    with pytest.raises(RuntimeError):
        lakehouse.refresh_feed(spark, base, "actual", "0")
    monkeypatch.setattr(commits, "settle_files", settle)
    # A file that lands before the repetition is not counted as merged by it.
    land(spark, base, ("b", "01:00, Mar 10", 2, "2026-03-10 01:05:00"))
    assert lakehouse.refresh_feed(spark, base, "actual", "0")
    assert silver_rows(spark, base) == [("a", 1, 1)]
    assert lakehouse.refresh_feed(spark, base, "actual", "1")
    assert silver_rows(spark, base) == [("a", 1, 1), ("b", 1, 2)]


def test_full_refresh_forgets_the_ledger(spark, tmp_path):
    base = str(tmp_path)
    land(spark, base, ("a", "01:00, Mar 10", 1, "2026-03-10 01:05:00"))
    lakehouse.refresh_feed(spark, base, "actual", "0")
    assert lakehouse.refresh_feed(spark, base, "actual", "1", full_refresh=True)
    assert silver_rows(spark, base) == [("a", 1, 1)]


def test_merges_end_like_one_choice(spark, rows):
    kind = "k int, at int, x string, y double"
    data = [(k % 5, [None, 1, 2][k % 3], [None, "a", "b"][(k // 2) % 3], [None, 1.5, float("nan")][(k // 5) % 3]) for k in range(60)]
    df = spark.createDataFrame(data, kind)
    order = version_order(df.schema, ["k"], "at")
    want = rows(latest_by_key(df, ["k"], "at").withColumn("y", F.col("y").cast("string")))
    for merge in (upsert, upsert_in_place):
        state = latest_by_key(df.limit(0), ["k"], "at")
        for start in range(0, 60, 20):
            batch = latest_by_key(spark.createDataFrame(data[start:start + 20], kind), ["k"], "at")
            state = spark.createDataFrame(merge(state, batch, "k", newer_by=order).collect(), kind)
        assert rows(state.withColumn("y", F.col("y").cast("string"))) == want


def test_look_back_inside_on_and_beyond_the_bound(spark, tmp_path):
    path, late = str(tmp_path / "t"), str(tmp_path / "late")

    def merge(batch, *scrapes):
        merge_actual_batch(raw(spark, *scrapes), path, batch, days=2, late=late)

    merge("0", ("a", "05:00, Mar 10", 1, "2026-03-10 05:00:00"))
    second = [("a", "05:00, Mar 9", 2, "2026-03-09 05:00:00"), ("a", "05:00, Mar 8", 3, "2026-03-08 05:00:00"),
              ("a", "04:00, Mar 8", 4, "2026-03-08 04:59:59.999999"), ("a", "01:00, Mar 9", 5, "no time"),
              ("b", "06:00, Mar 12", 6, "2026-03-12 06:00:00")]
    for _ in range(2):  # delivered again, the batch is judged by the same bound
        merge("1", *second)
        stored = spark.read.schema(schemas.SILVER_ACTUAL).parquet(path)
        assert sorted(r.aqi_val for r in stored.collect()) == [1, 2, 3, 6]
        got = sorted((r.aqi, r.bound, r.batch) for r in late_rows(spark, late).collect())
        assert got == [("4", datetime(2026, 3, 8, 5), "1"), ("5", datetime(2026, 3, 8, 5), "1")]
    merge("2", ("a", "05:00, Mar 10", 7, "2026-03-10 05:59:00"))
    assert {r.aqi for r in late_rows(spark, late).collect()} == {"4", "5", "7"}
    assert commits.look_back_bound(spark, path, "scraped_ts", 2) == datetime(2026, 3, 10, 6)


def test_bound_of_a_table_without_records(spark, tmp_path):
    path = str(tmp_path / "t")
    assert commits.look_back_bound(spark, path, "scraped_ts") == datetime(2020, 1, 1)
    merge_actual_batch(raw(spark, ("a", "05:00, Mar 10", 1, "2026-03-10 05:00:00")), path, "0")
    commits.forget(spark, path)
    assert commits.look_back_bound(spark, path, "scraped_ts") == datetime(2026, 3, 8, 5)


def test_a_small_batch_leaves_stored_rows_unshuffled(spark, tmp_path, monkeypatch):
    path, plans = str(tmp_path / "t"), []
    merge_actual_batch(raw(spark, ("a", "05:00, Mar 10", 1, "2026-03-10 05:00:00")), path, "0")
    in_place = tables.upsert_in_place

    def spied(old, new, *args, **options):
        merged = in_place(old, new, *args, **options)
        plans.append(merged._jdf.queryExecution().executedPlan().toString())
        return merged

    monkeypatch.setattr(tables, "upsert_in_place", spied)
    merge_actual_batch(raw(spark, ("a", "05:00, Mar 10", 2, "2026-03-10 05:10:00")), path, "1")
    assert plans and "Window" not in plans[0].split("BroadcastExchange")[0]


def test_the_trigger_waits_for_all_tables(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("x", "y")}
    state, runs, broken = str(tmp_path / "state"), [], []

    def action(run):
        if broken:
            raise RuntimeError("no run")
        runs.append(run)

    def look():
        query = run_when_all_changed(spark, paths, state, action)
        query.awaitTermination()

    look()
    assert runs == []
    commits.record_batch(spark, paths["x"], "0", None)
    look()
    commits.record_batch(spark, paths["x"], "1", None)
    look()
    assert runs == []  # only one side has moved, twice
    commits.record_batch(spark, paths["y"], "0", None)
    look()
    assert len(runs) == 1
    look()
    commits.record_batch(spark, paths["y"], "1", None)
    look()
    assert len(runs) == 1  # the marks were taken off by the run
    broken.append(True)
    commits.record_batch(spark, paths["x"], "2", None)
    with pytest.raises(Exception, match="no run"):
        look()
    broken.clear()
    look()
    look()
    assert len(runs) == 2 and len(set(runs)) == 2


def test_partials_follow_lowered_extremes(spark, tmp_path, rows):
    base = str(tmp_path)
    path = table_path(base, "silver", "aqi_index")
    land(spark, base, ("a", "01:00, Mar 10", 50, "2026-03-10 01:05:00"), ("a", "02:00, Mar 10", 10, "2026-03-10 02:05:00"),
         ("b", "01:00, Mar 10", 20, "2026-03-10 01:05:00", "Bad"), ("c", "01:00, Apr 10", 30, "2026-04-10 01:05:00"))
    lakehouse.refresh_feed(spark, base, "actual", "0")

    def ranges():
        return rows(lakehouse.silver_partial(spark, base, gold.CATEGORY_PARTIAL), "category", "min_val", "max_val")

    assert ranges() == [("Bad", 20, 20), ("Good", 10, 50)]
    parts = {p: p.stat().st_mtime_ns for p in Path(f"{path}__partials/category").rglob("part-*.parquet")}
    # The highest value is corrected, and a row changes its category.
    land(spark, base, ("a", "01:00, Mar 10", 40, "2026-03-10 01:15:00"), ("b", "01:00, Mar 10", 25, "2026-03-10 01:15:00"))
    lakehouse.refresh_feed(spark, base, "actual", "1")
    assert ranges() == [("Good", 10, 40)]
    left = [p for p in parts if p.exists()]
    assert len(left) == 1 and "p_city=c" in str(left[0])
    stored = tables.scan_partitioned(spark, path, schemas.SILVER_ACTUAL, lakehouse.SILVER_KINDS)
    stamp = times.local_stamp("2026-03-10 00:00:00")
    pairs = lakehouse.silver_partial(spark, base, gold.CITY_PARTIAL)
    assert rows(gold.city_rows(pairs, stamp)) == rows(gold.dim_city(stored, stamp))
    # Without partials the table itself is asked.
    for partial in lakehouse.PARTIALS:
        partial.drop(spark, path)
    assert ranges() == [("Good", 10, 40)]


def test_late_rows_of_nothing(spark, tmp_path):
    merge_actual_batch(raw(spark), str(tmp_path / "t"), "0", days=2, late=str(tmp_path / "late"))
    assert late_rows(spark, str(tmp_path / "late")).count() == 0
    assert feed.PARTITION_TYPES == lakehouse.SILVER_KINDS
