import random
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tierflow.operators import lookup, running, sweep
from tierflow.operators.dedup import first_row_only, last_measures, latest_by_key
from tierflow.operators.incremental import high_water, since_day, stamped
from tierflow.operators.merge import merge_into_catalog, upsert, upsert_in_place
from tierflow.operators.reconcile import full_outer, reconcile, times_in_either, union_tagged
from tierflow.operators.running import day_offsets, global_row_number

START = datetime(2026, 3, 10)


def hour(n):
    return START + timedelta(hours=n)


# --- one version per key -------------------------------------------------------------

def versions(spark, seed=1):
    rng = random.Random(seed)
    data = [
        (rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([None, 1, 2, 3]), rng.randrange(4))
        for _ in range(200)
    ]
    rng.shuffle(data)
    return data


def test_latest_by_key_does_not_depend_on_row_order(spark, rows):
    data = versions(spark)
    first = spark.createDataFrame(data, "k string, t int, at int, v int")
    other = spark.createDataFrame(data[::-1], first.schema).repartition(7)
    for keep in ("first", "last"):
        assert rows(latest_by_key(first, ["k", "t"], "at", keep)) == rows(latest_by_key(other, ["k", "t"], "at", keep))


def test_latest_by_key_keeps_one_row_per_key_with_nulls_last(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", None, "y"), ("a", 2, "z"), (None, 5, "n"), (None, 6, "m")], "k string, at int, v string"
    )
    last = {r.k: r.v for r in latest_by_key(df, ["k"], "at").collect()}
    first = {r.k: r.v for r in latest_by_key(df, ["k"], "at", "first").collect()}
    assert last == {"a": "z", None: "m"}
    assert first == {"a": "x", None: "n"}


def test_latest_by_key_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS at")
    plan = latest_by_key(df, ["k"], "at")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_priority_comes_before_recency(spark):
    df = spark.createDataFrame([("a", 9, "f"), ("a", 1, "i"), ("b", 3, "f")], "k string, at int, src string")
    rank = F.when(F.col("src") == "i", 1).otherwise(2)
    assert {r.k: r.src for r in latest_by_key(df, ["k"], "at", priority=rank).collect()} == {"a": "i", "b": "f"}


def test_first_row_only(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 1, "z"), (None, 2, "w")], "g string, o int, d string")
    assert rows(first_row_only(df, ["g"], ["o"], ["d"])) == [
        ("a", 1, "y"), ("a", 2, ""), (None, 1, "z"), (None, 2, "")
    ]


def test_last_measures(spark, rows):
    df = spark.createDataFrame(
        [(1, 0, "1°"), (1, 1, "2 km/h"), (1, 2, "3° km/h"), (2, 0, "none")], "g int, p int, t string"
    )
    assert rows(last_measures(df, ["g"], "t", "p")) == [(1, "3° km/h", "2 km/h", "N/A"), (2, "N/A", "N/A", "N/A")]


# --- upsert --------------------------------------------------------------------------

SCHEMA = "id string, v int, w string, at int"


def tables(spark):
    target = spark.createDataFrame([("a", 1, "ta", 5), ("b", 2, "tb", 5), (None, 3, "tn", 5)], SCHEMA)
    source = spark.createDataFrame([("b", 20, "sb", 4), ("c", 30, "sc", 6), (None, 40, "sn", 6), (None, 40, "sn", 6)], SCHEMA)
    return target, source


def test_upsert_all_columns(spark, rows):
    assert rows(upsert(*tables(spark), "id")) == [
        ("a", 1, "ta", 5), ("b", 20, "sb", 4), ("c", 30, "sc", 6),
        (None, 3, "tn", 5), (None, 40, "sn", 6), (None, 40, "sn", 6),
    ]


def test_upsert_chosen_columns_and_null_values(spark, rows):
    target = spark.createDataFrame([("a", 1, "ta", 5)], SCHEMA)
    source = spark.createDataFrame([("a", None, "sa", 9), ("b", None, None, None)], SCHEMA)
    assert rows(upsert(target, source, "id", update_cols=["v"])) == [("a", None, "ta", 5), ("b", None, None, None)]


def test_upsert_newer_by(spark, rows):
    got = {r[0]: r[1] for r in upsert(*tables(spark), "id", newer_by="at", drop_null_keys=True).collect() if r[0]}
    assert got == {"a": 1, "b": 2, "c": 30}


def test_upsert_is_idempotent(spark, rows):
    target, source = tables(spark)
    once = upsert(target, source, "id", drop_null_keys=True)
    assert rows(upsert(once, source, "id", drop_null_keys=True)) == rows(once)


def test_upsert_without_target_and_composite_key(spark, rows):
    target, source = tables(spark)
    assert rows(upsert(None, source, "id")) == rows(source)
    got = upsert(target, source, ["id", "at"]).filter("id = 'b'")
    assert rows(got) == [("b", 2, "tb", 5), ("b", 20, "sb", 4)]


def test_upsert_shuffles_each_side_once(spark):
    plan = upsert(*tables(spark), "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_upsert_rejects_duplicate_source_keys(spark):
    target, _ = tables(spark)
    source = spark.createDataFrame([("x", 1, "", 1), ("x", 2, "", 1)], SCHEMA)
    for old in (target, None):
        with pytest.raises(Exception, match="duplicate source key: x"):
            upsert(old, source, "id").collect()


def test_upsert_rejects_other_columns(spark):
    target, source = tables(spark)
    with pytest.raises(ValueError, match="columns differ"):
        upsert(target, source.drop("v"), "id")
    with pytest.raises(ValueError, match="unknown update columns"):
        upsert(target, source, "id", update_cols=["nope"])


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_upsert_in_place_equals_upsert(spark, rows, threshold):
    target, source = tables(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for options in ({}, {"update_cols": ["w"]}, {"newer_by": "at"}, {"drop_null_keys": True}):
            for key in ("id", ["id", "v"]):
                both = [f(target, source, key, **options) for f in (upsert_in_place, upsert)]
                assert rows(both[0]) == rows(both[1])
        twice = spark.createDataFrame([("x", 1, "", 1), ("x", 2, "", 1)], SCHEMA)
        for merge in (upsert_in_place, upsert):
            with pytest.raises(Exception, match="duplicate source key: x"):
                merge(target, twice, "id").collect()
            with pytest.raises(ValueError, match="columns differ"):
                merge(target, source.withColumn("more", F.lit(1)), "id")
            with pytest.raises(ValueError, match="unknown update columns"):
                merge(target, source, "id", update_cols=["nope"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_source_does_not_shuffle_the_target(spark):
    target = spark.range(1000).selectExpr("cast(id AS string) AS id", "1 AS v")
    source = spark.range(5, 6).selectExpr("cast(id AS string) AS id", "2 AS v")
    plan = upsert_in_place(target, source, "id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [id" not in plan.split("Union")[1].split("BroadcastHashJoin")[0]
    assert "FullOuter" not in plan


def test_catalog_merge_needs_a_capable_format(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS merge_probe (id string, v int) USING parquet")
    with pytest.raises(Exception, match="MERGE|UNSUPPORTED"):
        merge_into_catalog(spark.createDataFrame([("a", 1)], "id string, v int"), "merge_probe", "id")
    spark.sql("DROP TABLE merge_probe")


# --- incremental ---------------------------------------------------------------------

def test_high_water(spark):
    df = spark.createDataFrame([(hour(0),), (hour(60),)], "t timestamp_ntz")
    probe = spark.range(1)
    assert probe.select(high_water(df, "t")).first()[0] == hour(12)
    assert probe.select(high_water(None, "t")).first()[0] == datetime(2020, 1, 1)
    # An empty state must not keep all later runs from loading.
    assert probe.select(high_water(df.filter("false"), "t")).first()[0] == datetime(2020, 1, 1)


def test_since_day(spark):
    assert spark.range(1).select(since_day("2026-03-10 13:00:00")).first()[0] == datetime(2026, 3, 9)


def test_stamps_keep_creation_and_move_update(spark, rows):
    first, second = F.lit(hour(0)).cast("timestamp_ntz"), F.lit(hour(9)).cast("timestamp_ntz")
    df = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    state = stamped(df.filter("id = 'a' OR id IS NULL"), None, first)
    doubled = state.unionAll(state)
    assert rows(stamped(df, doubled, second)) == [
        ("a", hour(0), hour(9)), ("b", hour(9), hour(9)), (None, hour(9), hour(9))
    ]


# --- reconciliation ------------------------------------------------------------------

A_SCHEMA = "province string, city string, event_ts timestamp_ntz, v int, s string, scraped_ts timestamp_ntz"
F_SCHEMA = "province string, city string, forecast_ts timestamp_ntz, v int, o timestamp_ntz, scraped_ts timestamp_ntz"


def feeds(spark, seed, unique=False, null_city=True):
    rng = random.Random(seed)
    cities = ["x", "y", ""] + ([None] if null_city else [])

    def rows_of(make, offset):
        out, seen = [], set()
        for n in range(120):
            city, at = rng.choice(cities), rng.choice([None, *map(hour, range(8))])
            if unique and (city, at) in seen:
                continue
            seen.add((city, at))
            out.append(make(city, at, n, hour(100) + timedelta(minutes=2 * n + offset)))
        rng.shuffle(out)
        return out

    a = rows_of(lambda c, t, n, at: ("p", c, t, n if n % 3 else None, f"s{n}", at), 0)
    f = rows_of(lambda c, t, n, at: ("p", c, t, -n if n % 4 else None, hour(n), at), 1)
    return spark.createDataFrame(a, A_SCHEMA), spark.createDataFrame(f, F_SCHEMA)


def joined_by_sql(a, f, keep, prefer, since):
    """The plain form: full outer join, bound, then one row per key."""
    con = duckdb.connect()
    con.register("a", a.toArrow())
    con.register("f", f.toArrow())
    one, two = ("f", "a") if prefer == "forecast" else ("a", "f")
    direction = "ASC" if keep == "first" else "DESC"
    return con.execute(f"""
        WITH j AS (SELECT coalesce(a.province, f.province) AS province, coalesce(a.city, f.city) AS city,
            coalesce(f.forecast_ts, a.event_ts) AS event_ts, coalesce({one}.v, {two}.v) AS v, a.s, f.o,
            coalesce({one}.scraped_ts, {two}.scraped_ts) AS seen, a.scraped_ts AS a_at, f.scraped_ts AS f_at
            FROM a FULL OUTER JOIN f ON a.city = f.city AND a.event_ts = f.forecast_ts
            WHERE coalesce(f.forecast_ts, a.event_ts) >= TIMESTAMP '{since}')
        SELECT province, city, event_ts, v, s, o, seen FROM j QUALIFY row_number() OVER (PARTITION BY city, event_ts
            ORDER BY seen {direction}, a_at {direction}, f_at {direction}) = 1""").fetchall()


@pytest.mark.parametrize("keep", ["first", "last"])
@pytest.mark.parametrize("prefer", ["forecast", "actual"])
def test_reconcile_equals_join_then_rank(spark, keep, prefer):
    a, f = feeds(spark, 3)
    since = hour(2)
    got = reconcile(a, f, {"v": "v"}, ["s"], ["o"], since=F.lit(since).cast("timestamp_ntz"), keep=keep, prefer=prefer)
    want = joined_by_sql(a, f, keep, prefer, since)
    key = lambda t: tuple(str(x) for x in t)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def test_reconcile_of_keyed_tables_needs_no_choice(spark, rows):
    a, f = feeds(spark, 5, unique=True, null_city=False)
    args = ({"v": "v"}, ["s"], ["o"])
    assert rows(reconcile(a, f, *args, unique_inputs=True)) == rows(reconcile(a, f, *args))


def test_reconcile_shuffles_each_input_once(spark):
    a, f = feeds(spark, 5)
    plan = reconcile(a, f, {"v": "v"}, ["s"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_full_outer_keeps_all_rows_and_pairs(spark):
    a, f = feeds(spark, 7)
    con = duckdb.connect()
    con.register("a", a.toArrow())
    con.register("f", f.toArrow())
    want = con.execute(
        "SELECT count(*), count(a.v), count(f.v) FROM a FULL OUTER JOIN f ON a.city = f.city AND a.event_ts = f.forecast_ts"
    ).fetchone()
    got = full_outer(a, f).agg(F.count(F.lit(1)), F.count("act_v"), F.count("fc_v")).first()
    assert tuple(got) == want


@pytest.mark.parametrize("minutes", [None, 0, 60, 150, 239, 400])
def test_times_in_either_equals_join_then_filter(spark, minutes):
    a, f = feeds(spark, 11)
    con = duckdb.connect()
    con.register("a", a.toArrow())
    con.register("f", f.toArrow())
    since = None if minutes is None else hour(100) + timedelta(minutes=minutes)
    bound = "" if since is None else f"AND coalesce(f.scraped_ts, a.scraped_ts) >= TIMESTAMP '{since}'"
    want = con.execute(
        f"""SELECT DISTINCT coalesce(f.forecast_ts, a.event_ts) FROM a FULL OUTER JOIN f
        ON a.city = f.city AND a.event_ts = f.forecast_ts
        WHERE coalesce(f.forecast_ts, a.event_ts) IS NOT NULL {bound}"""
    ).fetchall()
    limit = None if since is None else F.lit(since).cast("timestamp_ntz")
    assert sorted(tuple(r) for r in times_in_either(a, f, limit).collect()) == sorted(want)


def test_union_tagged_pads_with_null(spark, rows):
    left = spark.createDataFrame([("a", 1)], "c string, x int")
    right = spark.createDataFrame([("b",)], "c string")
    assert rows(union_tagged({"one": left, "two": right}), "c", "x", "data_source") == [
        ("a", 1, "one"), ("b", None, "two")
    ]


# --- lookups -------------------------------------------------------------------------

def band_rows(values, bands):
    want = []
    for n, v in values:
        hits = [b for b, low, high in bands if v is not None and low is not None and low <= v <= high]
        want += [(n, v, b) for b in hits or [None]]
    return sorted(want, key=str)


@pytest.mark.parametrize("few", [0, 64])
@pytest.mark.parametrize("wide", [False, True])
def test_band_lookup_overlaps_gaps_and_edges(spark, monkeypatch, wide, few):
    monkeypatch.setattr(sweep, "ROWS_PER_RANGE", 20)
    rng = random.Random(2)
    bands = [(f"b{n}", low, low + rng.choice([0, 1, 7, 300])) for n, low in enumerate(rng.sample(range(-50, 400), 30))]
    bands += [("empty", 5, 4), ("nothing", None, 3)]
    if wide:
        bands += [("open", 100.0, float("inf")), ("all", float("-inf"), float("inf")), ("broad", -1e9, 1e9)]
    # Most rows share one value, and some have none.
    values = list(enumerate([*range(-60, 420, 3), 10**9, *[77] * 400, *[None] * 30]))
    got = lookup.band_lookup(
        spark.createDataFrame(values, "n int, v int").repartition(4), F.col("v"),
        spark.createDataFrame([(b, *[None if x is None else float(x) for x in limits]) for b, *limits in bands],
                              "name string, low double, high double"), "low", "high", {"band": "name"}, few=few,
    )
    assert sorted(map(tuple, got.collect()), key=str) == band_rows(values, bands)
    if not few:
        loads = got.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(loads) >= 4


def test_sweep_of_large_whole_numbers(spark):
    """Neighbours that are the same as doubles are told apart."""
    top = 2**60
    values = [(n, top + n) for n in range(50)]
    bands = [(f"b{n}", top + n, top + n + n % 3) for n in range(0, 60, 2)]
    got = sweep.sweep_join(
        spark.createDataFrame(values, "n int, v long"), F.col("v"),
        spark.createDataFrame(bands, "name string, low long, high long"), "low", "high", {"band": "name"})
    assert sorted(map(tuple, got.collect()), key=str) == band_rows(values, bands)


def test_sweep_of_empty_sides_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None), (4, float("inf"))], "n int, v double")
    bands = spark.createDataFrame([("a", 0.0, float("inf")), ("b", float("nan"), 9.0)], "name string, low double, high double")

    def found(left, right):
        return sorted((r.n, r.band) for r in sweep.sweep_join(left, F.col("v"), right, "low", "high", {"band": "name"}).collect())

    assert found(df, bands) == [(1, "a"), (2, None), (3, None), (4, "a")]
    assert found(df, bands.limit(0)) == [(n, None) for n in (1, 2, 3, 4)]
    assert found(df.limit(0), bands) == []


def test_sweep_in_small_pieces(monkeypatch):
    monkeypatch.setattr(sweep, "PAIRS_AT_ONCE", 10)
    at, low, high = np.sort(np.arange(100) % 37), np.arange(0, 40, 3), np.arange(0, 40, 3) + 5
    got = sorted((int(v), int(b)) for value, band in sweep._swept(at, low, high) for v, b in zip(value, band))
    want = [(v, b) for v, x in enumerate(at) for b in ([b for b in range(len(low)) if low[b] <= x <= high[b]] or [-1])]
    assert got == sorted(want)


def test_band_lookup_of_points(spark, rows):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.5,)], "v double")
    bands = spark.createDataFrame([(float(n), float(n), n) for n in range(5)], "low double, high double, name int")
    got = lookup.band_lookup(df, F.col("v"), bands, "low", "high", {"band": "name"})
    assert rows(got) == [(1.0, 1), (2.0, 2), (2.5, None)]


def test_dim_lookup(spark, rows):
    df = spark.createDataFrame([("a", 1), ("z", 2), (None, 3)], "city string, n int")
    dim = spark.createDataFrame([("a", "A1"), (None, "N")], "city string, id string")
    assert rows(lookup.dim_lookup(df, dim, "city", "city", {"city_id": "id"})) == [
        ("a", 1, "A1"), ("z", 2, None), (None, 3, None)
    ]


def test_orphans(spark, rows):
    fact = spark.createDataFrame([("a", "x"), ("a", None), ("b", "y"), ("c", None)], "p string, q string")
    one = spark.createDataFrame([("a",), ("a",)], "id string")
    two = spark.createDataFrame([("x",), ("y",)], "id string")
    assert rows(lookup.orphans(fact, {"p": (one, "id"), "q": (two, "id")})) == [("p", 4, 0, 2), ("q", 4, 2, 0)]


# --- running state -------------------------------------------------------------------

@pytest.fixture(params=[1, 3, 16])
def partitions(spark, request):
    """So many partitions of a shuffle, none of them joined with another."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], request.param)
    spark.conf.set(names[1], "false")
    yield request.param
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def test_day_offsets_vector(spark, partitions):
    hours = [22, 23, 0, 1, 2, 23, 0]
    df = spark.createDataFrame([("p", n, h) for n, h in enumerate(hours)], "page string, pos int, hour int")
    got = day_offsets(df, ["page"], ["pos"], "hour")
    assert [r.day_offset for r in got.orderBy("pos").collect()] == [0, 0, 1, 1, 1, 1, 2]
    assert day_offsets(df.limit(0), ["page"], ["pos"], "hour").count() == 0


@pytest.mark.parametrize("weights", [[1, 1, 1], [40, 1, 1], [1, 0, 0]])
def test_day_offsets_of_random_groups(spark, partitions, weights):
    rng = random.Random(4)
    data = [(rng.choices(["a", "b", None], weights)[0], n % 2, n, rng.randrange(24)) for n in range(400)]
    df = spark.createDataFrame(data, "g string, h int, pos int, hour int").repartition(5)
    got = {r.pos: r.day_offset for r in day_offsets(df, ["g", "h"], ["pos"], "hour").collect()}
    want, state = {}, {}
    for g, h, pos, hour in data:
        last, days = state.get((g, h), (-1, 0))
        days += hour < last
        state[g, h], want[pos] = (hour, days), days
    assert got == want


def test_day_offsets_shuffle_once(spark):
    df = spark.range(100).selectExpr("id % 3 AS g", "id AS pos", "cast(id * 7 % 24 AS int) AS hour")
    plans = []
    day_offsets_of = running.checkpointed
    running.checkpointed = lambda frame: plans.append(frame._jdf.queryExecution().executedPlan().toString()) or day_offsets_of(frame)
    try:
        day_offsets(df, ["g"], ["pos"], "hour")
    finally:
        running.checkpointed = day_offsets_of
    assert plans[0].count("Exchange") == 1 and plans[0].count("Range (") == 1


def test_global_row_number(spark):
    data = [(n * 7 % 100, n) for n in range(250)]
    df = spark.createDataFrame(data, "v int, n int").repartition(6)
    got = {(r.v, r.n): r.number for r in global_row_number(df, ["v", "n"], "number").collect()}
    assert got == {row: i + 1 for i, row in enumerate(sorted(data))}
