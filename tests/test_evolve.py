"""Columns that change their type, and tables in buckets."""

from datetime import date, datetime

import pytest
from pyspark.sql import types as T

from tierflow.sources.evolve import append_typed, promoted, promoted_schema, scan_typed
from tierflow.sources.buckets import write_bucketed
from tierflow.operators.merge import upsert_in_place
from tierflow.workloads.queries import QUERIES

INT, LONG, DOUBLE, TEXT = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


@pytest.mark.parametrize("one, other, want", [
    (INT, LONG, LONG), (T.ByteType(), T.ShortType(), T.ShortType()), (LONG, DOUBLE, DOUBLE), (INT, T.FloatType(), DOUBLE),
    (T.NullType(), TEXT, TEXT), (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()), (TEXT, TEXT, TEXT),
])
def test_promotions(one, other, want):
    assert promoted(one, other) == want == promoted(other, one)


@pytest.mark.parametrize("one, other", [(TEXT, INT), (T.BooleanType(), INT), (T.DateType(), LONG), (T.ArrayType(INT), INT)])
def test_unsafe_promotions(one, other):
    with pytest.raises(ValueError, match="no safe promotion"):
        promoted(one, other)


def test_types_widen_from_file_to_file(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, date(2026, 1, 2))], "v int, at date")
    assert append_typed(first, path) == 1
    assert scan_typed(spark, path).schema == first.schema
    assert append_typed(spark.createDataFrame([(2**40, None)], "v long, at date"), path) == 1
    assert append_typed(spark.createDataFrame([(datetime(2026, 3, 4, 5), 0.5, "x")], "at timestamp_ntz, v double, note string"), path) == 1
    assert append_typed(first, path) == 1
    got = scan_typed(spark, path)
    want = [(1.0, datetime(2026, 1, 2), None)] * 2 + [(float(2**40), None, None), (0.5, datetime(2026, 3, 4, 5), "x")]
    assert rows(got, "v", "at", "note") == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))
    assert {f.name: f.dataType.simpleString() for f in got.schema} == {"v": "double", "at": "timestamp_ntz", "note": "string"}


def test_an_unsafe_change_writes_nothing(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    append_typed(spark.createDataFrame([(1,)], "v int"), path)
    text = spark.createDataFrame([("x",)], "v string")
    with pytest.raises(ValueError, match="column v"):
        append_typed(text, path)
    assert rows(scan_typed(spark, path)) == [(1,)]
    assert append_typed(text, path, on_conflict="recreate") == 1
    assert rows(scan_typed(spark, path)) == [("x",)]


def test_whole_numbers_that_no_double_holds_stop_the_read(spark, tmp_path):
    path = str(tmp_path / "t")
    append_typed(spark.createDataFrame([(2**53 + 1,)], "v long"), path)
    append_typed(spark.createDataFrame([(0.5,)], "v double"), path)
    with pytest.raises(Exception, match="no double is"):
        scan_typed(spark, path).collect()


def test_schemas_are_joined_by_name():
    one, two = T.StructType().add("a", INT).add("b", TEXT), T.StructType().add("c", TEXT).add("a", LONG)
    assert promoted_schema(one, two) == T.StructType().add("a", LONG).add("b", TEXT).add("c", TEXT)


def test_bucketed_tables_are_joined_without_a_shuffle(spark):
    plan = QUERIES["fact_bucketed"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert plan.count("Bucketed: true") == 2


def test_a_merge_leaves_a_bucketed_target_where_it_is(spark, tmp_path, rows):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = write_bucketed(spark.range(100).selectExpr("id AS k", "id AS v"), "bucketed_target", str(tmp_path / "b"), ["k"], 4)
        source = spark.createDataFrame([(5, -1), (200, -2)], "k long, v long")
        got = upsert_in_place(target, source, "k")
        plan = got._jdf.queryExecution().executedPlan().toString()
        for part in plan.split("Exchange")[1:]:
            assert "bucketed_target" not in part.split("\n")[1]
        assert dict(rows(got)) == {**{n: n for n in range(100)}, 5: -1, 200: -2}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
