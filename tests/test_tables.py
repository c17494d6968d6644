import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow import schemas
from tierflow.operators.merge import upsert
from tierflow.session import scratch_path, shared_dir
from tierflow.sources import tables
from tierflow.sources.targets import locations_from_config, target_list

KIND = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("city", T.StringType()),
    T.StructField("at", T.TimestampNTZType()), T.StructField("v", T.IntegerType()),
])
AT = datetime(2026, 3, 10)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def frame(spark, *data):
    return spark.createDataFrame(list(data), KIND)


def parts():
    return {"p_city": F.col("city"), "p_day": tables.day_of("at")}


PART_TYPES = {"p_city": "string", "p_day": "date"}


def test_shared_dir_is_the_configured_one(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured
    assert scratch_path(spark, "x").startswith(configured)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_append_creates_counts_and_evolves(spark, path, rows):
    old = spark.createDataFrame([("a", "1"), ("b", "2")], "city string, observation_time string")
    old = tables.renamed(old, schemas.RENAMED_COLUMNS)
    new = spark.createDataFrame([("p", "c", "3")], "province string, city string, observation_ts string")
    assert tables.append(old, path) == 2
    assert tables.append(new, path) == 1
    got = tables.scan(spark, path, tables.evolved_schema(old.schema, new.schema))
    assert rows(got, "province", "city", "observation_ts") == [("p", "c", "3"), (None, "a", "1"), (None, "b", "2")]


def test_ensure_is_idempotent_and_drop_removes(spark, path, rows):
    assert rows(tables.ensure_table(spark, path, KIND)) == []
    tables.append(frame(spark, ("1", "a", AT, 1)), path)
    assert len(rows(tables.ensure_table(spark, path, KIND))) == 1
    assert tables.describe(tables.scan(spark, path, KIND))[2] == ("at", "timestamp_ntz")
    tables.drop_table(spark, path)
    assert not tables.exists(spark, path)


def test_insert_values(spark, rows):
    got = tables.insert_values(frame(spark, ("1", "a", AT, 1)), [("2", None, None, None)])
    assert rows(got) == [("1", "a", AT, 1), ("2", None, None, None)]


def test_partitioned_layout_keeps_nulls_and_prunes(spark, path, rows):
    df = frame(spark, ("1", "a b", AT, 1), ("2", "", AT, 2), ("3", None, None, 3), ("4", "a b", datetime(2026, 3, 11, 5), 4))
    tables.write_partitioned(df, path, parts(), ["at"])
    got = tables.scan_partitioned(spark, path, KIND, PART_TYPES)
    assert rows(got.select(*KIND.names)) == rows(df)
    one_day = got.filter(F.col("p_day") == F.lit(date(2026, 3, 11)))
    assert rows(one_day, "id") == [("4",)]
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p_day" in plan
    with pytest.raises(ValueError, match="new names"):
        tables.write_partitioned(df, path, {"city": F.col("city")}, [])


def test_files_are_sorted(spark, path):
    df = spark.range(1000).selectExpr(
        "cast(id AS string) AS id", "concat('c', id % 2) AS city", "timestampadd(HOUR, (id * 37) % 20, timestamp_ntz'2026-03-10') AS at", "1 AS v"
    )
    tables.write_partitioned(df, path, parts(), ["at"])
    got = spark.read.parquet(path).withColumns({"f": F.input_file_name(), "n": F.monotonically_increasing_id()})
    for _, group in got.toPandas().groupby("f"):
        assert group.sort_values("n")["at"].is_monotonic_increasing


def test_partition_columns(spark):
    df = frame(spark, ("1", "a", AT, 1)).select(tables.day_of("at"), tables.month_of("at"), tables.year_of("at"))
    assert tuple(df.first()) == (date(2026, 3, 10), "2026-03", 2026)


def test_csv_keeps_awkward_text(spark, path, rows):
    df = spark.createDataFrame([("a,b", 1.5), ('say "x"\nthen', None), (None, 2.0), ("", 3.0)], "t string, v double")
    landed = tables.land_csv(df, path, "aqi", "20260310_1400")
    assert landed.endswith("/aqi_20260310_1400.csv")
    assert rows(tables.read_csv(spark, landed, df.schema)) == rows(df)


def test_one_csv_file_is_read_by_several_tasks(spark, path, rows):
    signs = ["a\nb", "\r", "\\n", "\\", "\\b\\r", 'q"q', " lead", "trail ", "", None, ",", "x\r\n\\\n"]
    df = spark.createDataFrame([(n, signs[n % len(signs)], "y" * 50) for n in range(3000)], "n int, t string, pad string").coalesce(1)
    landed = tables.land_csv(df, path, "aqi", "1")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        got = tables.read_csv(spark, landed, df.schema)
        assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 4
        assert rows(got) == rows(df)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_old_versions_are_removed(spark, path):
    for number in range(10):
        tables.write_version(frame(spark, (str(number), "a", AT, number)), path, keep=3)
    assert [n for n, _ in tables.versions(spark, path)] == [8, 9, 10]
    assert spark.read.parquet(tables.latest_version(spark, path)).first().v == 9
    with pytest.raises(ValueError):
        tables.write_version(frame(spark), path, keep=0)


def scans_of(df):
    """The file scans of an executed plan, each with the files that it has read."""
    found, nodes = [], [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        if name.endswith("QueryStageExec"):
            nodes.append(node.plan())
        if name == "FileSourceScanExec":
            found.append((node.toString(), node.metrics().apply("numFiles").value()))
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_lookup_by_hash_reads_the_files_of_its_keys(spark, path, rows):
    df = spark.range(4000).selectExpr("upper(md5(cast(id AS string))) AS id", "id AS n")
    tables.write_by_key(df, path, "id", digits=2)
    wanted = [r.id for r in df.filter("n IN (7, 11, 500)").collect()]
    got = tables.find_keys(spark, path, df.schema, "id", [*wanted, None, "FF" + "0" * 30])
    assert rows(got, "n") == [(11,), (500,), (7,)]
    got.collect()
    (scan, files), = scans_of(got)
    assert files == len({k[:2] for k in wanted} | {"FF"})
    assert "In(id" in scan.split("PushedFilters: [")[1]
    assert tables.find_keys(spark, path, df.schema, "id", []).count() == 0


def test_only_touched_folders_are_read_among_thousands(spark, path):
    df = spark.range(3000).selectExpr("cast(id AS string) AS id", "concat('c', id) AS city", "timestamp_ntz'2026-03-10' AS at", "1 AS v")
    df.withColumn("p_city", F.col("city")).repartition(4).write.partitionBy("p_city").parquet(path)
    table = tables.scan_partitioned(spark, path, KIND, {"p_city": "string"})
    batch = frame(spark, ("5", "c5", AT, 9), ("77", "c77", AT, 9), ("n", "new", AT, 9)).withColumn("p_city", F.col("city"))
    got = tables._touched(table, batch, ["p_city"])
    assert got.count() == 2
    got.collect()
    assert [files for scan, files in scans_of(got) if "p_city" in scan] == [2]


def test_versions(spark, path, rows):
    assert tables.latest_version(spark, path) is None
    first = frame(spark, ("1", "a", AT, 1))
    tables.write_version(first, path)
    # The new version is built from the latest one.
    state = spark.read.parquet(tables.latest_version(spark, path))
    tables.write_version(upsert(state, frame(spark, ("1", "a", AT, 9), ("2", "b", AT, 2)), "id"), path)
    assert tables.latest_version(spark, path).endswith("version=2")
    spark.createDataFrame([], KIND).write.parquet(f"{path}/version=3")
    tables.drop_table(spark, f"{path}/version=3/_SUCCESS")
    assert rows(spark.read.parquet(tables.latest_version(spark, path)), "id", "v") == [("1", 9), ("2", 2)]


def test_upsert_table_rewrites_touched_partitions_only(spark, path, rows):
    later = datetime(2026, 3, 11)
    tables.upsert_table(frame(spark, ("1", "a", AT, 1), ("2", "b", AT, 2), ("3", "a", later, 3)), path, "id", parts(), ["at"], "0")
    before = {f: None for f in spark.read.parquet(path).inputFiles()}
    tables.upsert_table(frame(spark, ("1", "a", AT, 10), ("4", "a", AT, 4)), path, "id", parts(), ["at"], "1")
    got = tables.scan_partitioned(spark, path, KIND, PART_TYPES)
    assert rows(got, "id", "v") == [("1", 10), ("2", 2), ("3", 3), ("4", 4)]
    kept = [f for f in spark.read.parquet(path).inputFiles() if f in before]
    assert len(kept) == 2


def test_upsert_table_moves_rows_between_partitions(spark, path, rows):
    later, other = datetime(2026, 3, 12), datetime(2026, 3, 11)
    first = frame(
        spark, ("1", "a", AT, 1), ("2", "a b", AT, 2), ("3", "c", AT, 3), ("5", "a", other, 5), ("6", "a b", AT, 6)
    )
    options = {"scope": ["p_city"]}
    tables.upsert_table(first, path, "id", parts(), ["at"], "0", **options)
    before = set(spark.read.parquet(path).inputFiles())
    tables.upsert_table(
        frame(spark, ("1", "a", later, 9), ("2", "a b", later, 8)), path, "id", parts(), ["at"], "1", **options
    )
    got = tables.scan_partitioned(spark, path, KIND, PART_TYPES)
    assert rows(got, "id", "at", "v") == [
        ("1", later, 9), ("2", later, 8), ("3", AT, 3), ("5", other, 5), ("6", AT, 6)
    ]
    # Neither the other city nor the day of the same city without a moved row is rewritten.
    assert len(before & set(spark.read.parquet(path).inputFiles())) == 2


def test_a_staged_batch_is_published_again(spark, path, rows):
    tables.upsert_table(frame(spark, ("1", "a", AT, 1)), path, "id", parts(), ["at"], "0")
    # A run that was lost after staging and in the middle of publishing.
    frame(spark, ("1", "a", AT, 5), ("2", "a", AT, 6)).write.parquet(f"{path}__staged/1")
    tables.drop_table(spark, f"{path}/p_city=a")
    tables.upsert_table(frame(spark, ("2", "a", AT, 6)), path, "id", parts(), ["at"], "1")
    assert rows(tables.scan_partitioned(spark, path, KIND, PART_TYPES), "id", "v") == [("1", 5), ("2", 6)]
    assert not tables.exists(spark, f"{path}__staged/1")


def test_table_path():
    assert tables.table_path("/data/", "silver", "aqi_index") == "/data/silver/aqi_index"


def test_target_list(spark, rows):
    locations = locations_from_config(spark, [
        {"province": "west-java", "cities": ["bandung", "depok"]}, {"province": "jakarta", "cities": ["jakarta"]},
        {"province": "none", "cities": None},
    ])
    assert rows(target_list(locations, "https://example.org/%s/%s"), "province", "city", "url") == [
        ("Jakarta", "Jakarta", "https://example.org/jakarta/jakarta"),
        ("West Java", "Bandung", "https://example.org/west-java/bandung"),
        ("West Java", "Depok", "https://example.org/west-java/depok"),
    ]
