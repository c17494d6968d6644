"""Tables on shared storage: create, append, evolve, partition, replace and merge."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from tierflow.operators.merge import upsert, upsert_in_place


def table_path(base: str, layer: str, name: str) -> str:
    """The layer's name is used as it is."""
    return f"{base.rstrip('/')}/{layer}/{name}"


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _filesystem(spark, path)
    return fs.exists(hadoop_path)


def drop_table(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _filesystem(spark, path)
    fs.delete(hadoop_path, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _filesystem(spark, path)
    fs.mkdirs(hadoop_path)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, as a marker."""
    fs, hadoop_path = _filesystem(spark, path)
    fs.create(hadoop_path, True).close()


def ensure_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Create an empty table with the declared schema unless the path exists."""
    if not exists(spark, path):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return scan(spark, path, schema)


def scan(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read with a declared schema; columns that older files lack read NULL."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def describe(df: DataFrame) -> list[tuple[str, str]]:
    return [(field.name, field.dataType.simpleString()) for field in df.schema]


def append(df: DataFrame, path: str) -> int:
    """Append, creating the table if it is missing. Returns the number of rows added.

    The count is taken while writing, so the data is computed once.
    """
    seen = Observation("appended")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return seen.get["rows"]


def evolved_schema(*schemas: StructType) -> StructType:
    """Union of the schemas by name; the first type of a name holds."""
    fields = {}
    for schema in schemas:
        for field in schema:
            fields.setdefault(field.name, field)
    return StructType(list(fields.values()))


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Bring older column names to the present ones, where they occur."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def insert_values(df: DataFrame, rows: Sequence[tuple]) -> DataFrame:
    """The rows of a table with some literal rows added."""
    return df.unionByName(df.sparkSession.createDataFrame(list(rows), df.schema))


def insert_into(spark: SparkSession, path: str, schema: StructType, rows: Sequence[tuple]) -> int:
    """Append literal rows to a stored table; stored files stay as they are."""
    return append(spark.createDataFrame(list(rows), schema), path)


def day_of(column: str) -> Column:
    return F.to_date(F.col(column))


def month_of(column: str) -> Column:
    return F.substring(F.col(column).cast("string"), 1, 7)


def year_of(column: str) -> Column:
    return F.year(F.col(column))


def with_folders(df: DataFrame, partitions: Mapping[str, Column]) -> DataFrame:
    """The partition columns as they are written.

    A nullable text would be rewritten by the writer, which then sorts by the partition
    columns alone. Empty texts and NULL share a directory anyway.
    """
    df = df.withColumns(dict(partitions))
    texts = [f.name for f in df.schema if f.name in partitions and f.dataType == StringType()]
    return df.withColumns({name: F.coalesce(name, F.lit("")) for name in texts})


def laid_out(df: DataFrame, partitions: Mapping[str, Column], sort: Sequence[str]) -> DataFrame:
    """Arrange rows for a partitioned, sorted write.

    The rebalance hint gathers the rows of a partition value in few files, and lets Spark
    split a value that holds far more rows than others over several tasks.
    """
    names = list(partitions)
    return with_folders(df, partitions).hint("rebalance", *names).sortWithinPartitions(*names, *sort)


def _with_partitions(df: DataFrame, partitions: Mapping[str, Column]) -> DataFrame:
    """The partition columns as a reader of the table sees them: an empty text is NULL."""
    df = df.withColumns(dict(partitions))
    texts = [f.name for f in df.schema if f.name in partitions and f.dataType == StringType()]
    return df.withColumns({name: F.nullif(F.col(name), F.lit("")) for name in texts})


def write_partitioned(
    df: DataFrame, path: str, partitions: Mapping[str, Column], sort: Sequence[str],
    mode: str = "overwrite",
) -> None:
    """Write below directories named by derived columns, sorted inside the files.

    Partition columns are copies with names of their own: directory names cannot tell
    NULL from an empty text, and the data columns stay untouched.
    """
    clash = set(partitions) & set(df.columns)
    if clash:
        raise ValueError(f"partition columns need new names: {sorted(clash)}")
    (
        laid_out(df, partitions, sort).write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if mode == "overwrite" else "static")
        .partitionBy(*partitions).parquet(path)
    )


def scan_partitioned(
    spark: SparkSession, path: str, schema: StructType, partitions: Mapping[str, str]
) -> DataFrame:
    """Read a partitioned table; ``partitions`` maps the derived columns to their types."""
    full = StructType(list(schema))
    for name, kind in partitions.items():
        full = full.add(name, kind)
    return spark.read.schema(full).parquet(path)


def write_by_key(
    df: DataFrame, path: str, key: str, digits: int = 2, expected: int = 1_000_000, mode: str = "overwrite"
) -> None:
    """Lay a table out for lookups by a hash: folders by its first digits, files sorted by it.

    Each file also has a Bloom filter of the key, made for ``expected`` keys, so that a file
    without a wanted key is left after its footer.
    """
    (
        laid_out(df, {"p_key": F.substring(F.col(key), 1, digits)}, [key]).write.mode(mode)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", str(expected))
        .partitionBy("p_key").parquet(path)
    )


def find_keys(
    spark: SparkSession, path: str, schema: StructType, key: str, wanted: Sequence[str], digits: int = 2
) -> DataFrame:
    """The rows of the given keys in a table of ``write_by_key``.

    The keys are literals: their folders are chosen while planning, and the files get the
    keys themselves.
    """
    keys = sorted({k for k in wanted if k is not None})
    table = scan_partitioned(spark, path, schema, {"p_key": "string"})
    near = F.col("p_key").isin(sorted({k[:digits] for k in keys})) & F.col(key).isin(keys)
    return table.filter(near).drop("p_key")


# A line break inside a text would keep a file from being split, so it is written as a mark.
# Backslashes are marked too, hence every one that is read belongs to a mark.
_MARKS = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))


def _texts_mapped(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    return df.select(*[
        change(F.col(f.name)).alias(f.name) if f.dataType == StringType() else F.col(f.name) for f in df.schema])


def _marked(text: Column) -> Column:
    for sign, mark in _MARKS:
        text = F.replace(text, F.lit(sign), F.lit(mark))
    return text


def _unmarked(text: Column) -> Column:
    for sign, mark in reversed(_MARKS):
        text = F.replace(text, F.lit(mark), F.lit(sign))
    return text


def land_csv(df: DataFrame, folder: str, label: str, stamp: str) -> str:
    """Write a CSV landing, named by label and time, with a header. Returns its path.

    One row is one line, whatever its texts hold.
    """
    path = f"{folder.rstrip('/')}/{label}_{stamp}.csv"
    (
        _texts_mapped(df, _marked).write.mode("errorifexists").option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a landing; large files are read by several tasks.

    A null marker that cannot occur keeps quoted empty texts apart from absent values.
    """
    lines = (
        spark.read.schema(schema).option("header", True).option("escape", '"')
        .option("nullValue", "\u0000").option("enforceSchema", True).csv(path)
    )
    return _texts_mapped(lines, _unmarked)


def write_version(
    df: DataFrame, base: str, keep: int | None = None, partitions: Mapping[str, Column] | None = None
) -> str:
    """Write a whole table as a new version directory. Readers keep the version they opened.

    This is how a table is rebuilt from its own former state: the path being read is not
    the path being written. With ``keep`` only so many of the newest versions stay, once the
    new one is complete. ``partitions`` are derived columns that name its folders.
    """
    if keep is not None and keep < 1:
        raise ValueError("keep must be 1 or more")
    latest = latest_version(df.sparkSession, base)
    number = 1 if latest is None else int(latest.rsplit("=", 1)[1]) + 1
    path = f"{base.rstrip('/')}/version={number}"
    # A directory of this number without a success marker is left from a failed write.
    if partitions:
        with_folders(df, partitions).hint("rebalance", *partitions).write.mode("overwrite").partitionBy(*partitions).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    if keep is not None:
        for _, old in versions(df.sparkSession, base)[:-keep]:
            drop_table(df.sparkSession, old)
    return path


def versions(spark: SparkSession, base: str) -> list[tuple[int, str]]:
    """Number and path of the complete versions, oldest first."""
    fs, root = _filesystem(spark, base)
    if not fs.exists(root):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    found = [(int(n.split("=", 1)[1]), f"{base.rstrip('/')}/{n}") for n in names if n.startswith("version=")]
    return sorted((n, path) for n, path in found if exists(spark, f"{path}/_SUCCESS"))


def latest_version(spark: SparkSession, base: str) -> str | None:
    """The path of the newest complete version, or None."""
    found = versions(spark, base)
    return found[-1][1] if found else None


def _touched(df: DataFrame, source: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of ``df`` in the partitions that occur in ``source``.

    The partition values of the source are one set, a scalar subquery in a filter on
    partition columns: Spark evaluates it before it lists the files, so folders are left out
    whatever their number. Structs compare NULL fields as equal.
    """
    own = F.struct(*[F.col(n).alias(n) for n in names])
    wanted = source.select(F.collect_set(F.struct(*[F.col(n).alias(n) for n in names])))
    return df.filter(F.array_contains(wanted.scalar(), own))


def upsert_table(
    source: DataFrame,
    path: str,
    key: str,
    partitions: Mapping[str, Column],
    sort: Sequence[str],
    batch: str,
    scope: Sequence[str] | None = None,
    combine: Callable[[DataFrame | None, DataFrame], DataFrame] | None = None,
    published: Callable[[DataFrame, object], None] | None = None,
    high: str | None = None,
    **options,
) -> None:
    """Merge a batch into a partitioned table, rewriting only the partitions it touches.

    The merged partitions are first written to a staging table beside the path and then
    published from there, so the path is never read and overwritten in one job. The
    staging table is named by ``batch``: a batch repeated after a failure between the two
    steps publishes the staged rows again instead of merging into a half-written table.

    The partition columns have to be functions of the key. If rows can move between
    partitions, name in ``scope`` the partition columns that cannot change. The keys of all
    partitions with the same scope values are then searched for the batch's keys, and the
    partitions that hold one are rewritten too.

    ``combine`` makes the merged rows of the stored ones (None at first) and the batch; it
    is an upsert by ``key`` with the given options unless stated, which leaves the stored
    rows unshuffled when the batch is small.

    ``published`` is called with all rows of the rewritten partitions once they are in
    place, and with the highest value of the column ``high`` in them, which is found while
    they are staged. It is called again when a batch is repeated.
    """
    if combine is None:
        def combine(old, new):
            if old is None:
                return upsert(old, new, key, **options)
            return upsert_in_place(old, new, key, **options)

    spark = source.sparkSession
    names = list(partitions)
    scope = names if scope is None else list(scope)
    stage = f"{path.rstrip('/')}__staged/{batch}"
    staged_schema = source.withColumns(dict(partitions)).schema
    moving = set(names) - set(scope)

    if not exists(spark, f"{stage}/_SUCCESS"):
        if exists(spark, path):
            incoming = f"{stage}-rows"
            if not exists(spark, f"{incoming}/_SUCCESS"):
                source.write.mode("overwrite").parquet(incoming)
            source = spark.read.schema(source.schema).parquet(incoming)
            table = spark.read.schema(staged_schema).parquet(path)
            wanted = _with_partitions(source, partitions).select(*names)
            if moving:
                wanted = wanted.unionByName(
                    _holding(table, source, key, partitions, scope).select(*names)
                )
            near = _touched(table, wanted, names)
            merged = combine(near.select(*source.columns), source)
        else:
            merged = combine(None, source)
        seen = Observation("staged")
        if high is not None:
            merged = merged.observe(seen, F.max(high).alias("high"))
        merged.write.mode("overwrite").parquet(stage)
        top = seen.get["high"] if high is not None else None
    elif high is not None:
        top = spark.read.schema(source.schema).parquet(stage).agg(F.max(high)).first()[0]
    else:
        top = None
    merged = spark.read.schema(source.schema).parquet(stage)
    if moving and exists(spark, path):
        table = spark.read.schema(staged_schema).parquet(path)
        _drop_left_partitions(table, merged, key, partitions, scope)
    write_partitioned(merged, path, partitions, sort)
    if published is not None:
        published(merged, top)
    drop_table(spark, stage)
    drop_table(spark, f"{stage}-rows")


def _holding(table, batch, key, partitions, scope) -> DataFrame:
    """Rows of the table, within the batch's scope, whose key occurs in the batch."""
    keys = [key] if isinstance(key, str) else list(key)
    near = _touched(table, _with_partitions(batch, partitions), scope)
    return near.join(batch.select(*keys), keys, "left_semi")


def _drop_left_partitions(table, merged, key, partitions, scope) -> None:
    """Delete the partitions whose rows have all moved into others."""
    spark = table.sparkSession
    names = list(partitions)
    folder = F.regexp_replace(F.col("_metadata.file_path"), r"/[^/]*$", "")
    held = _holding(table.withColumn("_folder", folder), merged, key, partitions, scope)
    kept = _with_partitions(merged, partitions).select(*names).distinct().toDF(*[f"_k_{n}" for n in names])
    match = [F.col(n).eqNullSafe(F.col(f"_k_{n}")) for n in names]
    left = held.join(kept, match, "left_anti").select("_folder").distinct()
    jvm = spark.sparkContext._jvm
    for row in left.toLocalIterator():
        # File paths are URIs, in which special characters are encoded.
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(row["_folder"]))
        drop_table(spark, path.toString())
