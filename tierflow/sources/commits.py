"""What has been merged into a table: a record per batch and a ledger of the raw files.

Both lie beside the table. A record tells that a batch has been published and how far the
table has come; the ledger lists the raw files whose rows the table holds. Writing either
again for the same batch replaces it, so a batch can be repeated at any point.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tierflow.operators.incremental import FIRST_RUN
from tierflow.sources.tables import drop_table, exists, make_folder

RECORD = T.StructType([
    T.StructField("batch", T.StringType()), T.StructField("high", T.TimestampNTZType()),
    T.StructField("published_at", T.TimestampType()),
])
FILE = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("modified", T.TimestampType()),
])


def records_path(path: str) -> str:
    return f"{path.rstrip('/')}__commits"


def ledger_path(path: str) -> str:
    return f"{path.rstrip('/')}__ledger"


def forget(spark: SparkSession, path: str) -> None:
    """Drop records and ledger, for a table that is built anew."""
    drop_table(spark, records_path(path))
    drop_table(spark, ledger_path(path))
    drop_table(spark, f"{path.rstrip('/')}__claimed")


def record_batch(spark: SparkSession, path: str, batch: str, high: datetime | None) -> None:
    """Note that a batch has been published; ``high`` is the latest time the batch has seen."""
    row = spark.range(0, 1, 1, 1).select(
        F.lit(batch).alias("batch"), F.lit(high).cast("timestamp_ntz").alias("high"), F.current_timestamp().alias("published_at"))
    row.write.mode("overwrite").parquet(f"{records_path(path)}/{batch}")


def records(spark: SparkSession, path: str) -> DataFrame:
    """One row per published batch."""
    make_folder(spark, records_path(path))
    return spark.read.schema(RECORD).option("recursiveFileLookup", True).parquet(records_path(path))


def changes(spark: SparkSession, path: str) -> DataFrame:
    """The records as a stream: one row for each batch that is published from now on."""
    make_folder(spark, records_path(path))
    return spark.readStream.schema(RECORD).option("recursiveFileLookup", True).parquet(records_path(path))


def look_back_bound(
    spark: SparkSession, path: str, column: str, days: float = 2, batch: str | None = None
) -> datetime:
    """The table's latest ``column`` minus ``days``, or a fixed early time for a first run.

    It is read off the records, one small row per batch, and not off the table. The batch's
    own record is left out: a repeated batch gets the bound that it had the first time. A
    table from before the records is asked itself.
    """
    known = records(spark, path)
    if batch is not None:
        known = known.filter(F.col("batch") != batch)
    high = known.agg(F.max("high")).first()[0]
    if high is None and exists(spark, path) and not exists(spark, f"{records_path(path)}/{batch}"):
        high = spark.read.parquet(path).agg(F.max(column)).first()[0]
    first = datetime.fromisoformat(FIRST_RUN)
    return first if high is None else max(first, high - timedelta(days=days))


def _plain(path):
    """A file's path without its scheme's slashes, which differ between listings."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def new_files(spark: SparkSession, raw: str, path: str) -> DataFrame:
    """file, modified: the raw files that the ledger of ``path`` does not hold.

    Listing is Spark's own, in parallel for many folders, and no file is opened.
    """
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(raw)
        .select(_plain(F.col("path")).alias("file"), F.col("modificationTime").alias("modified"))
    )
    if not exists(spark, ledger_path(path)):
        return listed
    known = spark.read.schema(FILE).option("recursiveFileLookup", True).parquet(ledger_path(path))
    return listed.join(known, ["file", "modified"], "left_anti")


def scan_files(spark: SparkSession, raw: str, schema: T.StructType, files: DataFrame) -> DataFrame | None:
    """The rows of the given files of a raw table, or None if there are none.

    Two conditions choose them. The earliest time among the files is a literal, by which
    Spark leaves out older files while it plans; the files themselves are joined, so their
    names need not come to the driver.
    """
    since, count = files.agg(F.min("modified"), F.count(F.lit(1))).first()
    if not count:
        return None
    # A path in the metadata column is encoded as a URI is, where + stands for itself.
    own = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    rows = spark.read.schema(schema).parquet(raw)
    rows = rows.filter(F.col("_metadata.file_modification_time") >= F.lit(since)).withColumn("_file", _plain(own))
    return rows.join(files.select(F.col("file").alias("_file")), "_file", "left_semi").select(*schema.names)


def claim_files(spark: SparkSession, raw: str, path: str, batch: str) -> DataFrame:
    """The new files as a stored list, which a repeated batch finds again.

    Files that land later belong to the next batch, also when this one is repeated.
    """
    claim = f"{path.rstrip('/')}__claimed/{batch}"
    if not exists(spark, f"{claim}/_SUCCESS"):
        new_files(spark, raw, path).write.mode("overwrite").parquet(claim)
    return spark.read.schema(FILE).parquet(claim)


def settle_files(spark: SparkSession, path: str, batch: str) -> None:
    """Enter the files of a merged batch in the ledger, and drop the claim on them."""
    claim = f"{path.rstrip('/')}__claimed/{batch}"
    if exists(spark, f"{claim}/_SUCCESS"):
        files = spark.read.schema(FILE).parquet(claim)
        files.write.mode("overwrite").parquet(f"{ledger_path(path)}/{batch}")
        drop_table(spark, claim)
