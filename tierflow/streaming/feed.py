"""Micro-batch loading of the actual feed into its keyed table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tierflow import schemas
from tierflow.functions import times
from tierflow.plans.silver import ACTUAL_ORDER, silver_actual
from tierflow.sources import commits
from tierflow.sources.tables import month_of, upsert_table


PARTITION_TYPES = {"p_city": "string", "p_month": "string"}


def actual_partitions():
    """Partition columns of the actual table; both are functions of its key.

    A city has at most one row per hour, so a month rather than a day makes a file.
    """
    return {"p_city": F.col("city"), "p_month": month_of("event_ts")}


def split_late(raw: DataFrame, bound: datetime) -> tuple[DataFrame, DataFrame]:
    """(rows scraped at the bound or after it, all others).

    A row whose scrape time cannot be read is among the others: nothing says that it is
    recent.
    """
    recent = F.coalesce(times.from_text(F.col("scraped_ts")) >= F.lit(bound).cast("timestamp_ntz"), F.lit(False))
    return raw.filter(recent), raw.filter(~recent)


def merge_actual_batch(
    raw: DataFrame, path: str, batch: str, since: str | None = None, days: float | None = None,
    late: str | None = None,
) -> None:
    """Clean one batch and merge it; an older scrape never replaces a newer one.

    Keys are deterministic and the versions of a key have one order, so late, repeated and
    replayed rows lead to the same table as one run over all rows. The stored rows are not
    ranked again, and stay unshuffled when the batch is small. Rows without a key are left
    out, as they match nothing and each delivery would add them once more.

    ``days`` limits the batch to rows scraped at most so long before the latest scrape that
    the table has seen. The others go to the table ``late`` as they came, with the bound
    and the batch, in the batch's own folder; so no row is lost, and none twice.
    """
    spark = raw.sparkSession
    if days is not None:
        bound = commits.look_back_bound(spark, path, "scraped_ts", days, batch)
        raw, beyond = split_late(raw, bound)
        if late is not None:
            beyond.withColumns({
                "bound": F.lit(bound).cast("timestamp_ntz"), "batch": F.lit(batch)
            }).write.mode("overwrite").parquet(f"{late.rstrip('/')}/{batch}")

    def published(rows: DataFrame, high: datetime | None) -> None:
        commits.record_batch(spark, path, batch, high)

    # One version per key is what cleaning leaves, so the keys need no check.
    upsert_table(
        silver_actual(raw, since=since), path, "id", actual_partitions(), ["event_ts"], batch,
        published=published, high="scraped_ts", newer_by=ACTUAL_ORDER, drop_null_keys=True, check_unique=False,
    )


def late_rows(spark: SparkSession, late: str) -> DataFrame:
    """The rows that came too late, as they came, with the bound of their batch."""
    schema = StructType(list(schemas.RAW_ACTUAL)).add("bound", "timestamp_ntz").add("batch", "string")
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(late)


def stream_actual(
    spark: SparkSession, landing: str, path: str, checkpoint: str,
    files_per_batch: int | None = None, look_back: str | None = None,
    look_back_days: float | None = None, late: str | None = None,
) -> StreamingQuery:
    """Load the files that have landed since the last run, then stop.

    ``look_back_days`` bounds each batch by what the table has seen before it, see
    ``merge_actual_batch``; rows beyond go to ``late``. ``look_back`` is a fixed bound, a
    time text: rows scraped before it are left out.
    """
    reader = spark.readStream.schema(schemas.RAW_ACTUAL)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(landing)

    def load(batch: DataFrame, number: int) -> None:
        context = batch.sparkSession.sparkContext
        query = context.getLocalProperty("sql.streaming.queryId") or "batch"
        merge_actual_batch(batch, path, f"{query}-{number}", look_back, look_back_days, late)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
