"""Run a job once all of several tables have changed."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tierflow.sources.commits import changes
from tierflow.sources.tables import drop_table, exists, make_folder, touch


def run_when_all_changed(
    spark: SparkSession, tables: Mapping[str, str], state: str, action: Callable[[str], None]
) -> StreamingQuery:
    """Look at the batches published since the last run, call ``action`` if due, and stop.

    ``tables`` names the tables and their paths. Their records are the sources of one query,
    so its checkpoint, below ``state``, keeps an offset per table. A table that has changed
    is marked as pending, also over several runs; when all are, ``action`` is called with
    the name of the run, the run is marked as done, and the marks are taken off.

    A run that fails is repeated under the same name. One that is lost after it was marked as
    done is not: the mark of the run stands for the whole set of changes that led to it.
    """
    streams = [changes(spark, path).select(F.lit(name).alias("table")) for name, path in tables.items()]

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId") or "run"
        run = f"{query}-{number}"
        done, pending = f"{state}/done/{run}", f"{state}/pending"
        if not exists(session, done):
            make_folder(session, pending)
            # One row per table, of which there are a few.
            for row in batch.groupBy("table").count().collect():
                touch(session, f"{pending}/{row['table']}")
            if not all(exists(session, f"{pending}/{name}") for name in tables):
                return
            action(run)
            make_folder(session, f"{state}/done")
            touch(session, done)
        drop_table(session, pending)

    return (
        reduce(DataFrame.unionByName, streams).writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
    )
