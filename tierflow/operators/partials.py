"""Aggregates of a partitioned table, kept per partition beside it.

A merge rewrites whole partitions, so the partial aggregates of just these are made again
from the rows at hand; those of all other partitions stay. An extreme that has been
overwritten, which no running minimum or maximum could take back, is thereby lost from its
partition's aggregate and from nowhere else. Merging the partials reads one row per
partition and group in place of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tierflow.sources.tables import drop_table, exists, scan_partitioned, with_folders


@dataclass(frozen=True)
class Partial:
    """Groups and what is kept of each: output name to ("min" or "max", column).

    Only aggregates that are merged by themselves are kept: the least of leasts, the
    greatest of greatests.
    """

    name: str
    groups: Callable[[], dict[str, Column]]  # columns exist in a session only
    kept: Mapping[str, tuple[str, str]]

    def path(self, table: str) -> str:
        return f"{table.rstrip('/')}__partials/{self.name}"

    def _merged(self, rows: DataFrame, by: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
        how = {"min": F.min, "max": F.max}
        return rows.groupBy(*by).agg(*[
            how[kind](columns[name]).alias(name) for name, (kind, _) in self.kept.items()])

    def of(self, rows: DataFrame) -> DataFrame:
        """The aggregates of rows that are all at hand."""
        return self._first(rows, [])

    def _first(self, rows: DataFrame, names: list[str]) -> DataFrame:
        groups, sources = self.groups(), {f"_{c}": F.col(c) for _, c in self.kept.values()}
        keyed = rows.select(*names, *[c.alias(n) for n, c in (groups | sources).items()])
        return self._merged(keyed, [*names, *groups], {n: f"_{c}" for n, (_, c) in self.kept.items()})

    def write(self, rows: DataFrame, table: str, partitions: Mapping[str, Column]) -> None:
        """Replace the aggregates of the partitions that the rows fill."""
        names = list(partitions)
        parts = self._first(with_folders(rows, partitions), names)
        parts.hint("rebalance", *names).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(*names).parquet(self.path(table))

    def read(self, spark: SparkSession, table: str, schema: StructType, kinds: Mapping[str, str]) -> DataFrame:
        """The aggregates of the whole table. A table without partials is aggregated itself."""
        stored = scan_partitioned(spark, table, schema, kinds)
        if not exists(spark, self.path(table)):
            return self.of(stored.drop(*kinds))
        shape = self.of(stored).schema
        parts = scan_partitioned(spark, self.path(table), shape, kinds).drop(*kinds)
        return self._merged(parts, list(self.groups()), {n: n for n in self.kept})

    def drop(self, spark: SparkSession, table: str) -> None:
        drop_table(spark, self.path(table))
