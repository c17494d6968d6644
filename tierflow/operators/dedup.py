"""Keep one version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierflow.functions.text import measure_kind


def _unsortable(field) -> bool:
    return field.dataType.typeName() in ("map", "variant")


def version_order(schema, keys: Sequence[str], order: str, keep: str = "last") -> list[tuple[str, bool]]:
    """The order in which versions of a key rank: by ``order``, then by their other columns.

    Each column comes with whether its highest values are first; NULLs are last.
    """
    known = {*keys, order}
    return [(order, keep == "last"), *[
        (field.name, False) for field in schema if field.name not in known and not _unsortable(field)]]


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    keep: str = "last",
    priority: Column | None = None,
) -> DataFrame:
    """One row per key: the last (or first) by ``order``, after an optional priority.

    Rows equal in ``order`` are told apart by their other columns, so the result does not
    depend on row order. Filtering on the rank lets Spark keep one row per key in every
    task before the shuffle, hence a key holding a large share of all rows sends at most
    one row per task.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    ordering = [] if priority is None else [priority.asc_nulls_last()]
    ordering += [
        (F.desc_nulls_last if highest else F.asc_nulls_last)(name)
        for name, highest in version_order(df.schema, keys, order, keep)
    ]
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def first_row_only(
    df: DataFrame, group: Sequence[str], order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Blank the given text columns on all rows of a group but its first.

    ``order`` has to be unique within a group. The first row of each group is found by a
    pre-aggregated top-1 and joined back on group *and* order, so the rows of a large
    group stay spread over the cluster instead of being numbered in one task.
    """
    key = [*group, *order]
    heads = df.select(*key)
    window = Window.partitionBy(*group).orderBy(*[F.asc_nulls_last(name) for name in order])
    heads = heads.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1")
    heads = heads.select(*[F.col(name).alias(f"_h_{name}") for name in key], F.lit(True).alias("_head"))
    match = [F.col(name).eqNullSafe(F.col(f"_h_{name}")) for name in key]
    joined = df.join(heads, match, "left")
    shown = {name: F.when(F.col("_head"), F.col(name)).otherwise(F.lit("")) for name in columns}
    return joined.select(*[shown[c].alias(c) if c in shown else F.col(c) for c in df.columns])


def last_measures(df: DataFrame, group: Sequence[str], text: str, pos: str) -> DataFrame:
    """Per group the last text of each measure kind, for texts in rows of their own.

    Only one candidate per group and kind leaves a task before the shuffle.
    """
    kind = measure_kind(F.col(text))

    def last_of(name: str) -> Column:
        return F.coalesce(F.max_by(text, F.when(kind == name, F.col(pos))), F.lit("N/A")).alias(name)

    return df.groupBy(*group).agg(*[last_of(k) for k in ("temperature", "wind_speed", "humidity")])
