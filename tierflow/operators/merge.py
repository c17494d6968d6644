"""Upserts as DataFrame transformations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def spread_null_keys(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Add a column that spreads rows with a NULL key and is zero for all others.

    A NULL key matches nothing, yet equal hashing would send all such rows to one task. The
    input partition enters the hash for the sake of equal rows; it is the same again when a
    task is repeated.
    """
    hashed = [f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
    spread = F.xxhash64(*hashed, F.spark_partition_id())
    return df.withColumn(name, F.when(_any_null(keys), spread).otherwise(F.lit(0).cast("bigint")))


def unique_or_fail(df: DataFrame, keys: Sequence[str], spread: str | None = None) -> DataFrame:
    """Fail the job when two rows share a key without NULLs."""
    parts = [*keys, spread] if spread else list(keys)
    window = Window.partitionBy(*parts).orderBy(*keys)
    text = F.concat(F.lit("duplicate source key: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    number = F.row_number().over(window)
    ok = F.when((number > 1) & ~_any_null(keys), F.raise_error(text).cast("boolean")).otherwise(True)
    return df.withColumn("_ok", ok).filter("_ok").drop("_ok")


def _checked_columns(target, source, keys, update_cols) -> tuple[list[str], set[str]]:
    """The columns of the result and those that a matched row changes, or an error."""
    if set(target.columns) != set(source.columns):
        raise ValueError(
            f"columns differ: target {sorted(target.columns)}, source {sorted(source.columns)}"
        )
    columns = target.columns
    changed = set(columns) - set(keys) if update_cols is None else set(update_cols)
    unknown = changed - set(columns)
    if unknown:
        raise ValueError(f"unknown update columns: {sorted(unknown)}")
    return columns, changed


def ranks_before(order: Sequence[tuple[str, bool]]) -> Column:
    """Does the joined source row come before the target row, NULLs last?

    ``order`` names the columns and whether their highest values come first. Rows equal in
    all of them do not come before one another.
    """
    before = F.lit(False)
    for name, highest in reversed(order):
        ours, theirs = F.col(name), F.col(f"_s_{name}")
        first = theirs > ours if highest else theirs < ours
        before = (
            F.when(ours.eqNullSafe(theirs), before).when(theirs.isNull(), False).when(ours.isNull(), True).otherwise(first)
        )
    return before


def _is_update(newer_by: str | Sequence[tuple[str, bool]] | None) -> Column:
    """Does the joined source row replace the target row?"""
    update = F.col("_s_here").isNotNull()
    if newer_by and not isinstance(newer_by, str):
        update = update & ranks_before(newer_by)
    elif newer_by:
        ours, theirs = F.col(newer_by), F.col(f"_s_{newer_by}")
        update = update & (ours.isNull() | F.coalesce(theirs >= ours, F.lit(False)))
    return update


def upsert(
    target: DataFrame | None,
    source: DataFrame,
    key: str | Sequence[str],
    update_cols: Sequence[str] | None = None,
    newer_by: str | Sequence[tuple[str, bool]] | None = None,
    drop_null_keys: bool = False,
    check_unique: bool = True,
) -> DataFrame:
    """The target with the source merged in by key.

    A source row whose key is in the target replaces all columns, or only
    ``update_cols``; any other source row is inserted whole. ``newer_by`` names a column:
    a matched target row that is newer in it stays as it is. It can also be an order of
    columns, as for ``ranks_before``; then a target row stays unless the source row comes
    first, so any sequence of merges ends like one choice among all rows. Rows with a NULL key match
    nothing and are all kept unless ``drop_null_keys`` is set. Source keys must be unique.

    The uniqueness check partitions the source as the join needs it, so it costs no
    shuffle of its own.
    """
    keys = _names(key)
    if drop_null_keys:
        source = source.dropna(subset=keys)
    if target is None:
        if not check_unique:
            return source
        spread = spread_null_keys(source, keys, "_spread")
        return unique_or_fail(spread, keys, "_spread").drop("_spread")
    columns, changed = _checked_columns(target, source, keys, update_cols)

    new = spread_null_keys(source, keys, "_spread")
    if check_unique:
        new = unique_or_fail(new, keys, "_spread")
    new = new.select(*[F.col(c).alias(f"_s_{c}") for c in columns], F.col("_spread").alias("_s_spread"), F.lit(True).alias("_s_here"))
    old = spread_null_keys(target, keys, "_t_spread").withColumn("_t_here", F.lit(True))

    match = [F.col(k) == F.col(f"_s_{k}") for k in keys]
    joined = old.join(new, [*match, F.col("_t_spread") == F.col("_s_spread")], "full")
    joined = joined.withColumns({
        "_inserted": F.col("_t_here").isNull(), "_taken": F.col("_t_here").isNull() | _is_update(newer_by)})

    def merged(name: str) -> Column:
        take = F.col("_taken" if name in changed else "_inserted")
        return F.when(take, F.col(f"_s_{name}")).otherwise(F.col(name)).alias(name)

    return joined.select(*[merged(c) for c in columns])


def upsert_in_place(
    target: DataFrame,
    source: DataFrame,
    key: str | Sequence[str],
    update_cols: Sequence[str] | None = None,
    newer_by: str | Sequence[tuple[str, bool]] | None = None,
    drop_null_keys: bool = False,
    check_unique: bool = True,
) -> DataFrame:
    """``upsert`` as a left join and an append, for a target that should not be shuffled.

    The target is updated by a left join with the source; the source rows whose key the
    target lacks are appended. Spark's statistics decide how each join runs: a small source
    is broadcast and the target stays where it is, a large one is sorted and merged. The
    rows, the checks and the errors are those of ``upsert`` at every size.
    """
    keys = _names(key)
    if drop_null_keys:
        source = source.dropna(subset=keys)
    columns, changed = _checked_columns(target, source, keys, update_cols)
    if check_unique:
        source = unique_or_fail(spread_null_keys(source, keys, "_spread"), keys, "_spread").drop("_spread")
    new = source.select(*[F.col(c).alias(f"_s_{c}") for c in columns], F.lit(True).alias("_s_here"))
    joined = target.join(new, [F.col(k) == F.col(f"_s_{k}") for k in keys], "left")
    joined = joined.withColumn("_s_wins", _is_update(newer_by))
    updated = joined.select(*[
        F.when(F.col("_s_wins"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
        for c in columns
    ])
    # Of the target's keys only those of the source are left, once each.
    matched = target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()
    inserted = source.select(*columns).join(matched, keys, "left_anti")
    return updated.unionByName(inserted)


def merge_into_catalog(
    source: DataFrame, table: str, key: str, update_cols: Sequence[str] | None = None
) -> None:
    """The same merge by the table format's own MERGE, for catalogs that support it."""
    target = F.col(f"{table}.{key}") == F.col(f"source.{key}")
    writer = source.alias("source").mergeInto(table, target)
    if update_cols is None:
        writer = writer.whenMatched().updateAll()
    else:
        writer = writer.whenMatched().update({c: F.col(f"source.{c}") for c in update_cols})
    writer.whenNotMatched().insertAll().merge()
