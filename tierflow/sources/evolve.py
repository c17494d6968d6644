"""Tables whose columns change their type over time."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tierflow.sources.tables import _filesystem, append, drop_table

_WIDTHS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
#: Above it, a double no longer holds every whole number.
EXACT = 2**53


def promoted(one: T.DataType, other: T.DataType) -> T.DataType:
    """The type that holds the values of both, or an error.

    Whole numbers widen, they and floats become doubles, dates become times, and a column
    that was always empty takes any type. Everything else, text among it, keeps its type.
    """
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    kinds = {type(one), type(other)}
    if kinds <= set(_WIDTHS):
        return max((one, other), key=lambda t: _WIDTHS.index(type(t)))
    if kinds <= {*_WIDTHS, T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    raise ValueError(f"no safe promotion of {one.simpleString()} and {other.simpleString()}")


def promoted_schema(*schemas: T.StructType) -> T.StructType:
    """Union of the schemas by name, each column in the type that holds all of its types."""
    fields: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema:
            try:
                fields[field.name] = promoted(fields.get(field.name, field.dataType), field.dataType)
            except ValueError as problem:
                raise ValueError(f"column {field.name}: {problem}") from None
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _read_as(name: str, kind: T.DataType, wanted: T.DataType) -> Column:
    if isinstance(kind, T.LongType) and isinstance(wanted, T.DoubleType):
        # A whole number that a double would change stops the read.
        inexact = F.raise_error(F.concat(F.lit(f"column {name}: no double is "), F.col(name).cast("string")))
        return F.when(F.abs(F.col(name)) > EXACT, inexact.cast("double")).otherwise(F.col(name).cast("double"))
    return F.col(name).cast(wanted)


def shapes(spark: SparkSession, path: str) -> dict[str, T.StructType]:
    """Folder and schema of each group of files, as one file's footer has it."""
    fs, root = _filesystem(spark, path)
    if not fs.exists(root):
        return {}
    names = sorted(s.getPath().getName() for s in fs.listStatus(root))
    folders = [f"{path.rstrip('/')}/{n}" for n in names if n.startswith("shape=")]
    return {folder: spark.read.parquet(folder).schema for folder in folders}


def append_typed(df: DataFrame, path: str, on_conflict: str = "fail") -> int:
    """Append rows whose columns may have other types than those of earlier rows.

    Files are grouped by the schema that they are written with, so every group is read in its
    own types. A change without a safe promotion fails before any row is written, or, with
    ``on_conflict="recreate"``, drops the table and starts it anew. Returns the rows added.
    """
    if on_conflict not in ("fail", "recreate"):
        raise ValueError("on_conflict must be 'fail' or 'recreate'")
    try:
        promoted_schema(*shapes(df.sparkSession, path).values(), df.schema)
    except ValueError:
        if on_conflict == "fail":
            raise
        drop_table(df.sparkSession, path)
    kinds = ",".join(f"{f.name} {f.dataType.simpleString()}" for f in sorted(df.schema, key=lambda f: f.name))
    return append(df, f"{path.rstrip('/')}/shape={hashlib.md5(kinds.encode()).hexdigest()}")


def scan_typed(spark: SparkSession, path: str) -> DataFrame:
    """All rows in the types that hold them; columns that older files lack read NULL."""
    found = shapes(spark, path)
    schema = promoted_schema(*found.values())
    result = None
    for folder, own in found.items():
        part = spark.read.schema(own).parquet(folder)
        part = part.select(*[
            (_read_as(f.name, own[f.name].dataType, f.dataType) if f.name in own.names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema])
        result = part if result is None else result.unionAll(part)
    if result is None:
        raise ValueError(f"no table at {path}")
    return result
