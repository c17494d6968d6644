"""Deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tierflow.functions.times import timestamp_text


def surrogate_key(*parts: Column) -> Column:
    """Upper-case hexadecimal MD5 of the concatenated parts; NULL if any part is NULL."""
    return F.upper(F.md5(F.concat(*[part.cast("string") for part in parts])))


def entity_hour_key(entity: Column, ts: Column, digits: int) -> Column:
    """Key of an entity at a time. Silver keys print three fraction digits, fact keys six."""
    return surrogate_key(entity, timestamp_text(ts, digits))
