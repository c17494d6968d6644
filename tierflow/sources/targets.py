"""The list of pages to load, from a nested configuration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierflow.functions.text import slug_to_title
from tierflow.schemas import LOCATIONS


def locations_from_config(spark: SparkSession, locations: Sequence[Mapping]) -> DataFrame:
    """The nested relation of a loaded configuration: dicts of a province and its cities."""
    rows = [(entry["province"], list(entry["cities"] or ())) for entry in locations]
    return spark.createDataFrame(rows, LOCATIONS)


def target_list(locations: DataFrame, url_pattern: str) -> DataFrame:
    """One row per (province, city) of a ``province, cities array`` relation.

    ``url_pattern`` is a ``printf`` pattern taking the province and the city slug.
    """
    flat = locations.select("province", F.explode("cities").alias("city"))
    return flat.select(
        F.col("province").alias("province_slug"),
        F.col("city").alias("city_slug"),
        slug_to_title(F.col("province")).alias("province"),
        slug_to_title(F.col("city")).alias("city"),
        F.format_string(url_pattern, "province", "city").alias("url"),
    )
