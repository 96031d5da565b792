"""Checks of the dimension tables that the joins rely on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(dim: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once; each would multiply the events of that key."""
    return dim.groupBy(key).agg(F.count("*").alias("copies")).filter("copies > 1")


def rows_without_match(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Keys of ``facts`` unknown to ``dim`` with their rows; a missing key is unknown too.

    The facts are counted per key first. The join then sees each key once, however many
    rows it has.
    """
    counted = facts.groupBy(key).agg(F.count("*").alias("rows"))
    return counted.join(dim.select(key).distinct(), key, "left_anti")


def dim_integrity(events: DataFrame, cars: DataFrame, models: DataFrame, colors: DataFrame) -> DataFrame:
    """One line per check with the number of offending keys and rows."""

    def line(name: str, offenders: DataFrame, rows: str) -> DataFrame:
        return offenders.agg(
            F.lit(name).alias("check"),
            F.count("*").alias("offending_keys"),
            F.coalesce(F.sum(rows), F.lit(0)).alias("offending_rows"),
        ).select("check", "offending_keys", "offending_rows")

    lines = [
        line("duplicate car", duplicate_keys(cars, "car_id"), "copies"),
        line("duplicate model", duplicate_keys(models, "model_id"), "copies"),
        line("duplicate color", duplicate_keys(colors, "color_id"), "copies"),
        line("event without car", rows_without_match(events, cars, "car_id"), "rows"),
        line("car without model", rows_without_match(cars, models, "model_id"), "rows"),
        line("car without color", rows_without_match(cars, colors, "color_id"), "rows"),
    ]
    return reduce(DataFrame.unionByName, lines)
