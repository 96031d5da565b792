"""Questions asked of the flagged events."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def alerts_by_color(flagged: DataFrame) -> DataFrame:
    """Events and alerts per color; cars without a color form their own line."""
    return flagged.groupBy("color_name").agg(
        F.count("*").alias("num_of_rows"),
        F.count_if("is_alert").alias("num_of_alerts"),
        F.max("speed").alias("maximum_speed"),
        F.max("gear").alias("maximum_gear"),
        F.max("rpm").alias("maximum_rpm"),
    )


def events_on_day(events: DataFrame, day: date, day_column: str | None = None) -> DataFrame:
    """Events of one day. The time range is pushed to the scan; ``day_column`` prunes partitions."""
    found = events.filter(
        (F.col("event_time") >= F.lit(day.isoformat()).cast("timestamp_ntz"))
        & (F.col("event_time") < F.lit((day + timedelta(days=1)).isoformat()).cast("timestamp_ntz"))
    )
    return found if day_column is None else found.filter(F.col(day_column) == F.lit(day))


def alerts_on_day(flagged: DataFrame, day: date, day_column: str | None = None) -> DataFrame:
    return events_on_day(flagged, day, day_column).agg(F.count_if("is_alert").alias("num_of_alerts"))


def cars_over(flagged: DataFrame, color: str, speed: int) -> DataFrame:
    """Events of cars of a color above a speed, in the unit of the data."""
    return flagged.filter((F.col("color_name") == color) & (F.col("speed") > speed))


def count_rows(frame: DataFrame) -> DataFrame:
    return frame.agg(F.count("*").alias("num_of_rows"))
