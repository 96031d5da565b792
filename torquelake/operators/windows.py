"""Alert summaries per time window, the same for a table and for a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cars_of(color: str) -> Column:
    return F.count_if(F.col("color_name") == color)


def alert_window_agg(
    alerts: DataFrame, width: str = "1 minute", delay: str = "10 seconds", **more: Column
) -> DataFrame:
    """Counts and maxima per tumbling window ``[window_start, window_end)``.

    All aggregates combine before the shuffle, so a crowded window costs one row per task.
    On a stream, ``delay`` bounds how late an event may be; a batch needs no bound. ``more`` are
    further aggregates by name.
    """
    if alerts.isStreaming:
        alerts = alerts.withWatermark("event_time", delay)
    return (
        alerts.groupBy(F.window("event_time", width))
        .agg(
            F.count("*").alias("num_of_rows"),
            _cars_of("Black").alias("num_of_black"),
            _cars_of("White").alias("num_of_white"),
            # The gray cars: users know this column as silver, and there is no color of that name.
            _cars_of("Gray").alias("num_of_silver"),
            F.max("speed").alias("maximum_speed"),
            F.max("gear").alias("maximum_gear"),
            F.max("rpm").alias("maximum_rpm"),
            *(column.alias(name) for name, column in more.items()),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "num_of_rows",
            "num_of_black",
            "num_of_white",
            "num_of_silver",
            "maximum_speed",
            "maximum_gear",
            "maximum_rpm",
            *more,
        )
    )
