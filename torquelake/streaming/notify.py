"""Notifications: the text of a closed window as a column, kept in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from torquelake.functions.scalars import notification_text


def notification_rows(windows: DataFrame) -> DataFrame:
    return windows.select("window_start", "window_end", notification_text().alias("message"))
