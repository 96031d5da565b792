"""Column expressions used in more than one place."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text of a notification, one placeholder per value of a closed window.
NOTIFICATION = (
    "🚗 *Alert Aggregation*\n\n"
    "⏰ %s → %s\n\n"
    "📊 Total: `%s`\n"
    "🎨 Black: `%s` | White: `%s` | Silver: `%s`\n\n"
    "🏎️ Max Speed: `%s` | Gear: `%s` | RPM: `%s`"
)
NOTIFICATION_VALUES = (
    "window_start",
    "window_end",
    "num_of_rows",
    "num_of_black",
    "num_of_white",
    "num_of_silver",
    "maximum_speed",
    "maximum_gear",
    "maximum_rpm",
)
# How a missing value is shown, and the separator between shown cells.
MISSING = "None"
CELL_SEPARATOR = " | "


def expected_gear(speed: Column, speed_per_gear: int) -> Column:
    """Nearest gear for a speed; halves go up."""
    return F.round(speed / F.lit(speed_per_gear)).cast("int")


def shown(value: Column, width: int | None = None) -> Column:
    """A value as text, optionally cut to a width."""
    text = F.coalesce(value.cast("string"), F.lit(MISSING))
    return text if width is None else F.substring(text, 1, width)


def joined_cells(*columns: str, width: int | None = None) -> Column:
    return F.concat_ws(CELL_SEPARATOR, *(shown(F.col(c), width) for c in columns))


def grouped_number(number: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(number, 0)


def notification_text() -> Column:
    return F.format_string(NOTIFICATION, *(shown(F.col(c)) for c in NOTIFICATION_VALUES))


def cutoff(as_of: datetime | Column, days: int) -> Column:
    """The instant ``days`` days before ``as_of``."""
    instant = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return instant - F.make_dt_interval(F.lit(days))
