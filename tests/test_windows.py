from datetime import datetime

from pyspark.sql import functions as F

from torquelake.functions.scalars import notification_text
from torquelake.operators.windows import alert_window_agg

SCHEMA = "event_time timestamp_ntz, color_name string, speed int, gear int, rpm int"


def at(minute, second=0, micro=0):
    return datetime(2024, 1, 1, 0, minute, second, micro)


def test_windows_are_half_open_and_ignore_missing_times(spark):
    rows = [
        (at(0), "Black", 10, 1, None),
        (at(0, 59, 999999), "Gray", 20, 2, None),
        (at(1), None, None, 3, 700),
        (None, "Black", 999, 9, 9999),
    ]
    got = {r.window_start: r for r in alert_window_agg(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sorted(got) == [at(0), at(1)]
    first, second = got[at(0)], got[at(1)]
    assert first.window_end == at(1)
    assert (first.num_of_rows, first.num_of_black, first.num_of_white, first.num_of_silver) == (2, 1, 0, 1)
    assert (first.maximum_speed, first.maximum_gear, first.maximum_rpm) == (20, 2, None)
    assert (second.num_of_rows, second.num_of_black, second.maximum_speed) == (1, 0, None)


def test_silver_counts_gray_only(spark):
    rows = [(at(0), "Silver", 1, 1, 1), (at(0), "Gray", 1, 1, 1)]
    assert alert_window_agg(spark.createDataFrame(rows, SCHEMA)).first().num_of_silver == 1


def test_crowded_window_is_combined_before_the_shuffle(spark, capsys):
    frame = spark.range(1000).select(
        F.lit(at(0)).alias("event_time"), F.lit("Red").alias("color_name"), *(F.lit(1).alias(c) for c in ("speed", "gear", "rpm"))
    )
    alert_window_agg(frame).explain()
    plan = capsys.readouterr().out
    assert plan.index("Exchange") < plan.index("partial_count")


def test_notification_text(spark):
    rows = [(at(0), "Black", None, 2, 6500)]
    message = alert_window_agg(spark.createDataFrame(rows, SCHEMA)).select(notification_text()).first()[0]
    assert message == (
        "🚗 *Alert Aggregation*\n\n⏰ 2024-01-01 00:00:00 → 2024-01-01 00:01:00\n\n📊 Total: `1`\n"
        "🎨 Black: `1` | White: `0` | Silver: `0`\n\n🏎️ Max Speed: `None` | Gear: `2` | RPM: `6500`"
    )
