from pyspark.sql import functions as F

from torquelake.config import AlertRules
from torquelake.functions.scalars import expected_gear
from torquelake.operators.alerts import alert_reasons, flag_alerts, only_alerts

SCHEMA = "name string, speed int, rpm int, gear int, expected_gear int"


def test_expected_gear_rounds_halves_up(spark):
    speeds = [(0, 0), (14, 0), (15, 1), (44, 1), (45, 2), (74, 2), (75, 3), (105, 4), (160, 5), (None, None)]
    frame = spark.createDataFrame(speeds, "speed int, want int")
    rows = frame.withColumn("got", expected_gear(F.col("speed"), 30)).collect()
    assert [row.got for row in rows] == [row.want for row in rows]


def flags(spark, rows, rules=AlertRules()):
    return {r.name: r.is_alert for r in flag_alerts(spark.createDataFrame(rows, SCHEMA), rules).collect()}


def test_alert_truth_table(spark):
    rows = [
        ("quiet", 60, 3000, 2, 2),
        ("speed at bound", 120, 3000, 4, 4),
        ("speeding", 121, 3000, 4, 4),
        ("rpm at bound", 60, 6000, 2, 2),
        ("high rpm", 60, 6001, 2, 2),
        ("wrong gear", 60, 3000, 3, 2),
        ("no speed, high rpm", None, 6001, 3, None),
        ("no speed, low rpm", None, 3000, 3, None),
        ("no gear", 60, 3000, None, 2),
        ("nothing", None, None, None, None),
    ]
    assert flags(spark, rows) == {
        "quiet": False,
        "speed at bound": False,
        "speeding": True,
        "rpm at bound": False,
        "high rpm": True,
        "wrong gear": True,
        "no speed, high rpm": True,
        "no speed, low rpm": False,
        "no gear": False,
        "nothing": False,
    }


def test_thresholds_are_settings(spark):
    assert flags(spark, [("slow zone", 60, 3000, 2, 2)], AlertRules(max_speed=50)) == {"slow zone": True}


def test_reasons_name_the_rules(spark):
    rows = [("all", 130, 7000, 1, 4), ("gear", 60, 3000, 1, 2), ("none", None, None, None, None)]
    frame = alert_reasons(flag_alerts(spark.createDataFrame(rows, SCHEMA), AlertRules()), AlertRules())
    assert {r.name: r.reasons for r in frame.collect()} == {
        "all": "speeding,wrong_gear,high_rpm",
        "gear": "wrong_gear",
        "none": "",
    }


def test_only_alerts_drops_the_flag(spark):
    rows = [("fast", 130, 3000, 4, 4), ("quiet", 60, 3000, 2, 2)]
    found = only_alerts(flag_alerts(spark.createDataFrame(rows, SCHEMA), AlertRules()))
    assert "is_alert" not in found.columns
    assert [row.name for row in found.collect()] == ["fast"]
