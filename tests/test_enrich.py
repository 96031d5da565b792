from dataclasses import replace
from datetime import date

import pytest
from conftest import MEDIUM, SMALL
from pyspark.sql import functions as F

from torquelake.config import Settings
from torquelake.operators import reports
from torquelake.operators.alerts import flag_alerts
from torquelake.operators.dimension import measured
from torquelake.operators.enrich import car_dimension, enrich, enrich_events
from torquelake.queries import REGISTERED, enriched, flagged
from torquelake.schemas import CAR_SCHEMA, ENRICHED_SCHEMA, SENSOR_SCHEMA
from torquelake.sources.dims import color_dimension, model_dimension

CARS = [(1, 100, 3, 3), (2, 200, 99, 1), (3, 300, 6, None)]
EVENTS = [("a", None, 1, 75, 10, 3), ("b", None, 2, 10, 10, 0), ("c", None, 3, 10, 10, 0), ("d", None, 4, 10, 10, 0),
          ("e", None, None, 10, 10, 0)]


@pytest.mark.parametrize("settings", [Settings(), replace(Settings(), broadcast_rows=0)])
def test_unknown_cars_models_and_colors_keep_the_event(spark, settings):
    cars = spark.createDataFrame(CARS, CAR_SCHEMA)
    profile = car_dimension(cars, model_dimension(spark), color_dimension(spark), settings)
    result = enrich(spark.createDataFrame(EVENTS, SENSOR_SCHEMA), profile, settings)
    assert result.columns == ENRICHED_SCHEMA.fieldNames()
    got = {r.event_id: (r.driver_id, r.brand_name, r.model_name, r.color_name, r.expected_gear) for r in result.collect()}
    assert got == {
        "a": (100, "Toyota", "Corolla", "Gray", 3),
        "b": (200, None, None, "Black", 0),
        "c": (300, "Kia", "Rio", None, 0),
        "d": (None, None, None, None, 0),
        "e": (None, None, None, None, 0),
    }


def test_schema_types(spark):
    types = {f.name: f.dataType for f in enriched(spark, MEDIUM).schema}
    expected = {f.name: f.dataType for f in ENRICHED_SCHEMA if f.name != "event_time"}
    assert {name: types[name] for name in expected} == expected


def test_known_answers(spark):
    rows = flagged(spark, MEDIUM)
    counts = rows.agg(
        F.count("*"), F.count("driver_id"), F.count_if("is_alert"), F.sum("expected_gear"), F.countDistinct("color_name")
    ).first()
    assert tuple(counts) == (10000, 9016, 9135, 26204, 7)


def test_alert_rule_runs_before_the_join(spark, capsys):
    flagged(spark, MEDIUM).filter("is_alert").explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == plan.count("BroadcastExchange")
    assert plan.index("BroadcastHashJoin") < plan.index("Filter coalesce(")


def test_day_filter_reaches_the_scan(spark, capsys):
    reports.alerts_on_day(flagged(spark, MEDIUM), date(2024, 1, 15)).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in plan
    assert "LessThan(ts,2024-01-16T00:00)" in plan


def test_unused_columns_are_not_read(spark, capsys):
    flag_alerts(enriched(spark, MEDIUM), Settings().rules).select("event_id", "speed").explain("formatted")
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in capsys.readouterr().out


@pytest.mark.parametrize("extra", [[], [(3, "again"), (None, "x"), (None, "y")], [(None, "x"), (None, "y")]])
def test_no_join_without_attributes_if_keys_are_unique(spark, capsys, extra):
    """Rows are those of the full join; it is only left out where that is proven."""
    columns = "car_id long, driver_id long, brand_name string, model_name string, color_name string"
    cars = [(k, k, "b", "m", "c") for k in range(5)] + [(k, 0, "b", "m", name) for k, name in extra]
    profile = measured(spark.createDataFrame(cars, columns), "car_id")
    assert profile.unique == (not any(k is not None for k, _ in extra))
    events = spark.range(40).selectExpr(
        "string(id) event_id", "timestamp_ntz'2024-01-01' event_time", "if(id % 9 = 0, NULL, id % 7) car_id",
        "int(id) speed", "1 rpm", "2 gear")
    for settings in (Settings(), Settings(broadcast_rows=0)):
        alone = enrich_events(events, profile, settings)
        full = enrich(events, profile, settings).select(*alone.columns)
        assert sorted(map(str, alone.collect())) == sorted(map(str, full.collect()))
        alone.explain()
        assert ("Join" in capsys.readouterr().out) != profile.unique


def test_questions_without_attributes_are_not_joined(spark, capsys):
    for name in ("count_rows", "alerts_on_day", "sql_topk_rpm", "sql_top_speed_per_car", "expected_gear", "alert_reasons"):
        REGISTERED[name](spark, SMALL).explain("simple")
        plan = capsys.readouterr().out
        assert "Join" not in plan
        if name == "count_rows":
            assert "ReadSchema: struct<>" in plan  # row counts of the files only
