from datetime import datetime

import pytest
from pyspark.sql import functions as F

from torquelake.functions.payload import corrupt_payloads, parse_payload, raw_capture, to_payload
from torquelake.schemas import SENSOR_SCHEMA

GOOD = '{"event_id":"a","event_time":"2024-01-01T00:00:00","car_id":7,"speed":45,"rpm":3000,"gear":2}'


def parsed(spark, value):
    frame = spark.createDataFrame([(value,)], "value string").select(F.col("value").cast("binary").alias("value"))
    row = parse_payload(frame, SENSOR_SCHEMA).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    return row.first().asDict()


def test_good_event(spark):
    assert parsed(spark, GOOD) == {
        "event_id": "a",
        "event_time": datetime(2024, 1, 1),
        "car_id": 7,
        "speed": 45,
        "rpm": 3000,
        "gear": 2,
    }


@pytest.mark.parametrize("speed", ['"x"', '"45"', "45.7", "9999999999"])
def test_bad_field_is_missing_and_the_rest_kept(spark, speed):
    row = parsed(spark, GOOD.replace('"speed":45', f'"speed":{speed}'))
    assert row["speed"] is None
    assert (row["event_id"], row["car_id"], row["rpm"]) == ("a", 7, 3000)


def test_bad_time_is_missing(spark):
    assert parsed(spark, GOOD.replace("2024-01-01T00:00:00", "garbage"))["event_time"] is None


def test_zone_of_the_event_counts(spark):
    row = parsed(spark, GOOD.replace("2024-01-01T00:00:00", "2024-01-01T02:00:00+02:00"))
    assert row["event_time"] == datetime(2024, 1, 1)


@pytest.mark.parametrize("value", ["not json", "", None, '[{"event_id":"a"},{"event_id":"b"}]', "{}"])
def test_unreadable_message_keeps_its_row(spark, value):
    assert set(parsed(spark, value).values()) == {None}


def test_payload_leaves_out_missing_and_cuts_to_millis(spark):
    frame = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 0, 0, 7, 179575), None)], "event_id string, event_time timestamp_ntz, speed int"
    ).withColumn("event_time", F.col("event_time").cast("timestamp"))
    assert to_payload(frame).first().value == '{"event_id":"a","event_time":"2024-01-01T00:00:07.179Z"}'


def test_corrupt_payloads_are_found(spark):
    values = [GOOD, "not json", GOOD.replace("45", '"x"'), None]
    frame = spark.createDataFrame([(v,) for v in values], "value string")
    found = {row.json_data for row in corrupt_payloads(frame, SENSOR_SCHEMA).collect()}
    assert found == {"not json", GOOD.replace("45", '"x"'), None}


def test_raw_capture_keeps_text_and_makes_ids(spark):
    frame = spark.createDataFrame([("x",), ("x",)], "value string")
    rows = raw_capture(frame).collect()
    assert [row.json_data for row in rows] == ["x", "x"]
    assert rows[0].id != rows[1].id
    assert rows[0].timestamp == rows[1].timestamp


def test_text_is_parsed_once_whatever_is_filtered(spark, capsys):
    frame = spark.range(3).selectExpr("string(id) AS value")
    parse_payload(frame, SENSOR_SCHEMA).filter("speed > 1 OR rpm > gear").select("event_id").explain()
    assert capsys.readouterr().out.count("from_json") == 1
