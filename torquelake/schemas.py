"""Declared schemas of streams and tables. Every field is nullable."""

from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

SENSOR_SCHEMA = (
    StructType()
    .add("event_id", StringType())
    .add("event_time", TimestampType())
    .add("car_id", LongType())
    .add("speed", IntegerType())
    .add("rpm", IntegerType())
    .add("gear", IntegerType())
)

ENRICHED_SCHEMA = (
    StructType()
    .add("event_id", StringType())
    .add("event_time", TimestampType())
    .add("car_id", LongType())
    .add("driver_id", LongType())
    .add("brand_name", StringType())
    .add("model_name", StringType())
    .add("color_name", StringType())
    .add("speed", IntegerType())
    .add("rpm", IntegerType())
    .add("gear", IntegerType())
    .add("expected_gear", IntegerType())
)

FLAGGED_SCHEMA = StructType([*ENRICHED_SCHEMA.fields, StructField("is_alert", BooleanType())])

RAW_SCHEMA = (
    StructType()
    .add("id", StringType())
    .add("json_data", StringType())
    .add("timestamp", TimestampType())
)

MODEL_SCHEMA = (
    StructType()
    .add("model_id", IntegerType())
    .add("car_brand", StringType())
    .add("car_model", StringType())
)

COLOR_SCHEMA = StructType().add("color_id", IntegerType()).add("color_name", StringType())

CAR_SCHEMA = (
    StructType()
    .add("car_id", LongType())
    .add("driver_id", LongType())
    .add("model_id", IntegerType())
    .add("color_id", IntegerType())
)

SUMMARY_SCHEMA = (
    StructType()
    .add("window_start", TimestampType())
    .add("window_end", TimestampType())
    .add("num_of_rows", LongType())
    .add("num_of_black", LongType())
    .add("num_of_white", LongType())
    .add("num_of_silver", LongType())
    .add("maximum_speed", IntegerType())
    .add("maximum_gear", IntegerType())
    .add("maximum_rpm", IntegerType())
)

NOTIFICATION_SCHEMA = (
    StructType()
    .add("window_start", TimestampType())
    .add("window_end", TimestampType())
    .add("message", StringType())
)
