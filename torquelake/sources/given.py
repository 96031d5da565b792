"""Sensor events, cars and file listings derived from the given star-schema tables."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from torquelake.config import Settings
from torquelake.operators.dimension import Dimension
from torquelake.operators.enrich import car_dimension
from torquelake.sources.dims import color_dimension, model_dimension


#: Added to the key of a user that stands for an unknown car.
UNKNOWN_CARS = 1_000_000_000_000


@lru_cache(maxsize=256)
def _stored_schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def given_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the files once per session, like from a catalog."""
    path = f"{folder}/{name}.parquet"
    return spark.read.schema(_stored_schema(spark, path)).parquet(path)


def given_cars(spark: SparkSession, folder: str) -> DataFrame:
    """A car for every customer."""
    key = F.col("c_custkey")
    return given_table(spark, folder, "customer").select(
        key.alias("car_id"),
        (key + 100000000).alias("driver_id"),
        (key % 7 + 1).cast("int").alias("model_id"),
        (F.floor(key / 7) % 7 + 1).cast("int").alias("color_id"),
    )


def given_sensors(spark: SparkSession, folder: str) -> DataFrame:
    """Sensor events from the event table, with some missing speeds and rpms.

    Every tenth user's key is shifted out of the range of the cars, so some events have no car.
    """
    key, user = F.col("event_id"), F.col("user_id")
    return given_table(spark, folder, "events").select(
        key.cast("string").alias("event_id"),
        F.col("ts").alias("event_time"),
        F.when(user % 10 == 0, user + UNKNOWN_CARS).otherwise(user).alias("car_id"),
        F.when(key % 53 != 0, (key * 37 % 161).cast("int")).alias("speed"),
        F.when(key % 59 != 0, (key * 7919 % 8001).cast("int")).alias("rpm"),
        (F.get_json_object("props", "$.k").cast("int") % 7 + 1).alias("gear"),
    )


@lru_cache(maxsize=64)
def given_dimension(spark: SparkSession, folder: str, settings: Settings) -> Dimension:
    """The car profile, measured once per session: the given tables do not change."""
    return car_dimension(given_cars(spark, folder), model_dimension(spark), color_dimension(spark), settings)


def given_files(spark: SparkSession, folder: str) -> DataFrame:
    """A listing of data files, one per order, in partitions by order day."""
    modulus = 200000000
    key = F.col("o_orderkey") % modulus  # keeps the products below within a long
    return given_table(spark, folder, "orders").select(
        F.col("o_orderdate").cast("date").alias("partition"),
        F.col("o_orderkey").cast("string").alias("path"),
        (key * 7919 % modulus * 7919 % modulus).alias("bytes"),
        F.col("o_orderdate").alias("modified_at"),
    )


def given_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Table snapshots: the customer stands for the table, the order for the snapshot."""
    return given_table(spark, folder, "orders").select(
        F.col("o_custkey").alias("table_id"),
        F.col("o_orderkey").alias("snapshot_id"),
        F.col("o_orderdate").alias("committed_at"),
    )


def given_referenced(spark: SparkSession, folder: str) -> DataFrame:
    """Paths still in use: orders whose key is the key of an event."""
    return given_table(spark, folder, "events").select(F.col("event_id").cast("string").alias("path"))
