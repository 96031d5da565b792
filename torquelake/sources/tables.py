"""Tables: definition, batch writes, streaming writes, and reads by day.

On Parquet a day-partitioned table has two partition columns, the load and the day. A load
is one micro-batch or one batch write; writing it again replaces it, so a repeated
micro-batch leaves no duplicates. On Iceberg the format does both itself.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from torquelake import config
from torquelake.config import Settings, session_options
from torquelake.operators.heavy import KEY, ROWS, TOTAL, key_summary
from torquelake.schemas import (
    CAR_SCHEMA,
    COLOR_SCHEMA,
    FLAGGED_SCHEMA,
    MODEL_SCHEMA,
    NOTIFICATION_SCHEMA,
    RAW_SCHEMA,
    SUMMARY_SCHEMA,
)

LOAD = "load"
SUMMARY_COLUMNS = StructType([StructField(KEY, StringType()), StructField(ROWS, LongType()), StructField(TOTAL, LongType())])
BATCH_DIGITS = 12


@dataclass(frozen=True)
class Table:
    """A table: its columns and, if it is partitioned by day, the time column behind the day."""

    schema: str
    name: str
    columns: StructType
    time_column: str | None = None
    day_column: str | None = None

    def full_name(self, settings: Settings) -> str:
        name = f"{self.schema}.{self.name}"
        return f"{settings.catalog}.{name}" if settings.table_format == "iceberg" else name

    def location(self, settings: Settings) -> str:
        return settings.table_location(self.schema, self.name)

    def stored_columns(self, settings: Settings) -> StructType:
        if self.day_column is None or settings.table_format == "iceberg":
            return self.columns
        partitions = [StructField(LOAD, StringType()), StructField(self.day_column, DateType())]
        return StructType([*self.columns.fields, *partitions])


MODELS = Table(config.SCHEMA_DIMS, config.TABLE_MODELS, MODEL_SCHEMA)
COLORS = Table(config.SCHEMA_DIMS, config.TABLE_COLORS, COLOR_SCHEMA)
CARS = Table(config.SCHEMA_DIMS, config.TABLE_CARS, CAR_SCHEMA)
ENRICHED = Table(config.SCHEMA_DIMS, config.TABLE_ENRICHED, FLAGGED_SCHEMA, "event_time", "event_day")
RAW = Table(config.SCHEMA_RAW, config.TABLE_RAW, RAW_SCHEMA, "timestamp", "ingest_day")
UNREADABLE = Table(config.SCHEMA_RAW, config.TABLE_UNREADABLE, RAW_SCHEMA, "timestamp", "ingest_day")
SUMMARY = Table(config.SCHEMA_DIMS, config.TABLE_SUMMARY, SUMMARY_SCHEMA, "window_start", "window_day")
NOTIFICATIONS = Table(
    config.SCHEMA_DIMS, config.TABLE_NOTIFICATIONS, NOTIFICATION_SCHEMA, "window_start", "window_day"
)
ALL_TABLES = (MODELS, COLORS, CARS, ENRICHED, RAW, UNREADABLE, SUMMARY, NOTIFICATIONS)


def create_schema(spark: SparkSession, schema: str, settings: Settings) -> None:
    name = f"{settings.catalog}.{schema}" if settings.table_format == "iceberg" else schema
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{settings.schema_location(schema)}'")


def create_table_sql(table: Table, settings: Settings) -> str:
    """The statement that makes a table at its location if it is absent."""
    parts = [
        f"CREATE TABLE IF NOT EXISTS {table.full_name(settings)} ({table.stored_columns(settings).toDDL()})",
        f"USING {settings.table_format}",
    ]
    if settings.table_format == "iceberg":
        if table.time_column:
            parts.append(f"PARTITIONED BY (days({table.time_column}))")
        properties = "'format-version' = '2', 'write.parquet.compression-codec' = 'snappy'"
    else:
        if table.day_column:
            parts.append(f"PARTITIONED BY ({LOAD}, {table.day_column})")
        properties = "'parquet.compression' = 'snappy'"
    parts += [f"LOCATION '{table.location(settings)}'", f"TBLPROPERTIES ({properties})"]
    return "\n".join(parts)


def create_table(spark: SparkSession, table: Table, settings: Settings) -> None:
    spark.sql(create_table_sql(table, settings))


def reload_table(frame: DataFrame, table: Table, settings: Settings) -> None:
    """Replace the rows of a dimension in one step; a small one becomes a single file."""
    rows = frame.select(*(F.col(f.name).cast(f.dataType) for f in table.columns)).hint("rebalance")
    rows.write.insertInto(table.full_name(settings), overwrite=True)


def append_table(frame: DataFrame, table: Table, settings: Settings) -> None:
    """Add the rows of a batch to an unpartitioned table."""
    rows = frame.select(*(F.col(f.name).cast(f.dataType) for f in table.columns)).hint("rebalance")
    rows.write.insertInto(table.full_name(settings))


def with_day(frame: DataFrame, table: Table) -> DataFrame:
    return frame.select(*table.columns.fieldNames(), F.to_date(table.time_column).alias(table.day_column))


def load_location(table: Table, settings: Settings, load: str) -> str:
    return f"{table.location(settings)}/{LOAD}={load}"


def write_load(frame: DataFrame, table: Table, settings: Settings, load: str) -> None:
    """Write one load of a day-partitioned Parquet table, replacing an earlier try of it.

    Rows are gathered per day into files of moderate size; a crowded day is split further
    by adaptive execution, so no task receives a whole day. A micro-batch with state comes
    with adaptive execution off; its rows are computed by then, so the write turns it on.
    The load is fixed in the statement, so the catalog is asked for the partitions of this
    load only.
    """
    with session_options(frame.sparkSession, {"spark.sql.adaptive.enabled": "true"}):
        _write_load(frame, table, settings, load)


def _write_load(frame: DataFrame, table: Table, settings: Settings, load: str) -> None:
    if settings.table_format == "iceberg":  # its own partitions, snapshots instead of loads
        frame.select(*table.columns.fieldNames()).writeTo(table.full_name(settings)).append()
        return
    rows = with_day(frame, table).hint("rebalance", table.day_column)
    if not settings.catalogued:
        location = load_location(table, settings, load)
        rows.write.mode("overwrite").partitionBy(table.day_column).parquet(location)
        return
    view = f"load_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    try:
        rows.sparkSession.sql(
            f"INSERT OVERWRITE TABLE {table.full_name(settings)} "
            f"PARTITION ({LOAD} = '{load}', {table.day_column}) SELECT * FROM {view}"
        )
    finally:
        rows.sparkSession.catalog.dropTempView(view)


def load_name(query_id: str, batch_id: int) -> str:
    """Name of a micro-batch that stays the same when the micro-batch is repeated."""
    return f"{query_id}-{batch_id:0{BATCH_DIGITS}d}"


def table_sink(frame: DataFrame, table: Table, settings: Settings, query: str, summed_key: str | None = None) -> DataStreamWriter:
    """Writer that appends a stream to a day-partitioned table, each row once.

    With ``summed_key`` a summary of the frequent values of that column is kept with every load.
    """
    writer = (
        frame.writeStream.queryName(query)
        .outputMode("append")
        .option("checkpointLocation", settings.checkpoint_location(query))
    )
    if settings.table_format == "iceberg":
        return writer.format("iceberg").option("fanout-enabled", "true")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load = load_name(query_id, batch_id)
        write_load(batch, table, settings, load)
        if summed_key:
            write_summary(batch.sparkSession, table, settings, load, summed_key)

    return writer.foreachBatch(write_batch)


def start_table_sink(writer: DataStreamWriter, table: Table, settings: Settings):
    if settings.table_format == "iceberg":
        return writer.toTable(table.full_name(settings))
    return writer.start()


def exists(spark: SparkSession, location: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def table_exists(spark: SparkSession, table: Table, settings: Settings) -> bool:
    if settings.catalogued or settings.table_format == "iceberg":
        return spark.catalog.tableExists(table.full_name(settings))
    return exists(spark, table.location(settings))


def summary_location(table: Table, settings: Settings, key: str) -> str:
    return f"{settings.root.rstrip('/')}/summaries/{table.schema}/{table.name}/{key}"


def write_summary(spark: SparkSession, table: Table, settings: Settings, load: str, key: str) -> None:
    """The frequent keys of a load beside the table, from the one column of what was written; a repeated load replaces its own."""
    if settings.catalogued:
        rows = spark.table(table.full_name(settings)).filter(F.col(LOAD) == load)
    else:
        rows = spark.read.schema(table.stored_columns(settings)).parquet(load_location(table, settings, load))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    summary = key_summary(rows.select(key), key, settings.hot_share_of(partitions))
    summary.coalesce(1).write.mode("overwrite").parquet(f"{summary_location(table, settings, key)}/{LOAD}={load}")


def read_summaries(spark: SparkSession, table: Table, settings: Settings, key: str) -> DataFrame | None:
    """The summaries of all loads, None if no load has one."""
    location = summary_location(table, settings, key)
    return spark.read.schema(SUMMARY_COLUMNS).parquet(location) if exists(spark, location) else None


def read_table(
    spark: SparkSession, table: Table, settings: Settings, first: date | None = None, last: date | None = None
) -> DataFrame:
    """The columns of a table, for a range of days if given.

    The range is put on the day column too, which prunes partitions of a Parquet table.
    Iceberg derives that from the time range.
    """
    by_day = table.day_column is not None and settings.table_format != "iceberg"
    if settings.catalogued:
        rows = spark.table(table.full_name(settings))
    else:
        stored = table.stored_columns(settings)
        rows = spark.read.schema(stored).parquet(table.location(settings))
    if first is not None:
        rows = rows.filter(F.col(table.time_column) >= F.lit(first).cast("timestamp"))
        rows = rows.filter(F.col(table.day_column) >= F.lit(first)) if by_day else rows
    if last is not None:
        rows = rows.filter(F.col(table.time_column) < F.lit(last + timedelta(days=1)).cast("timestamp"))
        rows = rows.filter(F.col(table.day_column) <= F.lit(last)) if by_day else rows
    return rows.select(*table.columns.fieldNames())
