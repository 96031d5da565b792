"""The three streaming jobs: enrich, flag, summarise. Each reads a topic and feeds the next.

The transformations are those of the batch operators. A job with two sinks starts two
queries; each reads the topic itself and has its own progress, so the two outputs are not
atomic together.
"""

from __future__ import annotations

from contextlib import nullcontext
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from torquelake import config
from torquelake.config import Settings, session_options
from torquelake.functions.payload import corrupt_payloads, parse_payload, raw_capture, to_payload
from torquelake.operators.alerts import flag_alerts, only_alerts
from torquelake.operators.dimension import Dimension, measured
from torquelake.operators.enrich import car_dimension, enrich
from torquelake.operators.heavy import merged_hot_keys
from torquelake.operators.joins import hot_keys
from torquelake.operators.windows import alert_window_agg
from torquelake.schemas import ENRICHED_SCHEMA, SENSOR_SCHEMA
from torquelake.sources.tables import (
    CARS,
    COLORS,
    ENRICHED,
    MODELS,
    NOTIFICATIONS,
    RAW,
    SUMMARY,
    UNREADABLE,
    create_table,
    load_name,
    read_summaries,
    read_table,
    start_table_sink,
    table_exists,
    table_sink,
    write_load,
)
from torquelake.sources.topics import ensure_topic, topic_batch, topic_exists, topic_sink, topic_source, write_topic_batch
from torquelake.streaming.backfill import backfill_alerts, backfilled_until
from torquelake.streaming.notify import notification_rows

# Names of the queries; also the names of their checkpoint folders.
ENRICH_TOPIC = "enrich-topic"
RAW_TABLE = "raw-table"
UNREADABLE_TABLE = "unreadable-table"
FLAG_TABLE = "flag-table"
ALERT_TOPIC = "alert-topic"
ALERT_SUMMARY = "alert-summary"
ALERT_NOTIFICATIONS = "alert-notifications"
ALERT_OUTPUTS = "alert-outputs"
QUERY_NAMES = (
    ENRICH_TOPIC,
    RAW_TABLE,
    UNREADABLE_TABLE,
    FLAG_TABLE,
    ALERT_TOPIC,
    ALERT_SUMMARY,
    ALERT_NOTIFICATIONS,
    ALERT_OUTPUTS,
)


def _paced(writer: DataStreamWriter, once: bool, every: str | None = None) -> DataStreamWriter:
    """``once`` handles what is there and ends; else a fixed pace, or as fast as possible."""
    if once:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer


def load_dimension(spark: SparkSession, settings: Settings) -> Dimension:
    """The car profile from its tables."""
    cars, models, colors = (read_table(spark, table, settings) for table in (CARS, MODELS, COLORS))
    return car_dimension(cars, measured(models, "model_id"), measured(colors, "color_id"), settings)


def known_hot_cars(spark: SparkSession, settings: Settings) -> tuple | None:
    """Cars with many events, from the first micro-batch on.

    The summaries that the fact table's loads keep are merged, without reading the facts. A table
    from before there were any is looked through once. With no facts yet, the messages that wait in the
    sensor topic are, as the first micro-batch will read them. None if there is nothing of all that.
    """
    share = settings.hot_share_of(int(spark.conf.get("spark.sql.shuffle.partitions")))
    summaries = read_summaries(spark, ENRICHED, settings, "car_id")
    if summaries is not None:
        return tuple(map(int, merged_hot_keys(summaries, share)))
    if table_exists(spark, ENRICHED, settings):
        return hot_keys(read_table(spark, ENRICHED, settings), "car_id", share)
    if topic_exists(spark, config.TOPIC_SENSORS, settings):
        return hot_keys(parse_payload(topic_batch(spark, config.TOPIC_SENSORS, settings), SENSOR_SCHEMA), "car_id", share)
    return None


def _kept_profile(spark: SparkSession, settings: Settings) -> Dimension:
    """The profile as it is now, written next to the checkpoint.

    The stream then neither notices a reload of the dimension tables nor depends on what
    executors hold in memory.
    """
    profile = load_dimension(spark, settings)
    location = settings.checkpoint_location(f"{ENRICH_TOPIC}-profile")
    profile.frame.write.mode("overwrite").parquet(location)
    if not profile.fits_broadcast(settings):
        profile = profile.with_hot_keys(known_hot_cars(spark, settings))
    return replace(profile, frame=spark.read.schema(profile.frame.schema).parquet(location))


def enriched_stream(messages: DataFrame, profile: Dimension, settings: Settings) -> DataFrame:
    return enrich(parse_payload(messages, SENSOR_SCHEMA), profile, settings)


def flagged_stream(messages: DataFrame, settings: Settings) -> DataFrame:
    return flag_alerts(parse_payload(messages, ENRICHED_SCHEMA), settings.rules)


def summary_stream(messages: DataFrame, settings: Settings, since: Column | None = None) -> DataFrame:
    alerts = parse_payload(messages, ENRICHED_SCHEMA)
    if since is not None:
        alerts = alerts.filter(F.col("event_time") >= since)
    return alert_window_agg(alerts, settings.window, settings.watermark)


def _make_table(spark: SparkSession, table, settings: Settings) -> None:
    if settings.catalogued or settings.table_format == "iceberg":
        create_table(spark, table, settings)


def start_enrich_topic(
    spark: SparkSession, settings: Settings, profile: Dimension | None = None, once: bool = False
) -> StreamingQuery:
    """Sensor topic to enriched topic. The dimensions are loaded once, at the start."""
    ensure_topic(spark, config.TOPIC_SENSORS, settings)
    profile = profile or _kept_profile(spark, settings)
    messages = topic_source(spark, config.TOPIC_SENSORS, settings)
    payload = to_payload(enriched_stream(messages, profile, settings))
    return _paced(topic_sink(payload, config.TOPIC_ENRICHED, settings, ENRICH_TOPIC), once).start()


def start_enrich_topic_fresh(spark: SparkSession, settings: Settings, once: bool = False) -> StreamingQuery:
    """As ``start_enrich_topic``, with the dimensions read anew for every micro-batch.

    The batches are written one by one, each as a part of the topic that is there completely or not at
    all. One that is repeated after a failure is sent once on a file topic; Kafka may get it twice.
    """
    ensure_topic(spark, config.TOPIC_SENSORS, settings)
    ensure_topic(spark, config.TOPIC_ENRICHED, settings)

    def send(batch: DataFrame, batch_id: int) -> None:
        profile = load_dimension(batch.sparkSession, settings)
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        payload = to_payload(enriched_stream(batch, profile, settings))
        write_topic_batch(payload, config.TOPIC_ENRICHED, settings, load_name(query_id, batch_id))

    writer = (
        topic_source(spark, config.TOPIC_SENSORS, settings)
        .writeStream.queryName(ENRICH_TOPIC)
        .option("checkpointLocation", settings.checkpoint_location(ENRICH_TOPIC))
        .foreachBatch(send)
    )
    return _paced(writer, once).start()


def start_raw_table(spark: SparkSession, settings: Settings, once: bool = False) -> StreamingQuery:
    """Sensor topic to the audit table, payloads untouched."""
    ensure_topic(spark, config.TOPIC_SENSORS, settings)
    _make_table(spark, RAW, settings)
    rows = raw_capture(topic_source(spark, config.TOPIC_SENSORS, settings))
    sink = _paced(table_sink(rows, RAW, settings, RAW_TABLE), once, settings.table_trigger)
    return start_table_sink(sink, RAW, settings)


def start_unreadable_table(spark: SparkSession, settings: Settings, once: bool = False) -> StreamingQuery:
    """Messages of the sensor topic that are no readable events, as text, to a table of their own.

    They flow on as rows of missing values too; this says what they were.
    """
    ensure_topic(spark, config.TOPIC_SENSORS, settings)
    _make_table(spark, UNREADABLE, settings)
    unreadable = corrupt_payloads(topic_source(spark, config.TOPIC_SENSORS, settings), SENSOR_SCHEMA)
    rows = raw_capture(unreadable.withColumnRenamed("json_data", "value"))
    sink = _paced(table_sink(rows, UNREADABLE, settings, UNREADABLE_TABLE), once, settings.table_trigger)
    return start_table_sink(sink, UNREADABLE, settings)


def start_flag_table(spark: SparkSession, settings: Settings, once: bool = False) -> StreamingQuery:
    """Enriched topic to the fact table, with the alert flag."""
    ensure_topic(spark, config.TOPIC_ENRICHED, settings)
    _make_table(spark, ENRICHED, settings)
    rows = flagged_stream(topic_source(spark, config.TOPIC_ENRICHED, settings), settings)
    sink = _paced(table_sink(rows, ENRICHED, settings, FLAG_TABLE, "car_id"), once, settings.table_trigger)
    return start_table_sink(sink, ENRICHED, settings)


def start_alert_topic(spark: SparkSession, settings: Settings, once: bool = False) -> StreamingQuery:
    """Enriched topic to alert topic, alerts only."""
    ensure_topic(spark, config.TOPIC_ENRICHED, settings)
    flagged = flagged_stream(topic_source(spark, config.TOPIC_ENRICHED, settings), settings)
    payload = to_payload(only_alerts(flagged))
    return _paced(topic_sink(payload, config.TOPIC_ALERTS, settings, ALERT_TOPIC), once).start()


def _state_options(settings: Settings):
    if settings.state_partitions is None:
        return nullcontext
    options = {"spark.sql.shuffle.partitions": str(settings.state_partitions)}
    return lambda spark: session_options(spark, options)


def _alert_windows(spark: SparkSession, settings: Settings, starting: str) -> DataFrame:
    """Windows of the alert topic; after a backfill those that it left, from the begin of the topic."""
    ensure_topic(spark, config.TOPIC_ALERTS, settings)
    since = backfilled_until(spark, settings)
    starting = starting if since is None else "earliest"
    return summary_stream(topic_source(spark, config.TOPIC_ALERTS, settings, starting), settings, since)


def backfill(spark: SparkSession, settings: Settings) -> bool:
    """The alerts that wait in the topic as one batch, before the aggregation is started; see ``backfill_alerts``."""
    return backfill_alerts(spark, settings, (ALERT_SUMMARY, ALERT_NOTIFICATIONS, ALERT_OUTPUTS))


def start_alert_summary(
    spark: SparkSession, settings: Settings, once: bool = False, starting: str = "latest"
) -> StreamingQuery:
    """Alert topic to the summary table; a window is stored once, when it is closed."""
    _make_table(spark, SUMMARY, settings)
    sink = table_sink(_alert_windows(spark, settings, starting), SUMMARY, settings, ALERT_SUMMARY)
    with _state_options(settings)(spark):
        return start_table_sink(_paced(sink, once, settings.trigger), SUMMARY, settings)


def start_alert_notifications(
    spark: SparkSession, settings: Settings, once: bool = False, starting: str = "latest"
) -> StreamingQuery:
    """Alert topic to the notification table; one message per closed window."""
    _make_table(spark, NOTIFICATIONS, settings)
    rows = notification_rows(_alert_windows(spark, settings, starting))
    sink = table_sink(rows, NOTIFICATIONS, settings, ALERT_NOTIFICATIONS)
    with _state_options(settings)(spark):
        return start_table_sink(_paced(sink, once, settings.trigger), NOTIFICATIONS, settings)


def start_alert_outputs(
    spark: SparkSession, settings: Settings, once: bool = False, starting: str = "latest"
) -> StreamingQuery:
    """Alert topic to the summary and the notification table, from one aggregate.

    Both writes of a micro-batch are loads of its name, so a repeated micro-batch replaces both.
    """
    for table in (SUMMARY, NOTIFICATIONS):
        _make_table(spark, table, settings)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load = load_name(query_id, batch_id)
        windows = batch.persist()  # closed windows only; computed again if an executor is lost
        try:
            write_load(windows, SUMMARY, settings, load)
            write_load(notification_rows(windows), NOTIFICATIONS, settings, load)
        finally:
            windows.unpersist()

    writer = (
        _alert_windows(spark, settings, starting)
        .writeStream.queryName(ALERT_OUTPUTS)
        .outputMode("append")
        .option("checkpointLocation", settings.checkpoint_location(ALERT_OUTPUTS))
        .foreachBatch(write_batch)
    )
    with _state_options(settings)(spark):
        return _paced(writer, once, settings.trigger).start()


def finish(*queries: StreamingQuery) -> None:
    """Wait for queries started with ``once``; a failure is raised here."""
    for query in queries:
        query.awaitTermination()


def run_chain_once(spark: SparkSession, settings: Settings, profile: Dimension | None = None) -> None:
    """Take everything in the sensor topic through all stages, then stop.

    The queries of one job run side by side; a job starts when its topic is complete.
    """
    finish(
        start_enrich_topic(spark, settings, profile, once=True),
        start_raw_table(spark, settings, once=True),
    )
    finish(
        start_flag_table(spark, settings, once=True),
        start_alert_topic(spark, settings, once=True),
    )
    finish(start_alert_summary(spark, settings, once=True, starting="earliest"))
