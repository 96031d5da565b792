"""A backlog of alerts as one batch, handed over to the stream without loss.

A stream that reads a backlog in several micro-batches drops what is older than the watermark of those
before. Here one batch takes all windows that the newest alert has closed, whatever the order of the
messages. The stream then starts with the windows from there on: it leaves out older events, and
its watermark can't pass the first of these windows before newer events come.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from torquelake import config
from torquelake.config import Settings
from torquelake.functions.payload import parse_payload
from torquelake.operators.windows import alert_window_agg
from torquelake.schemas import ENRICHED_SCHEMA, SUMMARY_SCHEMA
from torquelake.sources.tables import NOTIFICATIONS, SUMMARY, create_table, exists, write_load
from torquelake.sources.topics import ensure_topic, move_folder, topic_batch
from torquelake.streaming.notify import notification_rows

BACKFILL = "alert-backfill"
STORED = StructType([*SUMMARY_SCHEMA.fields, StructField("last_event", TimestampType())])


def _stored_windows(spark: SparkSession, settings: Settings) -> DataFrame | None:
    location = settings.checkpoint_location(BACKFILL)
    if not exists(spark, location):
        return None
    return spark.read.schema(STORED).parquet(location)


def backfilled_until(spark: SparkSession, settings: Settings) -> Column | None:
    """Start of the first window that is left to the stream; None if nothing was backfilled.

    It is the window in which the watermark lies after the newest alert of the batch.
    """
    windows = _stored_windows(spark, settings)
    if windows is None:
        return None
    newest = windows.agg(F.max("last_event").alias("t"))
    watermark = newest.select((F.col("t") - F.expr(f"INTERVAL {settings.watermark}")).alias("t"))
    micros = watermark.select(F.unix_micros(F.window("t", settings.window)["start"])).first()
    return F.timestamp_micros(F.lit(micros[0]))


def backfill_alerts(spark: SparkSession, settings: Settings, consumers: tuple[str, ...]) -> bool:
    """Summaries and messages of the closed windows of the alert topic; False if there are no alerts.

    To be run before the first start of the queries ``consumers``, which read the topic from its begin
    then. The windows are written beside the checkpoints and get there by one renaming; they say where
    the stream starts. A run that was interrupted can be repeated: it finds them, and the loads
    of the tables have a fixed name. Iceberg may get them twice then. Alerts without an event time are
    in no window. An alert that comes after the batch but is older than its windows is late, as
    it would be for the stream.
    """
    ensure_topic(spark, config.TOPIC_ALERTS, settings)
    location = settings.checkpoint_location(BACKFILL)
    if not exists(spark, location):
        started = [name for name in consumers if exists(spark, settings.checkpoint_location(name))]
        if started:
            raise ValueError(f"{', '.join(started)}: started before; its windows can't be backfilled")
        alerts = parse_payload(topic_batch(spark, config.TOPIC_ALERTS, settings), ENRICHED_SCHEMA)
        windows = alert_window_agg(alerts, settings.window, last_event=F.max("event_time"))
        windows.write.mode("overwrite").parquet(f"{location}-written")
        if spark.read.schema(windows.schema).parquet(f"{location}-written").isEmpty():
            return False
        move_folder(spark, f"{location}-written", location)
    closed = _stored_windows(spark, settings).filter(F.col("window_start") < backfilled_until(spark, settings))
    for table, rows in ((SUMMARY, closed), (NOTIFICATIONS, notification_rows(closed))):
        if settings.catalogued or settings.table_format == "iceberg":
            create_table(spark, table, settings)
        write_load(rows, table, settings, BACKFILL)
    return True
