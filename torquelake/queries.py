"""The registered queries: every operator, run over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from torquelake import config
from torquelake.config import Settings, prepare_session, scratch_folder
from torquelake.functions.payload import parse_payload, raw_capture, to_payload
from torquelake.operators import reports
from torquelake.operators.alerts import alert_reasons, flag_alerts, only_alerts
from torquelake.operators.dimension import Dimension, measured
from torquelake.operators.enrich import enrich, enrich_events
from torquelake.operators.frames import trailing_frame
from torquelake.operators.integrity import dim_integrity
from torquelake.operators.joins import hot_keys, left_join_dimension
from torquelake.operators.windows import alert_window_agg
from torquelake.plans import explore, maintenance
from torquelake.schemas import ENRICHED_SCHEMA, SENSOR_SCHEMA
from torquelake.sources import given, tables
from torquelake.sources.dims import inline_colors, inline_models, model_dimension
from torquelake.sources.topics import topic_batch, topic_sink, topic_source, write_topic
from torquelake.streaming import jobs
from torquelake.streaming.notify import notification_rows

Query = Callable[[SparkSession, str], DataFrame]

SETTINGS = Settings(catalogued=False)
DAY = date(2024, 1, 15)
AS_OF = datetime(2001, 8, 1)


# Inputs


def flagged(spark: SparkSession, folder: str) -> DataFrame:
    return flag_alerts(enriched(spark, folder), SETTINGS.rules)


def flagged_events(spark: SparkSession, folder: str) -> DataFrame:
    """Flagged events where no attribute of the car is asked for."""
    return flag_alerts(events_alone(spark, folder), SETTINGS.rules)


def events_alone(spark: SparkSession, folder: str) -> DataFrame:
    return enrich_events(given.given_sensors(spark, folder), car_profile(spark, folder), SETTINGS)


@lru_cache(maxsize=64)
def car_profile(spark: SparkSession, folder: str, settings: Settings = SETTINGS) -> Dimension:
    """The measured car profile; if it is too large to broadcast, with the hot cars of the events."""
    profile = given.given_dimension(spark, folder, settings)
    if profile.fits_broadcast(settings):
        return profile
    return profile.with_hot_keys(hot_keys(given.given_sensors(spark, folder), profile.key, settings.hot_share))


def enriched(spark: SparkSession, folder: str, settings: Settings = SETTINGS) -> DataFrame:
    return enrich(given.given_sensors(spark, folder), car_profile(spark, folder, settings), settings)


def zoned(frame: DataFrame) -> DataFrame:
    """Event times as instants, which JSON payloads and watermarks need."""
    return frame.withColumn("event_time", F.col("event_time").cast("timestamp"))


def unzoned(frame: DataFrame) -> DataFrame:
    """Instants as plain UTC times, which look the same in every engine."""
    times = {f.name: F.col(f.name).cast("timestamp_ntz") for f in frame.schema if f.dataType.typeName() == "timestamp"}
    return frame.withColumns(times)


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return to_payload(zoned(given.given_sensors(spark, folder)))


def run_settings(spark: SparkSession, name: str) -> Settings:
    """A storage root of its own for one run; on one machine, state is spread over its cores only."""
    context = spark.sparkContext
    partitions = context.defaultParallelism if context.master.startswith("local") else None
    return replace(SETTINGS, root=scratch_folder(spark, name), state_partitions=partitions)


# Sources, sinks, tables


def topic_source_parse(spark: SparkSession, folder: str) -> DataFrame:
    settings = run_settings(spark, "topic-source")
    write_topic(messages(spark, folder), config.TOPIC_SENSORS, settings)
    parsed = parse_payload(topic_source(spark, config.TOPIC_SENSORS, settings), SENSOR_SCHEMA)
    out = f"{settings.root}/parsed"
    writer = parsed.writeStream.format("parquet").option("path", out).trigger(availableNow=True)
    jobs.finish(writer.option("checkpointLocation", settings.checkpoint_location("parse")).start())
    return unzoned(spark.read.schema(SENSOR_SCHEMA).parquet(out))


def topic_roundtrip_enriched(spark: SparkSession, folder: str) -> DataFrame:
    settings = run_settings(spark, "topic-roundtrip")
    write_topic(messages(spark, folder), config.TOPIC_SENSORS, settings)
    profile = car_profile(spark, folder)
    stream = jobs.enriched_stream(topic_source(spark, config.TOPIC_SENSORS, settings), profile, settings)
    writer = topic_sink(to_payload(stream), config.TOPIC_ENRICHED, settings, jobs.ENRICH_TOPIC)
    jobs.finish(writer.trigger(availableNow=True).start())
    return unzoned(parse_payload(topic_batch(spark, config.TOPIC_ENRICHED, settings), ENRICHED_SCHEMA))


def stream_enriched_table(spark: SparkSession, folder: str) -> DataFrame:
    settings = run_settings(spark, "enriched-table")
    write_topic(messages(spark, folder), config.TOPIC_SENSORS, settings)
    profile = car_profile(spark, folder)
    jobs.finish(jobs.start_enrich_topic(spark, settings, profile, once=True))
    jobs.finish(jobs.start_flag_table(spark, settings, once=True))
    return unzoned(tables.read_table(spark, tables.ENRICHED, settings))


def stream_raw_table(spark: SparkSession, folder: str) -> DataFrame:
    settings = run_settings(spark, "raw-table")
    write_topic(messages(spark, folder), config.TOPIC_SENSORS, settings)
    jobs.finish(jobs.start_raw_table(spark, settings, once=True))
    rows = tables.read_table(spark, tables.RAW, settings)
    return rows.select(
        "json_data", F.col("id").isNotNull().alias("has_id"), F.col("timestamp").isNotNull().alias("has_timestamp")
    )


def stream_unreadable_table(spark: SparkSession, folder: str) -> DataFrame:
    """The side output of unreadable messages; every 41st message is cut off."""
    settings = run_settings(spark, "unreadable")
    value, key = F.col("value"), F.col("event_id").cast("bigint")
    sent = zoned(given.given_sensors(spark, folder)).select("event_id", F.to_json(F.struct("*")).alias("value"))
    sent = sent.select(F.when(key % 41 == 0, F.substring(value, 1, 25)).otherwise(value).alias("value"))
    write_topic(sent, config.TOPIC_SENSORS, settings)
    jobs.finish(jobs.start_unreadable_table(spark, settings, once=True))
    return tables.read_table(spark, tables.UNREADABLE, settings).select("json_data")


def scan_cars(spark: SparkSession, folder: str) -> DataFrame:
    return given.given_cars(spark, folder).select("car_id", "driver_id", "model_id", "color_id")


def _cars_per(dim: DataFrame, cars: DataFrame, key: str) -> DataFrame:
    counted = cars.groupBy(key).agg(F.count("*").alias("num_of_cars"))
    return dim.join(counted, key, "left").withColumn("num_of_cars", F.coalesce("num_of_cars", F.lit(0)))


def inline_car_models(spark: SparkSession, folder: str) -> DataFrame:
    return _cars_per(inline_models(spark), given.given_cars(spark, folder), "model_id")


def inline_car_colors(spark: SparkSession, folder: str) -> DataFrame:
    return _cars_per(inline_colors(spark), given.given_cars(spark, folder), "color_id")


def _loaded_dims(spark: SparkSession, folder: str) -> Callable[[tables.Table], DataFrame]:
    """The dimension tables in a schema of their own, loaded twice: a reload replaces."""
    base = run_settings(spark, "dims")
    settings = replace(base, catalogued=True)
    schema = f"dims_{uuid.uuid4().hex}"
    placed = {t: replace(t, schema=schema) for t in (tables.MODELS, tables.COLORS, tables.CARS)}
    tables.create_schema(spark, schema, settings)
    rows = {
        tables.MODELS: inline_models(spark),
        tables.COLORS: inline_colors(spark),
        tables.CARS: given.given_cars(spark, folder),
    }
    for table, frame in rows.items():
        tables.create_table(spark, placed[table], settings)
        tables.append_table(frame, placed[table], settings)
        tables.reload_table(frame, placed[table], settings)
    return lambda table: tables.read_table(spark, placed[table], settings)


def load_dims_reload(spark: SparkSession, folder: str) -> DataFrame:
    read = _loaded_dims(spark, folder)
    counts = [
        read(table).agg(F.lit(table.name).alias("table_name"), F.count("*").alias("num_of_rows"))
        for table in (tables.CARS, tables.MODELS, tables.COLORS)
    ]
    return reduce(DataFrame.unionByName, counts)


def scan_car_models(spark: SparkSession, folder: str) -> DataFrame:
    read = _loaded_dims(spark, folder)
    return _cars_per(read(tables.MODELS), read(tables.CARS), "model_id")


def enriched_by_day(spark: SparkSession, folder: str) -> DataFrame:
    settings = run_settings(spark, "by-day")
    tables.write_load(zoned(flagged(spark, folder)), tables.ENRICHED, settings, "batch")
    stored = tables.ENRICHED.stored_columns(settings)
    rows = spark.read.schema(stored).parquet(tables.ENRICHED.location(settings))
    return rows.groupBy(F.col("event_day").cast("string").alias("event_day")).agg(
        F.count("*").alias("num_of_rows"), F.count_if("is_alert").alias("num_of_alerts")
    )


# Columns and predicates


def enrich_large_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Enrichment as it runs when the car profile is too large to broadcast."""
    return enriched(spark, folder, replace(SETTINGS, broadcast_rows=0))


def parse_sensor_json(spark: SparkSession, folder: str) -> DataFrame:
    binary = messages(spark, folder).select(F.col("value").cast("binary").alias("value"))
    return unzoned(parse_payload(binary, SENSOR_SCHEMA))


def raw_capture_text(spark: SparkSession, folder: str) -> DataFrame:
    return raw_capture(messages(spark, folder)).select(
        "json_data", F.col("id").isNotNull().alias("has_id"), F.col("timestamp").isNotNull().alias("has_timestamp")
    )


def filter_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return only_alerts(flagged(spark, folder))


def reasons(spark: SparkSession, folder: str) -> DataFrame:
    rows = alert_reasons(flagged_events(spark, folder), SETTINGS.rules)
    return rows.select("event_id", "is_alert", "is_speeding", "is_wrong_gear", "is_high_rpm", "reasons")


def expected_gear_counts(spark: SparkSession, folder: str) -> DataFrame:
    return events_alone(spark, folder).groupBy("expected_gear").agg(F.count("*").alias("num_of_rows"))


# Joins


def join_event_car(spark: SparkSession, folder: str) -> DataFrame:
    cars = measured(given.given_cars(spark, folder), "car_id")
    return left_join_dimension(given.given_sensors(spark, folder), cars, SETTINGS)


def join_event_model(spark: SparkSession, folder: str) -> DataFrame:
    return left_join_dimension(join_event_car(spark, folder), model_dimension(spark), SETTINGS)


# Aggregates and reports


def window_agg(spark: SparkSession, folder: str) -> DataFrame:
    return alert_window_agg(only_alerts(flagged(spark, folder)), SETTINGS.window)


def alert_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The summary kept as a day-partitioned table, read back."""
    settings = run_settings(spark, "summary")
    windows = alert_window_agg(only_alerts(zoned(flagged(spark, folder))), settings.window)
    tables.write_load(windows, tables.SUMMARY, settings, "batch")
    return unzoned(tables.read_table(spark, tables.SUMMARY, settings))


def count_flagged(spark: SparkSession, folder: str) -> DataFrame:
    return reports.count_rows(flagged_events(spark, folder))


def count_rows_text(spark: SparkSession, folder: str) -> DataFrame:
    return explore.count_text(given.given_table(spark, folder, "events"), "given.events")


def alerts_by_color(spark: SparkSession, folder: str) -> DataFrame:
    return reports.alerts_by_color(flagged(spark, folder))


def alerts_on_day(spark: SparkSession, folder: str) -> DataFrame:
    return reports.alerts_on_day(flagged_events(spark, folder), DAY)


def black_cars_over_100(spark: SparkSession, folder: str) -> DataFrame:
    return reports.cars_over(flagged(spark, folder), "Black", 100)


def notification_text(spark: SparkSession, folder: str) -> DataFrame:
    return notification_rows(window_agg(spark, folder))


# Streams


def _alert_topic(spark: SparkSession, folder: str, settings: Settings) -> None:
    write_topic(to_payload(only_alerts(zoned(flagged(spark, folder)))), config.TOPIC_ALERTS, settings)


def stream_alert_window_agg(spark: SparkSession, folder: str) -> DataFrame:
    settings = run_settings(spark, "window-agg")
    _alert_topic(spark, folder, settings)
    jobs.finish(jobs.start_alert_summary(spark, settings, once=True, starting="earliest"))
    return unzoned(tables.read_table(spark, tables.SUMMARY, settings))


def stream_notifications(spark: SparkSession, folder: str) -> DataFrame:
    settings = run_settings(spark, "notifications")
    _alert_topic(spark, folder, settings)
    jobs.finish(jobs.start_alert_outputs(spark, settings, once=True, starting="earliest"))
    return unzoned(tables.read_table(spark, tables.NOTIFICATIONS, settings))


def stream_backfill_handover(spark: SparkSession, folder: str) -> DataFrame:
    """The earlier half of the alerts waits in any order, in several files; the later half comes to the running stream."""
    settings = replace(run_settings(spark, "backfill"), max_files_per_trigger=2)
    alerts = only_alerts(zoned(flagged(spark, folder)))
    middle = alerts.select(F.percentile_approx(F.unix_micros("event_time"), F.lit(0.5)).alias("micros")).first()[0]
    is_later = F.coalesce(F.unix_micros("event_time") > F.lit(middle).cast("long"), F.lit(False))
    earlier = alerts.filter(~is_later).repartition(spark.sparkContext.defaultParallelism)
    write_topic(to_payload(earlier), config.TOPIC_ALERTS, settings)
    jobs.backfill(spark, settings)
    jobs.finish(jobs.start_alert_outputs(spark, settings, once=True))
    write_topic(to_payload(alerts.filter(is_later)), config.TOPIC_ALERTS, settings)
    jobs.finish(jobs.start_alert_outputs(spark, replace(settings, max_files_per_trigger=None), once=True))
    return unzoned(tables.read_table(spark, tables.SUMMARY, settings))


def stream_chain_end_to_end(spark: SparkSession, folder: str) -> DataFrame:
    settings = run_settings(spark, "chain")
    write_topic(messages(spark, folder), config.TOPIC_SENSORS, settings)
    jobs.run_chain_once(spark, settings, car_profile(spark, folder))
    return unzoned(tables.read_table(spark, tables.SUMMARY, settings))


# Looking around


def preview_table(spark: SparkSession, folder: str) -> DataFrame:
    return explore.preview(flagged(spark, folder), order_by=["event_time", "event_id"])


def preview_text(spark: SparkSession, folder: str) -> DataFrame:
    return explore.preview_lines(flagged(spark, folder), order_by=["event_time", "event_id"])


def _view(frame: DataFrame, name: str) -> str:
    view = f"{name}_{uuid.uuid4().hex}"
    frame.createOrReplaceTempView(view)
    return view


def run_select_bounded(spark: SparkSession, folder: str) -> DataFrame:
    view = _view(flagged(spark, folder), "flagged")
    sql = f"SELECT event_id, rpm FROM {view} WHERE is_alert ORDER BY rpm DESC NULLS LAST, event_id"
    return explore.select_bounded(spark, sql)


# Maintenance


def integrity(spark: SparkSession, folder: str) -> DataFrame:
    cars = given.given_cars(spark, folder)
    return dim_integrity(given.given_sensors(spark, folder), cars, inline_models(spark), inline_colors(spark))


def plan_compaction(spark: SparkSession, folder: str) -> DataFrame:
    files = given.given_files(spark, folder)
    plan = maintenance.plan_compaction(files, SETTINGS.compact_target_bytes, SETTINGS.compact_min_bytes)
    return plan.withColumn("partition", F.col("partition").cast("string"))


def plan_snapshot_expiry(spark: SparkSession, folder: str) -> DataFrame:
    snapshots = given.given_snapshots(spark, folder)
    return maintenance.plan_expiry(
        snapshots, AS_OF, SETTINGS.expire_days, SETTINGS.expire_retain_last, by="table_id"
    ).select("table_id", "snapshot_id", "committed_at")


def plan_orphans(spark: SparkSession, folder: str) -> DataFrame:
    listing = given.given_files(spark, folder).select("path", "bytes", "modified_at")
    referenced = given.given_referenced(spark, folder)
    return maintenance.plan_orphans(listing, referenced, AS_OF, SETTINGS.orphan_days)


# What ad-hoc SQL can do


def _sql(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    return spark.sql(explore.select_only(sql).format(**{name: _view(frame, name) for name, frame in frames.items()}))


def sql_join_kinds(spark: SparkSession, folder: str) -> DataFrame:
    names = ("orders", "customer", "events")
    return _sql(
        spark,
        """SELECT 'inner' AS kind, count(*) AS num_of_rows
             FROM {orders} JOIN {customer} ON o_custkey = c_custkey AND c_acctbal > 0
           UNION ALL SELECT 'semi', count(*) FROM {customer} LEFT SEMI JOIN
             (SELECT DISTINCT o_custkey FROM {orders} WHERE o_orderstatus = 'F') o ON o.o_custkey = c_custkey
           UNION ALL SELECT 'anti', count(*) FROM {customer} LEFT ANTI JOIN
             (SELECT DISTINCT user_id FROM {events}) e ON e.user_id = c_custkey
           UNION ALL SELECT 'full', count(*)
             FROM (SELECT user_id FROM {events} GROUP BY user_id) e FULL JOIN {customer} ON e.user_id = c_custkey
           UNION ALL SELECT 'theta', count(*)
             FROM {orders} JOIN {customer} ON o_custkey = c_custkey AND o_totalprice > c_acctbal""",
        **{name: given.given_table(spark, folder, name) for name in names},
    )


def sql_rollup_color_model(spark: SparkSession, folder: str) -> DataFrame:
    return _sql(
        spark,
        """SELECT color_name, model_name, grouping_id(color_name, model_name) AS level, count(*) AS num_of_rows,
                  count_if(is_alert) AS num_of_alerts
           FROM {flagged} GROUP BY ROLLUP (color_name, model_name)""",
        flagged=flagged(spark, folder),
    )


def sql_cube_grouping_sets(spark: SparkSession, folder: str) -> DataFrame:
    return _sql(
        spark,
        """SELECT 'cube' AS kind, color_name, brand_name, grouping_id(color_name, brand_name) AS level,
                  count(*) AS num_of_rows, max(speed) AS maximum_speed
             FROM {flagged} GROUP BY CUBE (color_name, brand_name)
           UNION ALL SELECT 'sets', color_name, brand_name, grouping_id(color_name, brand_name), count(*), max(speed)
             FROM {flagged} GROUP BY GROUPING SETS ((color_name), (brand_name), ())""",
        flagged=flagged(spark, folder),
    )


def sql_distinct_aggregates(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct values are combined in every task before the shuffle."""
    return _sql(
        spark,
        """SELECT color_name, count(DISTINCT car_id) AS num_of_cars, count(DISTINCT gear) AS num_of_gears,
                  sum(DISTINCT gear) AS sum_of_gears, count(*) AS num_of_rows
             FROM {flagged} GROUP BY color_name
           UNION ALL SELECT DISTINCT brand_name, 0, 0, 0, 0 FROM {flagged}""",
        flagged=flagged(spark, folder),
    )


def sql_moving_frame(spark: SparkSession, folder: str) -> DataFrame:
    """The last five events of a car on a day; a car with many of the events is split by time."""
    sensors = given.given_sensors(spark, folder).withColumn("day", F.to_date("event_time"))
    values = {
        "num_of_speeds": F.count("speed").over,
        "maximum_speed": F.max("speed").over,
        "sum_of_rpm": F.sum("rpm").over,
    }
    rows = sensors.select("event_id", "car_id", "event_time", "day", "speed", "rpm")
    framed = trailing_frame(rows, ["car_id", "day"], ["event_time", "event_id"], 4, values, SETTINGS)
    return framed.select("event_id", "car_id", *values)


def compacted_table(spark: SparkSession, folder: str) -> DataFrame:
    """The events in four small loads of a stream, compacted and read back."""
    settings = replace(run_settings(spark, "compacted"), catalogued=True)
    table = replace(tables.ENRICHED, schema=f"compacted_{uuid.uuid4().hex}")
    tables.create_schema(spark, table.schema, settings)
    tables.create_table(spark, table, settings)
    rows = zoned(flagged(spark, folder))
    for batch in range(4):
        part = rows.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == batch)
        tables.write_load(part, table, settings, tables.load_name("q", batch))
    maintenance.compact(spark, table, settings)
    out = f"{settings.root}/read-back"
    unzoned(tables.read_table(spark, table, settings)).write.parquet(out)
    spark.sql(f"DROP DATABASE {table.schema} CASCADE")
    return spark.read.parquet(out)


def sql_top_speed_per_car(spark: SparkSession, folder: str) -> DataFrame:
    """The rank is limited in every task before the shuffle, so a car with most events is no burden."""
    return _sql(
        spark,
        """SELECT car_id, event_id, speed, rank FROM (
             SELECT car_id, event_id, speed,
                    row_number() OVER (PARTITION BY car_id ORDER BY speed DESC NULLS LAST, event_id) AS rank
             FROM {flagged}) WHERE rank <= 3""",
        flagged=flagged_events(spark, folder),
    )


def sql_topk_rpm(spark: SparkSession, folder: str) -> DataFrame:
    return _sql(
        spark,
        "SELECT event_id, car_id, rpm FROM {flagged} ORDER BY rpm DESC NULLS LAST, event_id LIMIT 20",
        flagged=flagged_events(spark, folder),
    )


def sql_set_ops(spark: SparkSession, folder: str) -> DataFrame:
    """Keys are made distinct first, so that the joins behind the set operations see each once."""
    names = ("orders", "events")
    return _sql(
        spark,
        """SELECT 'union' AS kind, count(*) AS num_of_rows
             FROM (SELECT user_id AS k FROM {events} UNION SELECT o_custkey FROM {orders})
           UNION ALL SELECT 'intersect', count(*)
             FROM (SELECT DISTINCT user_id AS k FROM {events} INTERSECT SELECT DISTINCT o_custkey FROM {orders})
           UNION ALL SELECT 'except', count(*)
             FROM (SELECT DISTINCT o_custkey AS k FROM {orders} EXCEPT SELECT DISTINCT user_id FROM {events})""",
        **{name: given.given_table(spark, folder, name) for name in names},
    )


REGISTERED: dict[str, Query] = {
    "topic_source_parse": topic_source_parse,
    "topic_roundtrip_enriched": topic_roundtrip_enriched,
    "stream_enriched_table": stream_enriched_table,
    "stream_raw_table": stream_raw_table,
    "stream_unreadable_table": stream_unreadable_table,
    "scan_cars": scan_cars,
    "scan_car_models": scan_car_models,
    "load_dims_reload": load_dims_reload,
    "inline_car_models": inline_car_models,
    "inline_car_colors": inline_car_colors,
    "enriched_by_day": enriched_by_day,
    "enrich": enriched,
    "enrich_large_dimension": enrich_large_dimension,
    "parse_sensor_json": parse_sensor_json,
    "raw_capture": raw_capture_text,
    "flag_alerts": flagged,
    "filter_alerts": filter_alerts,
    "alert_reasons": reasons,
    "expected_gear": expected_gear_counts,
    "join_event_car": join_event_car,
    "join_event_model": join_event_model,
    "alert_window_agg": window_agg,
    "alert_summary": alert_summary,
    "count_rows": count_flagged,
    "count_rows_text": count_rows_text,
    "alerts_by_color": alerts_by_color,
    "alerts_on_day": alerts_on_day,
    "black_cars_over_100": black_cars_over_100,
    "notification_text": notification_text,
    "stream_alert_window_agg": stream_alert_window_agg,
    "stream_backfill_handover": stream_backfill_handover,
    "stream_chain_end_to_end": stream_chain_end_to_end,
    "stream_notifications": stream_notifications,
    "preview_table": preview_table,
    "preview_text": preview_text,
    "run_select_bounded": run_select_bounded,
    "dim_integrity": integrity,
    "plan_compaction": plan_compaction,
    "plan_snapshot_expiry": plan_snapshot_expiry,
    "plan_orphans": plan_orphans,
    "sql_join_kinds": sql_join_kinds,
    "sql_rollup_color_model": sql_rollup_color_model,
    "sql_cube_grouping_sets": sql_cube_grouping_sets,
    "sql_distinct_aggregates": sql_distinct_aggregates,
    "sql_moving_frame": sql_moving_frame,
    "compacted_table": compacted_table,
    "sql_top_speed_per_car": sql_top_speed_per_car,
    "sql_topk_rpm": sql_topk_rpm,
    "sql_set_ops": sql_set_ops,
}


def registered_queries() -> dict[str, Query]:
    """The queries by name; each sets the session's time zone before it runs."""

    def prepared(query: Query) -> Query:
        return lambda spark, folder: query(prepare_session(spark), folder)

    return {name: prepared(query) for name, query in REGISTERED.items()}
