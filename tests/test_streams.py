"""Streams against the batch functions, with late data, restarts and repeats."""

import os
import subprocess
import sys
import threading
from dataclasses import replace

import pytest
from conftest import MEDIUM, SMALL
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from torquelake import config
from torquelake.config import Settings
from torquelake.functions.payload import to_payload
from torquelake.operators.alerts import only_alerts
from torquelake.operators.windows import alert_window_agg
from torquelake.queries import enriched, flagged, messages, unzoned, zoned
from torquelake.sources import tables
from torquelake.sources.dims import inline_colors, inline_models
from torquelake.sources.given import UNKNOWN_CARS, given_cars, given_dimension, given_table
from torquelake.sources.topics import ensure_topic, topic_batch, topic_source, write_topic
from torquelake.streaming import control, jobs


@pytest.fixture
def settings(tmp_path):
    return Settings(root=str(tmp_path), catalogued=False, state_partitions=2)


def same(left, right):
    return left.count() == right.count() and left.exceptAll(right).count() == 0


def millis(frame):
    return frame.withColumn("event_time", F.date_trunc("millisecond", "event_time").cast("timestamp_ntz"))


def test_chain_equals_batch(spark, settings):
    write_topic(messages(spark, SMALL), config.TOPIC_SENSORS, settings)
    jobs.run_chain_once(spark, settings, given_dimension(spark, SMALL, Settings()))
    batch = millis(flagged(spark, SMALL))
    assert same(unzoned(tables.read_table(spark, tables.ENRICHED, settings)), batch)
    assert tables.read_table(spark, tables.RAW, settings).count() == 1000
    windows = alert_window_agg(only_alerts(batch))
    limit = only_alerts(batch).agg(F.max("event_time") - F.expr("INTERVAL 10 SECONDS")).first()[0]
    stored = unzoned(tables.read_table(spark, tables.SUMMARY, settings))
    assert same(stored, windows.filter(F.col("window_end") <= F.lit(limit)))
    assert 0 < stored.count() < windows.count()


def test_bad_messages_flow_to_the_fact_table(spark, settings):
    lines = [("not json",), ("",), ('{"event_id":"x","speed":"fast","rpm":7000}',)]
    write_topic(spark.createDataFrame(lines, "value string"), config.TOPIC_SENSORS, settings)
    profile = given_dimension(spark, SMALL, Settings())
    jobs.finish(jobs.start_enrich_topic(spark, settings, profile, once=True))
    jobs.finish(jobs.start_flag_table(spark, settings, once=True))
    rows = tables.read_table(spark, tables.ENRICHED, settings).collect()
    assert sorted((row.event_id or "", row.rpm or 0, row.is_alert) for row in rows) == [
        ("", 0, False),
        ("", 0, False),
        ("x", 7000, True),
    ]


def late_parts(spark, late_in):
    """Three sorted parts of the events; events 1, 2 and 3 come late, in the given part."""
    events = given_table(spark, MEDIUM, "events")
    rows = events.select(
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.lit("Red").alias("color_name"),
        F.lit(1).alias("speed"),
        F.lit(1).alias("rpm"),
        F.lit(1).alias("gear"),
    )
    late = F.col("event_id").isin(1, 2, 3)
    part = F.when(late, late_in).otherwise(F.floor(F.col("event_id") / 4000).cast("int"))
    return rows.withColumn("part", part)


@pytest.mark.parametrize(("late_in", "dropped", "emitted"), [(2, 3, 9996), (1, 0, 9999)])
def test_late_rows_are_dropped_one_batch_after_the_watermark_moved(spark, settings, late_in, dropped, emitted):
    rows = late_parts(spark, late_in)
    settings = replace(settings, max_files_per_trigger=1)
    for part in range(3):
        chunk = rows.filter(F.col("part") == part).drop("part").orderBy("event_time").coalesce(1)
        write_topic(to_payload(chunk), config.TOPIC_ALERTS, settings)
    query = jobs.start_alert_summary(spark, settings, once=True, starting="earliest")
    jobs.finish(query)
    states = [state for progress in query.recentProgress for state in progress["stateOperators"]]
    assert sum(state["numRowsDroppedByWatermark"] for state in states) == dropped
    total = tables.read_table(spark, tables.SUMMARY, settings).agg(F.sum("num_of_rows")).first()[0]
    assert total == emitted


def test_restart_loses_and_repeats_nothing(spark, settings):
    lines = messages(spark, SMALL).randomSplit([1.0, 1.0], seed=3)
    profile = given_dimension(spark, SMALL, Settings())

    def run():
        jobs.finish(
            jobs.start_enrich_topic(spark, settings, profile, once=True), jobs.start_raw_table(spark, settings, once=True)
        )
        jobs.finish(jobs.start_flag_table(spark, settings, once=True))

    write_topic(lines[0], config.TOPIC_SENSORS, settings)
    run()
    first = tables.read_table(spark, tables.ENRICHED, settings).count()
    assert first == lines[0].count()
    write_topic(lines[1], config.TOPIC_SENSORS, settings)
    run()
    run()
    assert same(unzoned(tables.read_table(spark, tables.ENRICHED, settings)), millis(flagged(spark, SMALL)))
    assert tables.read_table(spark, tables.RAW, settings).count() == 1000


def test_loads_are_named_after_query_and_batch(spark, settings, tmp_path):
    write_topic(messages(spark, SMALL), config.TOPIC_SENSORS, settings)
    query = jobs.start_raw_table(spark, settings, once=True)
    jobs.finish(query)
    loads = {path.name for path in tmp_path.glob("data/cars_raw/cars_raw/load=*")}
    assert loads == {f"load={tables.load_name(str(query.id), 0)}"}


def test_large_dimension_in_a_stream(spark, settings):
    large = replace(settings, broadcast_rows=0)
    write_topic(messages(spark, SMALL), config.TOPIC_SENSORS, large)
    profile = given_dimension(spark, SMALL, Settings()).with_hot_keys((3, 4))
    jobs.finish(jobs.start_enrich_topic(spark, large, profile, once=True))
    stored = topic_batch(spark, config.TOPIC_ENRICHED, large)
    assert same(stored, to_payload(zoned(enriched(spark, SMALL))))


def test_dimensions_can_be_read_per_batch(spark, settings):
    write_dims(spark, settings, given_cars(spark, SMALL))
    write_topic(messages(spark, SMALL), config.TOPIC_SENSORS, settings)
    jobs.finish(jobs.start_enrich_topic_fresh(spark, settings, once=True))
    assert same(topic_batch(spark, config.TOPIC_ENRICHED, settings), to_payload(zoned(enriched(spark, SMALL))))


def test_batch_repeated_after_a_failure_is_sent_once(spark, settings, monkeypatch):
    """The run ends when its first batch is in the topic and before the stream has noted that."""
    write_dims(spark, settings, given_cars(spark, SMALL))
    write_topic(messages(spark, SMALL), config.TOPIC_SENSORS, settings)
    send = jobs.write_topic_batch
    outcomes = []

    def lost(*args):
        outcomes.append(send(*args))
        if len(outcomes) == 1:
            raise ConnectionError("lost")

    monkeypatch.setattr(jobs, "write_topic_batch", lost)
    with pytest.raises(StreamingQueryException):
        jobs.finish(jobs.start_enrich_topic_fresh(spark, settings, once=True))
    jobs.finish(jobs.start_enrich_topic_fresh(spark, settings, once=True))
    assert outcomes == [True, False]
    wanted = to_payload(zoned(enriched(spark, SMALL)))
    assert same(topic_batch(spark, config.TOPIC_ENRICHED, settings), wanted)
    jobs.finish(jobs.start_alert_topic(spark, settings, once=True))  # the next stage reads the batch's folder
    alerts = to_payload(only_alerts(zoned(flagged(spark, SMALL))))
    assert topic_batch(spark, config.TOPIC_ALERTS, settings).count() == alerts.count()
    # Batches of later runs are new parts.
    write_topic(messages(spark, SMALL), config.TOPIC_SENSORS, settings)
    jobs.finish(jobs.start_enrich_topic_fresh(spark, settings, once=True))
    jobs.finish(jobs.start_alert_topic(spark, settings, once=True))
    assert topic_batch(spark, config.TOPIC_ENRICHED, settings).count() == 2000
    assert topic_batch(spark, config.TOPIC_ALERTS, settings).count() == 2 * alerts.count()


def test_unreadable_messages_are_kept_apart(spark, settings):
    bad = ["not json", "", '{"event_id":"x","speed":"fast"}']
    lines = [(text,) for text in [*bad, '{"event_id":"y","speed":3}', '{"unknown":1}']]
    write_topic(spark.createDataFrame(lines, "value string"), config.TOPIC_SENSORS, settings)
    for _ in range(2):  # the second run finds nothing new
        jobs.finish(jobs.start_unreadable_table(spark, settings, once=True))
    rows = tables.read_table(spark, tables.UNREADABLE, settings).collect()
    assert sorted(row.json_data for row in rows) == sorted(bad)
    assert all(row.id and row.timestamp for row in rows)


def write_dims(spark, settings, cars):
    for table, frame in ((tables.CARS, cars), (tables.MODELS, inline_models(spark)), (tables.COLORS, inline_colors(spark))):
        frame.write.mode("overwrite").parquet(table.location(settings))


def test_running_stream_keeps_its_dimensions(spark, settings):
    cars = given_cars(spark, SMALL)
    write_dims(spark, settings, cars)
    lines = messages(spark, SMALL).randomSplit([1.0, 1.0], seed=3)
    write_topic(lines[0], config.TOPIC_SENSORS, settings)
    query = jobs.start_enrich_topic(spark, settings)
    try:
        query.processAllAvailable()
        write_dims(spark, settings, cars.limit(0))
        write_topic(lines[1], config.TOPIC_SENSORS, settings)
        query.processAllAvailable()
    finally:
        query.stop()
    assert same(topic_batch(spark, config.TOPIC_ENRICHED, settings), to_payload(zoned(enriched(spark, SMALL))))


def test_hot_cars_come_from_the_fact_table(spark, settings):
    large = replace(settings, broadcast_rows=0)
    assert jobs.known_hot_cars(spark, large) is None
    tables.write_load(zoned(flagged(spark, SMALL)), tables.ENRICHED, large, "history")
    assert set(range(15)) >= {car % UNKNOWN_CARS for car in jobs.known_hot_cars(spark, large)} > set()
    write_dims(spark, large, given_cars(spark, SMALL))
    write_topic(messages(spark, SMALL), config.TOPIC_SENSORS, large)
    jobs.finish(jobs.start_enrich_topic(spark, large, once=True))
    assert same(topic_batch(spark, config.TOPIC_ENRICHED, large), to_payload(zoned(enriched(spark, SMALL))))


def test_notifications_hold_one_message_per_closed_window(spark, settings):
    write_topic(to_payload(only_alerts(zoned(flagged(spark, SMALL)))), config.TOPIC_ALERTS, settings)
    jobs.finish(jobs.start_alert_notifications(spark, settings, once=True, starting="earliest"))
    jobs.finish(jobs.start_alert_summary(spark, settings, once=True, starting="earliest"))
    messages_stored = tables.read_table(spark, tables.NOTIFICATIONS, settings)
    windows = tables.read_table(spark, tables.SUMMARY, settings)
    assert messages_stored.count() == windows.count() == messages_stored.select("window_start").distinct().count()


def test_status_and_stop(spark, settings):
    write_topic(messages(spark, SMALL), config.TOPIC_SENSORS, settings)
    query = jobs.start_raw_table(spark, settings)
    try:
        query.processAllAvailable()
        assert control.running_names(spark, jobs.QUERY_NAMES) == [jobs.RAW_TABLE]
        line = control.streaming_status(spark).filter(F.col("name") == jobs.RAW_TABLE).first()
        assert line.is_active
    finally:
        assert control.stop_queries(spark, [jobs.RAW_TABLE]) == [jobs.RAW_TABLE]
    assert control.running_names(spark, jobs.QUERY_NAMES) == []
    control.await_any(spark)


def test_other_processes_see_and_stop_a_stream(spark, settings, tmp_path):
    write_topic(messages(spark, SMALL), config.TOPIC_SENSORS, settings)
    assert control.stored_status(spark, settings).count() == 0
    queries = [jobs.start_raw_table(spark, settings), jobs.start_unreadable_table(spark, settings)]
    keeper = threading.Thread(target=control.supervise, args=(spark, settings, queries, 0.5))

    def command(*words):
        package = os.path.dirname(os.path.dirname(jobs.__file__))
        environment = os.environ | {"PYTHONPATH": os.path.dirname(package)}
        line = [sys.executable, "-m", "torquelake", "--root", settings.root, *words]
        (tmp_path / "other").mkdir(exist_ok=True)
        done = subprocess.run(line, capture_output=True, text=True, timeout=120, env=environment, cwd=tmp_path / "other")
        assert done.returncode == 0, done.stderr
        return done.stdout

    try:
        for query in queries:
            query.processAllAvailable()
        keeper.start()
        shown = command("status")
        assert jobs.RAW_TABLE in shown and jobs.UNREADABLE_TABLE in shown
        assert command("stop", jobs.RAW_TABLE, "unknown").split() == [jobs.RAW_TABLE]
        assert queries[0].awaitTermination(30) and queries[1].isActive  # the other goes on
        assert control.request_stop(spark, settings) == [jobs.UNREADABLE_TABLE]
        keeper.join(30)
        assert not keeper.is_alive() and not queries[1].isActive
        lines = {row.name: row.is_active for row in control.stored_status(spark, settings).collect()}
        assert lines == {jobs.RAW_TABLE: False, jobs.UNREADABLE_TABLE: False}
        assert control.request_stop(spark, settings) == []
    finally:
        control.stop_queries(spark, jobs.QUERY_NAMES)


def test_silent_driver_is_not_active(spark, settings, tmp_path):
    (tmp_path / "status").mkdir()
    line = '{"name":"raw-table","query_id":"q","is_active":true,"batch_id":1,"updated_at":"2024-01-01T00:00:00.000+00:00"}'
    (tmp_path / "status" / "raw-table.json").write_text(line + "\n")
    (tmp_path / "status" / "torn.json").write_text('{"name":"to')
    assert [(row.name, row.is_active) for row in control.stored_status(spark, settings).collect()] == [("raw-table", False)]


def test_state_partitions_do_not_leak_into_the_session(spark, settings):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    write_topic(spark.createDataFrame([], "value string"), config.TOPIC_ALERTS, settings)
    jobs.finish(jobs.start_alert_summary(spark, settings, once=True))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_empty_topic_can_be_read(spark, settings):
    ensure_topic(spark, config.TOPIC_SENSORS, settings)
    assert topic_source(spark, config.TOPIC_SENSORS, settings).isStreaming
    assert topic_batch(spark, config.TOPIC_SENSORS, settings).count() == 0


def test_kafka_is_used_when_chosen(spark, settings):
    kafka = replace(settings, topic_format="kafka", kafka_servers="broker:9092")
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        topic_source(spark, config.TOPIC_SENSORS, kafka)
    ensure_topic(spark, config.TOPIC_SENSORS, kafka)


def test_one_aggregate_feeds_both_tables(spark, settings):
    from torquelake.sources.tables import NOTIFICATIONS, SUMMARY

    write_topic(to_payload(zoned(flagged(spark, SMALL)).filter("is_alert")), config.TOPIC_ALERTS, settings)
    query = jobs.start_alert_outputs(spark, settings, once=True, starting="earliest")
    jobs.finish(query)
    assert len([o for o in query.lastProgress.stateOperators]) == 1
    windows = tables.read_table(spark, SUMMARY, settings).select("window_start", "window_end")
    told = tables.read_table(spark, NOTIFICATIONS, settings).select("window_start", "window_end")
    assert windows.count() > 0 and same(windows, told)


def backlog_of_ten_files(spark, settings):
    """Alerts in ten files without order, so that a stream of one file at a time would drop most of them."""
    alerts = only_alerts(zoned(flagged(spark, SMALL))).withColumn("n", F.pmod(F.xxhash64("event_id"), F.lit(10)))
    settings = replace(settings, max_files_per_trigger=1)
    for n in range(10):
        part = alerts.filter(F.col("n") == n).drop("n")
        write_topic(to_payload(part.coalesce(1)), config.TOPIC_ALERTS, settings)
    return settings, alerts.drop("n")


def test_backlog_is_handed_over_without_loss(spark, settings):
    settings, alerts = backlog_of_ten_files(spark, settings)
    assert jobs.backfill(spark, settings)
    query = jobs.start_alert_outputs(spark, settings, once=True)
    jobs.finish(query)
    states = [state for progress in query.recentProgress for state in progress["stateOperators"]]
    assert len(query.recentProgress) >= 10 and sum(state["numRowsDroppedByWatermark"] for state in states) == 0
    # An hour later another alert comes and closes what was open.
    last = alerts.orderBy(F.desc("event_time")).limit(1)
    later = last.withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 1 HOUR"))
    write_topic(to_payload(later), config.TOPIC_ALERTS, settings)
    jobs.finish(jobs.start_alert_outputs(spark, settings, once=True))
    wanted = alert_window_agg(millis(alerts).withColumn("event_time", F.col("event_time").cast("timestamp")))
    stored = tables.read_table(spark, tables.SUMMARY, settings)
    assert same(stored, wanted)
    assert same(tables.read_table(spark, tables.NOTIFICATIONS, settings).select("window_start"), wanted.select("window_start"))
    jobs.backfill(spark, settings)  # a repeat changes nothing
    assert same(tables.read_table(spark, tables.SUMMARY, settings), wanted)


def test_backfill_before_the_first_start_only(spark, settings):
    assert not jobs.backfill(spark, settings)  # no alerts
    write_topic(to_payload(only_alerts(zoned(flagged(spark, SMALL)))), config.TOPIC_ALERTS, settings)
    jobs.finish(jobs.start_alert_summary(spark, settings, once=True, starting="earliest"))
    with pytest.raises(ValueError, match=jobs.ALERT_SUMMARY):
        jobs.backfill(spark, settings)


def test_triggers(spark, monkeypatch):
    made = []

    class Writer:
        def trigger(self, **how):
            made.append(how)
            return self

    jobs._paced(Writer(), once=False, every="1 minute")
    jobs._paced(Writer(), once=True, every="1 minute")
    jobs._paced(Writer(), once=False)
    assert made == [{"processingTime": "1 minute"}, {"availableNow": True}]
