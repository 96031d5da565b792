"""Summaries of frequent keys and the first start of a stream."""

from dataclasses import replace

from pyspark.sql import functions as F
from test_streams import messages, write_dims

from conftest import SMALL
from torquelake import Settings, config
from torquelake.operators.heavy import key_summary, merged_hot_keys
from torquelake.sources import tables
from torquelake.sources.given import given_cars
from torquelake.sources.topics import write_topic
from torquelake.streaming import jobs


def load(spark, counts):
    rows = [(k,) for k, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "car long")


def test_no_hot_key_is_missed(spark):
    """Key 1 is hot in one load, key 2 just below the share in both, key 3 in neither."""
    loads = [{1: 60, 2: 19, None: 5, **{k: 1 for k in range(100, 116)}}, {2: 19, 3: 2, **{k: 1 for k in range(100, 179)}}]
    parts = [key_summary(load(spark, x), "car", 0.2) for x in loads]
    merged = parts[0].unionByName(parts[1])
    assert "1" in merged_hot_keys(merged, 0.2)
    assert set(merged_hot_keys(merged, 0.2)) <= {"1", "2"}
    assert merged_hot_keys(merged.limit(0), 0.2) == ()


def test_summary_of_an_empty_load(spark):
    summary = key_summary(load(spark, {1: 1}).limit(0), "car", 0.1)
    assert [tuple(r) for r in summary.collect()] == [(None, 0, 0)]
    assert merged_hot_keys(summary, 0.1) == ()


def test_share_follows_the_number_of_tasks():
    assert Settings().hot_share_of(8) == 0.001
    assert Settings().hot_share_of(100_000) == 1 / 100_000


def test_stream_knows_hot_cars_from_the_first_row(spark, tmp_path):
    """Before there are facts they come from what waits in the topic, then from the loads' summaries."""
    settings = replace(Settings(root=str(tmp_path)), catalogued=False, broadcast_rows=0, hot_share=0.1, state_partitions=2)
    write_dims(spark, settings, given_cars(spark, SMALL))
    hot = messages(spark, SMALL).withColumn("value", F.regexp_replace("value", '"car_id":[0-9]+', '"car_id":77'))
    write_topic(messages(spark, SMALL).unionByName(hot), config.TOPIC_SENSORS, settings)
    assert 77 in jobs.known_hot_cars(spark, settings)
    jobs.finish(jobs.start_enrich_topic(spark, settings, once=True))
    jobs.finish(jobs.start_flag_table(spark, settings, once=True))
    summaries = tables.read_summaries(spark, tables.ENRICHED, settings, "car_id")
    assert {r["key"] for r in summaries.collect()} >= {"77", None}
    assert jobs.known_hot_cars(spark, settings) == (77,)
