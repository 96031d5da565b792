from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from torquelake.config import Settings
from torquelake.operators.dimension import Dimension, measured
from torquelake.operators.integrity import dim_integrity, rows_without_match
from torquelake.operators.joins import hot_keys, left_join_dimension, spread_left_join
from torquelake.sources.dims import inline_colors, inline_models

LARGE = replace(Settings(), broadcast_rows=0)
HUGE = replace(LARGE, hash_join_bytes=0)


@pytest.fixture
def skewed(spark):
    """Facts with a third on one key, a third without a key, and a dimension with a double key."""
    facts = spark.range(0, 6000, 1, 8).select(
        F.col("id").alias("event"),
        F.when(F.col("id") % 3 == 0, 42).when(F.col("id") % 3 == 1, F.col("id") % 500).alias("key"),
    )
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(400)] + [(42, "twin"), (None, "void")], "key long, name string")
    return facts, dim


def rows(frame):
    return sorted(frame.select("event", "key", "name").collect(), key=str)


def test_measured_counts_rows_and_bytes(spark):
    dim = measured(spark.createDataFrame([(1, "ab"), (1, "c"), (2, None)], "key long, name string"), "key")
    assert (dim.rows, dim.size, dim.largest) == (3, 27, 19)


def test_empty_dimension_is_measured(spark):
    dim = measured(spark.createDataFrame([], "key long, name string"), "key")
    assert (dim.rows, dim.size, dim.largest) == (0, 0, 0)


@pytest.mark.parametrize("settings", [Settings(), LARGE, HUGE])
def test_join_is_a_plain_left_join(spark, skewed, settings):
    facts, dim = skewed
    assert rows(left_join_dimension(facts, measured(dim, "key"), settings)) == rows(facts.join(dim, "key", "left"))


def test_bytes_alone_forbid_the_broadcast():
    dim = Dimension(None, "key", rows=10, size=10**9, largest=1)
    assert not dim.fits_broadcast(Settings())


def test_one_frequent_key_forbids_hashing():
    assert Dimension(None, "key", rows=10**7, size=10**9, largest=100).fits_hash_join(Settings(), 200)
    assert not Dimension(None, "key", rows=10**7, size=10**9, largest=10**8).fits_hash_join(Settings(), 200)


def test_hot_key_is_found(skewed):
    facts, _ = skewed
    assert 42 in hot_keys(facts, "key", 0.2)


def test_no_task_gets_the_hot_or_the_missing_key(spark, skewed):
    facts, dim = skewed
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spread_left_join(facts, measured(dim, "key").with_hot_keys((42,)), Settings(), ways=64)
        largest = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # 8000 result rows over 8 tasks; the hot key alone has 4000 of them, the missing key 2000.
    assert largest < 8000 / 8 * 2


@pytest.mark.parametrize(
    ("settings", "join"),
    [(Settings(), "BroadcastHashJoin"), (LARGE, "ShuffledHashJoin"), (HUGE, "SortMergeJoin")],
)
def test_join_follows_the_measured_size(spark, skewed, capsys, settings, join):
    facts, dim = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left_join_dimension(facts, measured(dim, "key"), settings).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    found = [kind for kind in ("BroadcastHashJoin", "ShuffledHashJoin", "SortMergeJoin") if kind in plan]
    assert found == [join]


def test_unmatched_rows_are_counted_per_key_before_the_join(spark, skewed, capsys):
    facts, dim = skewed
    found = {row.key: row.rows for row in rows_without_match(facts, dim, "key").collect()}
    assert found[None] == 2000
    assert all(key is None or key >= 400 for key in found)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows_without_match(facts, dim, "key").explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    assert plan.index("SortMergeJoin") < plan.index("HashAggregate")


def test_integrity_counts_offenders(spark):
    cars = spark.createDataFrame(
        [(1, 9, 1, 1), (1, 9, 1, 1), (2, 9, 8, 1), (3, 9, 1, None)],
        "car_id long, driver_id long, model_id int, color_id int",
    )
    events = spark.createDataFrame([(1,), (5,), (5,), (None,)], "car_id long")
    lines = dim_integrity(events, cars, inline_models(spark), inline_colors(spark)).collect()
    assert {row.check: (row.offending_keys, row.offending_rows) for row in lines} == {
        "duplicate car": (1, 2),
        "duplicate model": (0, 0),
        "duplicate color": (0, 0),
        "event without car": (2, 3),
        "car without model": (1, 1),
        "car without color": (1, 1),
    }
