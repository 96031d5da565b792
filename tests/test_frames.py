"""Frames over split partitions against the plain window."""

from dataclasses import replace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from torquelake import Settings
from torquelake.operators.frames import trailing_frame

VALUES = {
    "n": lambda w: F.count("v").over(w),
    "most": lambda w: F.max("v").over(w),
    "total": lambda w: F.sum("v").over(w),
}


def events(spark, hot, n=3000):
    """Half of the rows on one key; times with gaps, repeats and missing ones; a unique second order."""
    key = F.when(F.col("id") % 2 == 0, hot).otherwise(F.col("id") % 11)
    seconds = F.when(F.col("id") % 97 == 0, None).otherwise((F.col("id") * 7919 % 1000) * (1 + F.col("id") % 3) * 100)
    return spark.range(n).select(
        key.cast("long").alias("k"),
        (F.col("id") % 3).alias("day"),
        F.timestamp_seconds(seconds).alias("t"),
        "id",
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") * 31 % 101).alias("v"),
    )


def plain(rows, preceding):
    window = Window.partitionBy("k", "day").orderBy("t", "id").rowsBetween(-preceding, 0)
    return rows.withColumns({name: value(window) for name, value in VALUES.items()})


@pytest.mark.parametrize("hot", [5, None])
@pytest.mark.parametrize("preceding, ways", [(4, 6), (1, 40), (50, 300)])
def test_same_as_the_plain_window(spark, hot, preceding, ways):
    rows = events(spark, hot)
    got = trailing_frame(rows, ["k", "day"], ["t", "id"], preceding, VALUES, replace(Settings(), hot_share=0.1), ways)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain(rows, preceding).collect()))


def test_hot_key_is_spread(spark):
    """Rows of one key and day go to many tasks."""
    rows = events(spark, 5).filter("k = 5 and day = 0 and t is not null")
    got = trailing_frame(rows, ["k", "day"], ["t", "id"], 4, VALUES, Settings(), 8)
    spread = got.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(spread) >= 4
    assert max(r["count"] for r in spread) <= 0.5 * rows.count()


def test_empty_and_even_tables(spark):
    rows = events(spark, 5)
    assert trailing_frame(rows.limit(0), ["k", "day"], ["t", "id"], 4, VALUES, Settings()).count() == 0
    even = rows.filter("k <> 5")
    got = trailing_frame(even, ["k", "day"], ["id"], 2, VALUES, replace(Settings(), hot_share=0.5))
    assert got.count() == even.count()
