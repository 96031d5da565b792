"""Summaries of frequent keys that are kept with each load and merged without reading the facts again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY, ROWS, TOTAL = "key", "n", "total"


def key_summary(facts: DataFrame, key: str, share: float) -> DataFrame:
    """``key, n, total`` of a load: keys with more than half of ``share`` of its rows, and its rows under a missing key.

    Rows are counted before the shuffle. There are at most ``2 / share`` keys, whatever the size
    of the load. A load without rows has a total of 0.
    """
    counts = facts.groupBy(F.col(key).cast("string").alias(KEY)).agg(F.count(F.lit(1)).alias(ROWS))
    total = facts.count()
    frequent = counts.filter(F.col(KEY).isNotNull() & (F.col(ROWS) > share / 2 * total)).withColumn(TOTAL, F.lit(total).cast("long"))
    load = facts.sparkSession.range(1).select(F.lit(None).cast("string").alias(KEY), F.lit(0).cast("long").alias(ROWS), F.lit(total).cast("long").alias(TOTAL))
    return frequent.unionByName(load)


def merged_hot_keys(summaries: DataFrame, share: float) -> tuple[str, ...]:
    """Keys that may hold more than ``share`` of all rows of the summarised loads; none that does is missed.

    A load whose summary leaves a key out has at most half of ``share`` of its rows under it. That
    bounds a key's rows from above, and only keys are returned whose bound is over ``share``. They have
    more than half of it in the loads that name them, so there are at most ``2 / share``.
    """
    everything = summaries.filter(F.col(KEY).isNull()).agg(F.coalesce(F.sum(TOTAL), F.lit(0))).first()[0]
    named = summaries.filter(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.sum(ROWS).alias(ROWS), F.sum(TOTAL).alias("_in"))
    most = F.col(ROWS) + share / 2 * (everything - F.col("_in"))
    return tuple(sorted(r[KEY] for r in named.filter(most > share * everything).select(KEY).collect()))
