"""Left joins of facts to a dimension that stay balanced at any size and skew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torquelake.config import Settings
from torquelake.operators.dimension import Dimension

SLOT = "_slot"


def hot_keys(facts: DataFrame, key: str, share: float) -> tuple:
    """Keys that hold more than ``share`` of the rows, in one pass over one column.

    The sketch misses no such key. It may add others, which costs a few copies and nothing
    else, and never returns more than ``1 / share`` keys.
    """
    present = facts.select(key).filter(F.col(key).isNotNull())
    return tuple(sorted(present.freqItems([key], share).first()[0] or ()))


def spread_left_join(facts: DataFrame, dimension: Dimension, settings: Settings, ways: int | None = None) -> DataFrame:
    """Left join by shuffle in which neither a hot key nor the missing key lands in one task.

    Rows of a hot key are dealt to ``ways`` slots by a hash of the row, and that key's
    dimension rows are copied to every slot. Rows without a key match nothing, so they are
    dealt at random. All other rows have slot 0. Stateless, so it also runs on a stream.

    If a task's part of the dimension is small by its measured size, the task hashes it,
    which saves sorting the facts.
    """
    key = dimension.key
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ways = max(ways or partitions, 2)
    hot = F.col(key).isin(*dimension.hot_keys) if dimension.hot_keys else F.lit(False)
    slot = (
        F.when(F.col(key).isNull(), (F.rand(seed=11) * ways).cast("int"))
        .when(hot, F.pmod(F.xxhash64(*facts.columns), F.lit(ways)).cast("int"))
        .otherwise(0)
    )
    slots = F.when(hot, F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(F.array(F.lit(0)))
    copied = dimension.frame.filter(F.col(key).isNotNull()).withColumn(SLOT, F.explode(slots))
    if dimension.fits_hash_join(settings, partitions):
        copied = copied.hint("shuffle_hash")
    return facts.withColumn(SLOT, slot).join(copied, [key, SLOT], "left").drop(SLOT)


def left_join_dimension(facts: DataFrame, dimension: Dimension, settings: Settings) -> DataFrame:
    """Left join that broadcasts the dimension only if its measured size allows it.

    A larger dimension is joined by shuffle. Hot keys are then looked up in a batch of
    facts; for a stream they must come with the dimension.
    """
    if dimension.fits_broadcast(settings):
        return facts.join(F.broadcast(dimension.frame), dimension.key, "left")
    if not facts.isStreaming and dimension.hot_keys is None:
        partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dimension = dimension.with_hot_keys(hot_keys(facts, dimension.key, settings.hot_share_of(partitions)))
    return spread_left_join(facts, dimension, settings)
