"""Row frames over a partition that may hold a third of all rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from torquelake.config import Settings
from torquelake.operators.joins import hot_keys

RANGE, HALO = "_range", "_halo"


def _place(rows: DataFrame, column: str) -> Column:
    """An orderable number of a time or a number."""
    kind = rows.schema[column].dataType
    if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column).cast("double")


def trailing_frame(
    rows: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    preceding: int,
    values: Mapping[str, Callable[[WindowSpec], Column]],
    settings: Settings,
    ways: int | None = None,
) -> DataFrame:
    """``rows`` with ``values`` over each row and the ``preceding`` ones before it in its partition.

    The first column of ``partition_by`` is looked through for hot keys (a missing key may be one).
    Their partitions are split into ``ways`` ranges of the first ordering column, a time or a number, by
    its quantiles for each key; ranges are worked on apart. To the start of each range the last rows of the
    ranges before it are copied, as many as the frame looks back; they take part in the frames and
    are dropped. The result is that of the plain window. Rows that tie in ``order_by`` may come in either
    order, as in any window; rows of one time stay in one range.
    """
    key, time = partition_by[0], order_by[0]
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ways = max(ways or partitions, 2)
    share = settings.hot_share_of(partitions)
    order = [F.col(c) for c in order_by]

    def framed(part: DataFrame, by: Sequence[str]) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order).rowsBetween(-preceding, 0)
        return part.withColumns({name: value(window) for name, value in values.items()})

    hot = hot_keys(rows, key, share)
    n_rows, n_null = rows.agg(F.count(F.lit(1)), F.count_if(F.col(key).isNull())).first()
    is_hot = F.coalesce(F.col(key).isin(*hot), F.lit(False)) if hot else F.lit(False)
    if n_null > share * n_rows:
        is_hot = is_hot | F.col(key).isNull()
    elif not hot:
        return framed(rows, partition_by)

    split = rows.filter(is_hot)
    # At most 1 / share + 1 keys with as many bounds as there are ranges.
    steps = F.array(*[F.lit(k / ways) for k in range(1, ways)])
    bounds = split.groupBy(key).agg(F.percentile_approx(_place(rows, time), steps, F.lit(10 * ways)).alias("_bounds"))
    small = F.broadcast(bounds.withColumnRenamed(key, "_key"))
    split = split.join(small, split[key].eqNullSafe(small["_key"])).drop("_key")
    below = F.size(F.filter(F.coalesce("_bounds", F.array()), lambda b: b < _place(rows, time)))
    split = split.withColumn(RANGE, F.when(F.col(time).isNull(), -1).otherwise(below)).drop("_bounds")

    by = [*partition_by, RANGE]
    last = Window.partitionBy(*by).orderBy(*[c.desc() for c in order])
    tails = split.withColumn("_back", F.row_number().over(last)).filter(F.col("_back") <= preceding)
    # A few rows a range: numbered along their partition, every range takes the last ones before it.
    along = Window.partitionBy(*partition_by).orderBy(RANGE, F.col("_back").desc())
    tails = tails.withColumn("_at", F.row_number().over(along))
    ends = tails.groupBy(*by).agg(F.min("_at").alias("_first"))
    ends = ends.filter(F.col("_first") > 1)  # nothing stands before the first range
    wanted = ends.select(
        *[F.col(c).alias(f"_p{k}") for k, c in enumerate(partition_by)],
        F.col(RANGE).alias("_into"),
        F.explode(F.sequence(F.greatest(F.col("_first") - preceding, F.lit(1)), F.col("_first") - 1)).alias("_want"),
    )
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_p{k}")) for k, c in enumerate(partition_by)])
    halo = tails.join(wanted, same & (F.col("_at") == F.col("_want"))).withColumn(RANGE, F.col("_into"))
    split = split.withColumn(HALO, F.lit(False))
    split = split.unionByName(halo.withColumn(HALO, F.lit(True)).select(*split.columns))
    spread = framed(split, by).filter(~F.col(HALO)).drop(RANGE, HALO)
    return framed(rows.filter(~is_hot), partition_by).unionByName(spread)
