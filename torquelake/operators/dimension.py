"""A dimension table together with its measured size."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from torquelake.config import Settings


@dataclass(frozen=True)
class Dimension:
    """A dimension, its join key and its size, which decides how facts are joined to it.

    ``size`` is in bytes; ``largest`` is the part of it that the most frequent key has.
    ``repeats`` is the most rows that a key has, None if nobody has counted them. ``hot_keys`` are keys with many facts, None as long as nobody has looked for them.
    """

    frame: DataFrame
    key: str
    rows: int
    size: int
    largest: int
    hot_keys: tuple | None = None
    repeats: int | None = None

    @property
    def unique(self) -> bool:
        """Whether no key is known to have two rows, so that a left join keeps the number of facts."""
        return self.repeats is not None and self.repeats <= 1

    def keys_only(self) -> Dimension:
        """The same rows without their attributes."""
        return replace(self, frame=self.frame.select(self.key))

    def fits_broadcast(self, settings: Settings) -> bool:
        return self.rows <= settings.broadcast_rows and self.size <= settings.broadcast_bytes

    def fits_hash_join(self, settings: Settings, partitions: int) -> bool:
        """Whether every task's part is small, also that of the task with the most frequent key."""
        return self.size / partitions + self.largest <= settings.hash_join_bytes

    def with_hot_keys(self, keys: tuple | None) -> Dimension:
        return replace(self, hot_keys=keys)


def measured(frame: DataFrame, key: str) -> Dimension:
    """Measure a dimension: counted per key first, then one row to the driver."""
    texts = [f.name for f in frame.schema if isinstance(f.dataType, StringType)]
    width = F.lit(8 * (len(frame.columns) - len(texts)))
    for name in texts:
        width = width + F.coalesce(F.octet_length(name), F.lit(0))
    per_key = frame.groupBy(key).agg(F.count("*").alias("rows"), F.sum(width.cast("long")).alias("size"))
    matched = F.max(F.when(F.col(key).isNotNull(), F.col("rows")))  # the missing key matches nothing
    rows, size, largest, repeats = (total or 0 for total in per_key.agg(F.sum("rows"), F.sum("size"), F.max("size"), matched).first())
    return Dimension(frame, key, rows, size, largest, repeats=repeats)
