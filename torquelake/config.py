"""Settings of a deployment, and the few session options the package depends on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# Topic names, schema names and table names users already know.
TOPIC_SENSORS = "sensors-sample"
TOPIC_ENRICHED = "samples-enriched"
TOPIC_ALERTS = "alert-data"
SCHEMA_DIMS = "dims"
SCHEMA_RAW = "cars_raw"
TABLE_MODELS = "car_models"
TABLE_COLORS = "car_colors"
TABLE_CARS = "cars"
TABLE_ENRICHED = "cars_enriched"
TABLE_RAW = "cars_raw"
TABLE_UNREADABLE = "unreadable_messages"
TABLE_SUMMARY = "alert_summary"
TABLE_NOTIFICATIONS = "notifications"

MIB = 1024 * 1024


@dataclass(frozen=True)
class AlertRules:
    """Thresholds of the alert rule; bounds are strict."""

    max_speed: int = 120
    max_rpm: int = 6000
    speed_per_gear: int = 30


@dataclass(frozen=True)
class Settings:
    """Where things are stored, in which formats, and the limits used at scale."""

    root: str = "spark-warehouse"
    table_format: str = "parquet"  # or "iceberg"
    catalog: str = "spark_catalog"
    catalogued: bool = True  # False: Parquet tables are folders without a catalog entry
    topic_format: str = "files"  # or "kafka"
    kafka_servers: str = ""
    rules: AlertRules = field(default_factory=AlertRules)

    window: str = "1 minute"
    watermark: str = "10 seconds"
    trigger: str = "1 minute"  # pace of the summary and the notifications
    table_trigger: str | None = None  # pace of the raw and the fact table; None is as fast as possible

    # A dimension is broadcast only if it is measured to be within both limits.
    broadcast_rows: int = 1_000_000
    broadcast_bytes: int = 64 * MIB
    # A larger one is hashed per shuffle partition if a partition's part is within this, else sorted.
    hash_join_bytes: int = 32 * MIB
    # A key is hot from this share of the rows on; at most 1 / hot_share keys can be.
    hot_share: float = 0.001

    # Input bound of one micro-batch; None reads whatever is there.
    max_files_per_trigger: int | None = None
    max_offsets_per_trigger: int | None = None
    # Partitions of streaming state. They are fixed by the first start of a stream.
    state_partitions: int | None = None

    compact_target_bytes: int = 128 * MIB
    compact_min_bytes: int = 64 * MIB
    expire_days: int = 3
    expire_retain_last: int = 10
    orphan_days: int = 1

    def hot_share_of(self, partitions: int) -> float:
        """From which share of the rows on a key is hot: at most what a task has in the mean."""
        return min(self.hot_share, 1 / max(partitions, 1))

    def table_location(self, schema: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/data/{schema}/{table}"

    def schema_location(self, schema: str) -> str:
        return f"{self.root.rstrip('/')}/data/{schema}"

    def topic_location(self, topic: str) -> str:
        return f"{self.root.rstrip('/')}/topics/{topic}"

    def checkpoint_location(self, query: str) -> str:
        return f"{self.root.rstrip('/')}/checkpoints/{query}"


def configure(builder: SparkSession.Builder, settings: Settings, rocksdb: bool = False) -> SparkSession.Builder:
    """Apply the session options of a deployment to a session builder."""
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "snappy",
    }
    if settings.table_format == "iceberg":
        options |= {
            "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
            f"spark.sql.catalog.{settings.catalog}": (
                "org.apache.iceberg.spark.SparkSessionCatalog"
                if settings.catalog == "spark_catalog"
                else "org.apache.iceberg.spark.SparkCatalog"
            ),
            f"spark.sql.catalog.{settings.catalog}.type": "hive",
            "spark.sql.warehouse.dir": settings.root,
        }
    if rocksdb:
        options["spark.sql.streaming.stateStore.providerClass"] = (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        )
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder


def prepare_session(spark: SparkSession) -> SparkSession:
    """Event times without a zone are read as UTC; a session made elsewhere may say otherwise."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def session_options(spark: SparkSession, options: dict[str, str]) -> Iterator[None]:
    """Set session options for a block and put the former values back."""
    before = {key: spark.conf.get(key, None) for key in options}
    for key, value in options.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables, on the shared storage every executor sees.

    The cluster names that storage in ``spark.checkpoint.dir``. Only a local session may
    fall back to a folder of this machine.
    """
    key = "spark.checkpoint.dir"
    context = spark.sparkContext
    base = context.getConf().get(key) or spark.conf.get(key, None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="torquelake-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
