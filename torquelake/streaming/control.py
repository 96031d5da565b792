"""Which streaming queries run, how to stop them, and how to wait for them.

The driver of the queries writes their status to the storage root while it waits, and looks there
for requests to stop, so that other sessions see its queries and can end them.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from torquelake.config import Settings
from torquelake.sources.tables import exists

STATUS_SCHEMA = "name string, query_id string, is_active boolean, batch_id bigint, input_rows bigint, message string"
STORED_STATUS = f"{STATUS_SCHEMA}, updated_at timestamp"


def _line(query) -> tuple:
    progress = query.lastProgress or {}
    return (
        query.name,
        str(query.id),
        query.isActive,
        progress["batchId"] if progress else None,
        progress["numInputRows"] if progress else None,
        query.status["message"],
    )


def streaming_status(spark: SparkSession) -> DataFrame:
    """One line per running query of the session."""
    return spark.createDataFrame([_line(query) for query in spark.streams.active], STATUS_SCHEMA)


def running_names(spark: SparkSession, names: Iterable[str]) -> list[str]:
    """Those of ``names`` that run, sorted."""
    active = {query.name for query in spark.streams.active}
    return sorted(active & set(names))


def stop_queries(spark: SparkSession, names: Iterable[str]) -> list[str]:
    """Stop the named queries that run and return their names."""
    wanted, stopped = set(names), []
    for query in spark.streams.active:
        if query.name in wanted:
            query.stop()
            stopped.append(query.name)
    return sorted(stopped)


def await_any(spark: SparkSession) -> None:
    """Keep the driver up until some query ends; raise if it failed."""
    if spark.streams.active:
        spark.streams.awaitAnyTermination()


def _file(spark: SparkSession, location: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _put(spark: SparkSession, location: str, text: str) -> None:
    system, path = _file(spark, location)
    out = system.create(path, True)
    out.write(text.encode())
    out.close()


def _status_folder(settings: Settings) -> str:
    return f"{settings.root.rstrip('/')}/status"


def _stop_marker(settings: Settings, name: str) -> str:
    return f"{settings.root.rstrip('/')}/stop-requests/{name}"


def _remove(spark: SparkSession, location: str) -> bool:
    system, path = _file(spark, location)
    return system.delete(path, False)


def supervise(spark: SparkSession, settings: Settings, queries: Iterable[StreamingQuery] | None = None, every: float = 5.0) -> None:
    """Keep the driver up while queries, by default all of the session, run, until one ends; raise if it failed.

    Every so many seconds the status of each query is stored, and those are stopped that another
    session has asked to stop. Requests from before the start are void. If a query is stopped by
    request the others go on.
    """
    queries, stopped = list(spark.streams.active if queries is None else queries), set()
    for query in queries:
        _remove(spark, _stop_marker(settings, query.name))

    def store() -> None:
        now = datetime.now(UTC).isoformat(timespec="milliseconds")
        names = [field.split()[0] for field in STATUS_SCHEMA.split(", ")]
        for query in queries:
            line = dict(zip(names, _line(query), strict=True)) | {"updated_at": now}
            _put(spark, f"{_status_folder(settings)}/{query.name}.json", json.dumps(line) + "\n")

    try:
        while len(stopped) < len(queries):
            store()
            running = [query for query in queries if query.name not in stopped]
            for query in running:
                if query.isActive and _remove(spark, _stop_marker(settings, query.name)):
                    query.stop()
                    stopped.add(query.name)
                elif not query.isActive:
                    query.awaitTermination()  # raises what ended it
                    return
            left = [query for query in running if query.name not in stopped]
            if left:
                left[0].awaitTermination(every)
    finally:
        store()


def stored_status(spark: SparkSession, settings: Settings, lapse: str = "1 minute") -> DataFrame:
    """The status of the queries over a storage root, whichever session runs them.

    A query whose driver has not written for ``lapse`` does not count as active.
    """
    location = _status_folder(settings)
    if not exists(spark, location):
        return spark.createDataFrame([], STORED_STATUS)
    lines = spark.read.schema(STORED_STATUS).json(location).filter("name IS NOT NULL")
    fresh = F.col("updated_at") > F.current_timestamp() - F.expr(f"INTERVAL {lapse}")
    return lines.withColumn("is_active", F.col("is_active") & fresh)


def request_stop(spark: SparkSession, settings: Settings, names: Iterable[str] | None = None) -> list[str]:
    """Ask the drivers of active queries, of all or of those named, to stop them; return their names."""
    active = {row.name for row in stored_status(spark, settings).filter("is_active").select("name").collect()}
    wanted = sorted(active if names is None else active & set(names))
    for name in wanted:
        _put(spark, _stop_marker(settings, name), "")
    return wanted
