"""Table maintenance: what to compact, expire and remove, as DataFrames, and carrying it out.

A plan changes nothing. Acting on it is a separate step that has to be asked for.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from datetime import UTC, datetime, timedelta
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from torquelake.config import Settings
from torquelake.functions.scalars import cutoff
from torquelake.sources.tables import BATCH_DIGITS, LOAD, Table, exists, load_location

# Partitions named in one catalog statement.
STATEMENT_PARTITIONS = 500
# Columns of the log of replaced folders; times in UTC.
DEREFERENCED = "folder string, dereferenced_at timestamp_ntz"
# Property of a table while a merged load takes the place of others.
OPEN_COMPACTION = "torquelake.compaction.open"
# Storage that executors can list: levels of folders that are dealt over tasks, and rows of a batch.
LISTED_SCHEMES = ("file", "hdfs", "viewfs", "s3", "s3a", "s3n", "gs")
LISTED_LEVELS, LISTED_TOGETHER = 3, 10_000
FOUND = pa.schema([("path", pa.string()), ("is_folder", pa.bool_()), ("bytes", pa.int64()), ("micros", pa.int64())])
# Folder name of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def plan_compaction(files: DataFrame, target_bytes: int, min_bytes: int) -> DataFrame:
    """Group the small files of each partition into bins of about ``target_bytes``.

    ``files`` has ``partition, path, bytes``. The files of a partition are taken in the order
    of a path hash; a file's bin follows from the bytes before it. The running sum is taken
    per (partition, first two hash digits) and shifted by the sum of the earlier digits, so a
    partition with most of the files is still shared by 256 tasks.
    """
    small = files.filter(F.col("bytes") < min_bytes).select(
        "partition",
        "path",
        "bytes",
        F.coalesce(F.col("partition").cast("string"), F.lit("")).alias("_group"),
        F.substring(F.md5("path"), 1, 2).alias("_digits"),
    )
    in_order = Window.partitionBy("_group", "_digits").orderBy("path")
    running = F.sum("bytes").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    earlier = Window.partitionBy("_group").orderBy("_digits").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        small.groupBy("_group", "_digits")
        .agg(F.sum("bytes").alias("_sum"))
        .select("_group", "_digits", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_shift"))
    )
    return (
        small.withColumn("_running", running)
        .join(shifts, ["_group", "_digits"])
        .withColumn("bin", F.expr(f"(_shift + _running - bytes) div {target_bytes}"))
        .select("partition", "path", "bytes", "bin")
    )


def plan_expiry(snapshots: DataFrame, as_of: datetime, days: int, retain_last: int, by: str | None = None) -> DataFrame:
    """Snapshots committed before the cutoff that are not among the newest ``retain_last``.

    ``snapshots`` has ``snapshot_id, committed_at`` and, with ``by``, the table it belongs
    to. Only the newest few per table are ranked, which every task limits before the
    shuffle; the rest is an anti-join on the snapshot id.
    """
    keys = [by] if by else []
    newest = Window.partitionBy(*keys).orderBy(F.desc("committed_at"), F.desc("snapshot_id"))
    kept = (
        snapshots.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= retain_last)
        .select(*keys, "snapshot_id")
    )
    old = snapshots.filter(F.col("committed_at") < cutoff(as_of, days))
    return old.join(kept, [*keys, "snapshot_id"], "left_anti")


def plan_orphans(listing: DataFrame, referenced: DataFrame, as_of: datetime, days: int) -> DataFrame:
    """Files on storage that nothing refers to, last changed before the cutoff.

    ``listing`` has ``path, modified_at``, ``referenced`` has ``path``. Repeated references
    are reduced before the join, so the join is on unique paths.
    """
    old = listing.filter(F.col("modified_at") < cutoff(as_of, days))
    return old.join(referenced.select("path").distinct(), "path", "left_anti")


# Iceberg: its own procedures do the work.


def iceberg_maintenance_sql(table: Table, settings: Settings, as_of: datetime) -> list[str]:
    """The procedure calls for a table, in the order to run them."""
    system, name = f"{settings.catalog}.system", f"{table.schema}.{table.name}"

    def before(days: int) -> str:
        return f"TIMESTAMP '{as_of - timedelta(days=days):%Y-%m-%d %H:%M:%S}'"

    return [
        f"CALL {system}.rewrite_data_files(table => '{name}', options => map("
        f"'target-file-size-bytes', '{settings.compact_target_bytes}', "
        f"'min-file-size-bytes', '{settings.compact_min_bytes}'))",
        f"CALL {system}.rewrite_manifests(table => '{name}')",
        f"CALL {system}.expire_snapshots(table => '{name}', older_than => {before(settings.expire_days)}, "
        f"retain_last => {settings.expire_retain_last})",
        f"CALL {system}.remove_orphan_files(table => '{name}', older_than => {before(settings.orphan_days)})",
    ]


# Parquet: the catalog's partitions say which folders belong to a table.


def _file_system(location: str):
    """The file system of a location, the path in it, and what stands before a path in Spark's form."""
    from pyarrow import fs

    if "://" not in location or location.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", location), "file:"
    if re.match(r"s3[an]?:", location):
        system, path = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", location))
        return system, path, re.match(r"s3[an]?://", location).group()
    system, path = fs.FileSystem.from_uri(location)
    return system, path, location.removesuffix(path)


def _children(recursive: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What the folders among the rows of a listing hold; the files among them pass through."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            files = batch.filter(pc.invert(batch.column("is_folder")))
            yield pa.RecordBatch.from_arrays(files.columns, schema=FOUND)
            for location in batch.filter(batch.column("is_folder")).column("path").to_pylist():
                system, path, before = _file_system(location)
                found = system.get_file_info(fs.FileSelector(path, allow_not_found=True, recursive=recursive))
                for first in range(0, len(found), LISTED_TOGETHER):
                    part = found[first : first + LISTED_TOGETHER]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([before + info.path for info in part], pa.string()),
                            pa.array([info.type == fs.FileType.Directory for info in part], pa.bool_()),
                            pa.array([info.size for info in part], pa.int64()),
                            pa.array([info.mtime_ns and info.mtime_ns // 1000 for info in part], pa.int64()),
                        ],
                        schema=FOUND,
                    )

    return listed


def storage_listing(spark: SparkSession, location: str) -> DataFrame:
    """``path, bytes, modified_at`` of the Parquet files below a folder; their contents are not read.

    Executors list the folders, one level after the other: the loads, their days, and what is below.
    Each level is dealt over all tasks, so neither the driver nor a task sees more than the names
    in single folders. A folder that is gone, or goes meanwhile, has no files. Storage without a
    file system in Arrow is listed by Spark.
    """
    scheme = location.split(":", 1)[0] if "://" in location or location.startswith("file:") else "file"
    if scheme not in LISTED_SCHEMES:
        return (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(location)
            .select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified_at"))
        )
    rows = spark.range(1, numPartitions=1).select(
        F.lit(location.rstrip("/")).alias("path"),
        F.lit(True).alias("is_folder"),
        F.lit(None).cast("bigint").alias("bytes"),
        F.lit(None).cast("bigint").alias("micros"),
    )
    for level in range(LISTED_LEVELS):
        last = level == LISTED_LEVELS - 1
        rows = rows.mapInArrow(_children(recursive=last), rows.schema)
        rows = rows if last else rows.repartition("path")
    data = ~F.col("is_folder") & F.col("path").endswith(".parquet")
    return rows.filter(data).select("path", "bytes", F.timestamp_micros("micros").alias("modified_at"))


def table_listing(spark: SparkSession, table: Table, settings: Settings) -> DataFrame:
    """The listing of a day-partitioned table, with load and day taken from the folder names."""
    folder = rf"/({LOAD}=([^/]+)/{table.day_column}=([^/]+))/[^/]+$"
    return storage_listing(spark, table.location(settings)).select(
        "*",
        F.regexp_extract("path", folder, 1).alias("folder"),
        F.regexp_extract("path", folder, 2).alias(LOAD),
        F.regexp_extract("path", folder, 3).alias("partition"),
    )


def registered_folders(spark: SparkSession, table: Table, settings: Settings) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table.full_name(settings)}").withColumnRenamed("partition", "folder")


def compactable_files(spark: SparkSession, table: Table, settings: Settings) -> DataFrame:
    """Files of registered folders that will not be written again.

    The newest load of each streaming query is left out, as the query may repeat it.
    """
    folders = registered_folders(spark, table, settings)
    load = F.regexp_extract("folder", f"^{LOAD}=([^/]+)/", 1)
    stream = F.regexp_extract(LOAD, rf"^(.+)-\d{{{BATCH_DIGITS}}}$", 1)
    newest = (
        folders.withColumn(LOAD, load)
        .withColumn("stream", stream)
        .filter(F.col("stream") != "")
        .groupBy("stream")
        .agg(F.max(LOAD).alias(LOAD))
        .select(LOAD)
    )
    return table_listing(spark, table, settings).join(folders, "folder", "left_semi").join(newest, LOAD, "left_anti")


def files_to_merge(spark: SparkSession, table: Table, settings: Settings) -> DataFrame:
    """``path, load, partition, bin`` of all files in the folders that are rewritten.

    A small file is merged if its bin has others. The catalog knows folders only, so the other
    files of its folder are rewritten with it, each as it is: their ``bin`` is their path.
    """
    files = compactable_files(spark, table, settings)
    plan = plan_compaction(files, settings.compact_target_bytes, settings.compact_min_bytes)
    shared = Window.partitionBy(F.coalesce(F.col("partition"), F.lit("")), "bin")
    several = plan.withColumn("_files", F.count("*").over(shared)).filter("_files > 1")
    bins = several.select("path", F.col("bin").cast("string").alias("_bin"))
    chosen = files.join(bins, "path", "left")
    folders = chosen.filter(F.col("_bin").isNotNull()).select("folder").distinct()
    return chosen.join(folders, "folder", "left_semi").select(
        "path", LOAD, "partition", F.coalesce("_bin", "path").alias("bin")
    )


def folders_to_merge(spark: SparkSession, table: Table, settings: Settings) -> DataFrame:
    """``load, partition`` of the folders that are rewritten."""
    return files_to_merge(spark, table, settings).select(LOAD, "partition").distinct()


def _alter(spark: SparkSession, name: str, action: str, specs: list[str], separator: str) -> None:
    for start in range(0, len(specs), STATEMENT_PARTITIONS):
        spark.sql(f"ALTER TABLE {name} {action} {separator.join(specs[start : start + STATEMENT_PARTITIONS])}")


def _partition_spec(table: Table, load: str, day: str) -> str:
    value = "null" if day == NO_DAY else f"'{day}'"
    return f"PARTITION ({LOAD} = '{load}', {table.day_column} = {value})"


def _intent_location(table: Table, settings: Settings, load: str) -> str:
    """Which folders a merged load replaces; outside of the table, so it is no file of it."""
    return f"{settings.root.rstrip('/')}/maintenance/{table.schema}/{table.name}/{load}"


def _dereferenced_location(table: Table, settings: Settings) -> str:
    """The log of folders that the catalog has let go, with the time of it."""
    return f"{settings.root.rstrip('/')}/maintenance/{table.schema}/{table.name}/dereferenced"


def _log_dereferenced(replaced: list[Row], table: Table, settings: Settings, load: str, as_of: datetime, spark: SparkSession) -> None:
    """Write down when folders are let go, before they are; the same exchange made again has its later time."""
    rows = spark.createDataFrame(
        [(f"{LOAD}={row[LOAD]}/{table.day_column}={row.partition}", as_of) for row in replaced], DEREFERENCED
    )
    rows.coalesce(1).write.mode("overwrite").parquet(f"{_dereferenced_location(table, settings)}/{load}")


def folders_still_read(spark: SparkSession, table: Table, settings: Settings, as_of: datetime) -> DataFrame:
    """``folder`` of what was let go less than ``expire_days`` ago: a query planned before may still read it."""
    location = _dereferenced_location(table, settings)
    if not exists(spark, location):
        return spark.createDataFrame([], "folder string")
    log = spark.read.schema(DEREFERENCED).option("recursiveFileLookup", "true").parquet(location)
    return log.filter(F.col("dereferenced_at") >= cutoff(as_of, settings.expire_days)).select("folder").distinct()


def open_compaction(spark: SparkSession, table: Table, settings: Settings) -> str | None:
    """The merged load whose registration has begun and not ended."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table.full_name(settings)}").filter(F.col("key") == OPEN_COMPACTION)
    found = rows.first()
    return found.value if found else None


def finish_compaction(spark: SparkSession, table: Table, settings: Settings, as_of: datetime | None = None) -> int:
    """Complete an open compaction: register the merged load, drop what it replaces; both may be repeated.

    ``as_of``, in UTC and by default now, is when the replaced folders are let go. The merged rows were complete when the intent was written, so going forward is always right.
    """
    load, name = open_compaction(spark, table, settings), table.full_name(settings)
    if load is None:
        return 0
    replaced = spark.read.parquet(_intent_location(table, settings, load)).collect()  # a batch of folders
    days = sorted({row.partition for row in replaced})
    _alter(spark, name, "ADD IF NOT EXISTS", [_partition_spec(table, load, day) for day in days], " ")
    _log_dereferenced(replaced, table, settings, load, as_of or datetime.now(UTC).replace(tzinfo=None), spark)
    _alter(spark, name, "DROP IF EXISTS", [_partition_spec(table, r[LOAD], r.partition) for r in replaced], ", ")
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ('{OPEN_COMPACTION}')")
    return len(replaced)


def _batches_of_days(folders: DataFrame) -> Iterator[list[Row]]:
    """Whole days, up to ``STATEMENT_PARTITIONS`` folders together unless one day has more."""
    days = folders.groupBy("partition").agg(F.collect_list(LOAD).alias("loads"))
    batch: list[Row] = []
    for day in days.toLocalIterator():
        if batch and sum(len(d.loads) for d in batch) + len(day.loads) > STATEMENT_PARTITIONS:
            yield batch
            batch = []
        batch.append(day)
    if batch:
        yield batch


def compact(spark: SparkSession, table: Table, settings: Settings, as_of: datetime | None = None) -> int:
    """Merge small files of a Parquet table, some days at a time; return how many folders were merged.

    The rows of each bin are written to one file of a new load that the catalog does not know
    yet. If their number is right, the folders that it replaces are written down, and the table
    gets a note that their exchange has begun. Then the new load is registered, the old folders are
    dropped from the catalog, and the note is taken away. A run that is lost in between is completed by
    the next one. The old files stay on storage until they are removed as orphans, ``expire_days``
    after the exchange at the earliest.
    """
    finish_compaction(spark, table, settings, as_of)
    name = table.full_name(settings)
    plan_at = _intent_location(table, settings, f"plan-{uuid.uuid4().hex}")
    files_to_merge(spark, table, settings).write.parquet(plan_at)
    plan = spark.read.parquet(plan_at)
    merged = 0
    for days in _batches_of_days(plan.select(LOAD, "partition").distinct()):
        merge = [(load, day.partition) for day in days for load in day.loads]
        day_column = F.col(table.day_column)
        named = [d.partition for d in days if d.partition != NO_DAY]
        in_days = day_column.isin([F.lit(d).cast("date") for d in named]) if named else F.lit(False)
        if len(named) < len(days):
            in_days = in_days | day_column.isNull()
        # Partition columns only: the catalog lists nothing but these folders.
        rows = spark.table(name).filter(in_days & F.col(LOAD).isin(sorted({load for load, _ in merge})))
        stored_day = F.coalesce(day_column.cast("string"), F.lit(NO_DAY))
        rows = rows.withColumn("partition", stored_day).withColumn("path", _plain(F.col("_metadata.file_path")))
        wanted = plan.select(_plain(F.col("path")).alias("path"), "bin")
        rows = rows.join(wanted, "path").drop("path", LOAD)
        load = f"compacted-{uuid.uuid4().hex}"
        location = load_location(table, settings, load)
        by_bin = rows.repartition("partition", "bin").drop("partition", "bin")
        by_bin.write.mode("overwrite").partitionBy(table.day_column).parquet(location)
        found, expected = spark.read.schema(table.columns).parquet(location).count(), rows.count()
        before = spark.table(name).filter(
            F.concat_ws("/", LOAD, stored_day).isin([f"{a}/{b}" for a, b in merge]) & in_days
        )
        if found != expected or expected != before.count():
            raise RuntimeError(f"compaction of {name} wrote {found} rows instead of {expected}; nothing was changed")
        replaced = spark.createDataFrame(merge, f"{LOAD} string, partition string").coalesce(1)
        replaced.write.parquet(_intent_location(table, settings, load))
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{OPEN_COMPACTION}' = '{load}')")
        merged += finish_compaction(spark, table, settings, as_of)
    return merged


def _plain(path: Column) -> Column:
    """A path of one form, as listings and scans write local ones differently."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def table_orphans(spark: SparkSession, table: Table, settings: Settings, as_of: datetime) -> DataFrame:
    """Orphans of a table. A load whose registration is open is in use, and what a compaction has
    replaced may still be read for ``expire_days`` from then on, however old its files are."""
    listing = table_listing(spark, table, settings)
    load = open_compaction(spark, table, settings)
    if load is not None:
        listing = listing.filter(F.col(LOAD) != load)
    in_use = registered_folders(spark, table, settings).union(folders_still_read(spark, table, settings, as_of))
    referenced = listing.join(in_use, "folder", "left_semi")
    return plan_orphans(listing, referenced, as_of, settings.orphan_days)


def remove_files(orphans: DataFrame) -> None:
    """Delete the files of an orphan plan, on the executors. A file that is gone already is no error."""

    def delete(rows: Iterable[Row]) -> None:
        from pyarrow import fs

        for row in rows:
            system, path, _ = _file_system(row.path)
            if system.get_file_info(path).type == fs.FileType.File:
                system.delete_file(path)

    orphans.select("path").foreachPartition(delete)


def maintain(spark: SparkSession, table: Table, settings: Settings, as_of: datetime, apply: bool = False) -> DataFrame:
    """Maintain one table, step by step; an error ends the run.

    Without ``apply`` nothing changes. The result tells what each step did or would do.
    """
    lines: list[tuple[str, int]] = []
    if settings.table_format == "iceberg":
        for statement in iceberg_maintenance_sql(table, settings, as_of):
            if apply:
                spark.sql(statement)
            lines.append((statement, int(apply)))
        return spark.createDataFrame(lines, "step string, items bigint")
    if apply:
        lines.append(("folders merged", compact(spark, table, settings, as_of)))
    else:
        lines.append(("folders to merge", folders_to_merge(spark, table, settings).count()))
    orphans = table_orphans(spark, table, settings, as_of)
    if apply:
        # Written down first: what is counted is what is removed.
        planned = _intent_location(table, settings, f"orphans-{uuid.uuid4().hex}")
        orphans.write.parquet(planned)
        orphans = spark.read.parquet(planned)
        remove_files(orphans)
    lines.append(("orphan files removed" if apply else "orphan files", orphans.count()))
    return spark.createDataFrame(lines, "step string, items bigint")


def maintain_all(
    spark: SparkSession, names: Iterable[Table], settings: Settings, as_of: datetime, apply: bool = False
) -> DataFrame:
    """Maintain tables one after another; an error ends the run before the next table."""
    reports = [
        maintain(spark, table, settings, as_of, apply).withColumn("table", F.lit(table.full_name(settings)))
        for table in names
    ]
    return reduce(DataFrame.unionByName, reports).select("table", "step", "items")
