import re
from dataclasses import replace
from datetime import UTC, datetime, timedelta

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from torquelake.config import Settings
from torquelake.plans import maintenance
from torquelake.queries import flagged, unzoned, zoned
from torquelake.sources import tables

NOW = datetime(2024, 6, 10)


def test_bins_follow_a_running_sum_over_each_partition(spark):
    import hashlib

    files = [(f"d{i % 2}" if i % 7 else None, f"f{i:03d}", (i * 37) % 100) for i in range(400)]
    plan = maintenance.plan_compaction(spark.createDataFrame(files, "partition string, path string, bytes long"), 200, 90)
    got = {(row.partition, row.path): row.bin for row in plan.collect()}
    want = {}
    for partition in ("d0", "d1", None):
        before = 0
        small = [f for f in files if f[0] == partition and f[2] < 90]
        for _, path, size in sorted(small, key=lambda f: (hashlib.md5(f[1].encode()).hexdigest()[:2], f[1])):
            want[partition, path] = before // 200
            before += size
    assert got == want


def test_crowded_partition_is_planned_by_many_tasks(spark, capsys):
    files = spark.range(10).selectExpr("string(id % 1) AS partition", "string(id) AS path", "1 AS bytes")
    maintenance.plan_compaction(files, 10, 5).explain()
    running = capsys.readouterr().out.split("Window")[1]
    assert re.search(r"hashpartitioning\(_group#\d+, _digits#\d+, \d+\)", running)


def snapshots(spark, count, step=timedelta(days=1)):
    rows = [("t", i, NOW - i * step) for i in range(count)]
    return spark.createDataFrame(rows, "name string, snapshot_id long, committed_at timestamp_ntz")


@pytest.mark.parametrize(
    ("count", "step", "days", "retain", "expired"),
    [
        (20, timedelta(days=1), 3, 10, list(range(10, 20))),  # old, but the last ten stay
        (20, timedelta(hours=1), 3, 10, []),  # beyond the last ten, but young
        (6, timedelta(days=1), 3, 1, [4, 5]),  # exactly three days old is not older
        (3, timedelta(days=30), 3, 10, []),
    ],
)
def test_expiry_needs_age_and_rank(spark, count, step, days, retain, expired):
    for by in ("name", None):
        plan = maintenance.plan_expiry(snapshots(spark, count, step), NOW, days, retain, by)
        assert sorted(row.snapshot_id for row in plan.collect()) == expired


def test_expiry_ranks_are_limited_before_the_shuffle(spark, capsys):
    maintenance.plan_expiry(snapshots(spark, 5), NOW, 3, 2, "name").explain()
    plan = capsys.readouterr().out
    assert "Final" in plan and "Partial" in plan and plan.count("WindowGroupLimit") == 2


def test_orphans_are_unreferenced_and_old(spark):
    listing = spark.createDataFrame(
        [("used", NOW - timedelta(days=9)), ("old", NOW - timedelta(days=2)), ("new", NOW - timedelta(hours=2))],
        "path string, modified_at timestamp_ntz",
    )
    used = spark.createDataFrame([("used",), ("used",)], "path string")
    assert [row.path for row in maintenance.plan_orphans(listing, used, NOW, 1).collect()] == ["old"]


def test_iceberg_calls_in_order():
    settings = Settings(table_format="iceberg", catalog="iceberg")
    calls = maintenance.iceberg_maintenance_sql(tables.ENRICHED, settings, NOW)
    assert [call.split("(")[0] for call in calls] == [
        "CALL iceberg.system.rewrite_data_files",
        "CALL iceberg.system.rewrite_manifests",
        "CALL iceberg.system.expire_snapshots",
        "CALL iceberg.system.remove_orphan_files",
    ]
    assert "'target-file-size-bytes', '134217728', 'min-file-size-bytes', '67108864'" in calls[0]
    assert "older_than => TIMESTAMP '2024-06-07 00:00:00', retain_last => 10" in calls[2]
    assert "older_than => TIMESTAMP '2024-06-09 00:00:00'" in calls[3]


@pytest.fixture
def fragmented(spark, tmp_path):
    """A table of one stream with three loads, and rows without a time."""
    settings = Settings(root=str(tmp_path))
    table = replace(tables.ENRICHED, schema=f"upkeep_{tmp_path.name}".replace("-", "_").lower())
    tables.create_schema(spark, table.schema, settings)
    tables.create_table(spark, table, settings)
    rows = zoned(flagged(spark, SMALL))
    odd = F.when(F.col("speed").isNotNull(), F.col("event_time"))
    for batch in range(3):
        tables.write_load(rows.withColumn("event_time", odd), table, settings, tables.load_name("q", batch))
    return table, settings


def folders(spark, table):
    return [row.partition for row in spark.sql(f"SHOW PARTITIONS {table.schema}.{table.name}").collect()]


def test_maintenance_merges_then_removes(spark, fragmented):
    table, settings = fragmented
    before = unzoned(tables.read_table(spark, table, settings)).cache()
    assert before.count() == 3000
    now = datetime.now() + timedelta(hours=1)

    told = {row.step: row.items for row in maintenance.maintain(spark, table, settings, now).collect()}
    assert told["folders to merge"] > 0 and told["orphan files"] == 0
    assert not any("compacted" in folder for folder in folders(spark, table))

    maintenance.maintain(spark, table, settings, now, apply=True)
    left = folders(spark, table)
    assert not any("load=q-000000000000" in folder or "load=q-000000000001" in folder for folder in left)
    assert any("load=q-000000000002" in folder for folder in left)  # the stream may write it again
    assert any("HIVE_DEFAULT" in folder and "compacted" in folder for folder in left)
    after = unzoned(tables.read_table(spark, table, settings))
    assert after.count() == 3000 and after.exceptAll(before).count() == 0

    later = now + timedelta(days=4)
    assert maintenance.table_orphans(spark, table, settings, now).count() == 0
    assert maintenance.table_orphans(spark, table, settings, now + timedelta(days=2)).count() == 0  # may still be read
    orphans = maintenance.table_orphans(spark, table, settings, later).count()
    assert orphans >= told["folders to merge"]
    maintenance.maintain(spark, table, settings, later, apply=True)
    assert maintenance.table_orphans(spark, table, settings, later).count() == 0
    assert tables.read_table(spark, table, settings).count() == 3000
    before.unpersist()


def test_a_reader_keeps_the_files_that_it_has_listed(spark, fragmented):
    """Files older than a day are merged by a run; a query planned before it still finds them."""
    table, settings = fragmented
    at = datetime.now(UTC).replace(tzinfo=None) + timedelta(days=10)
    reader = tables.read_table(spark, table, settings)
    old = set(reader.inputFiles())  # listed now
    report = {row.step: row.items for row in maintenance.maintain(spark, table, settings, at, apply=True).collect()}
    assert report["folders merged"] > 0 and report["orphan files removed"] == 0
    assert reader.count() == 3000
    just = at + timedelta(days=settings.expire_days)
    assert maintenance.table_orphans(spark, table, settings, just).count() == 0
    after = just + timedelta(seconds=1)
    gone = {re.sub("^file:/+", "file:///", row.path) for row in maintenance.table_orphans(spark, table, settings, after).collect()}
    assert gone and gone <= old
    # A merge that ends later is counted from its own time.
    assert maintenance.folders_still_read(spark, table, settings, after).count() == 0
    report = {row.step: row.items for row in maintenance.maintain(spark, table, settings, after, apply=True).collect()}
    assert report["orphan files removed"] == len(gone)
    assert tables.read_table(spark, table, settings).count() == 3000


def test_listing_is_made_by_executors(spark, tmp_path, capsys):
    want = {}
    for name in ("a.parquet", "load=1/b.parquet", "load=1/day=x y/c.parquet", "load=2/day=%3A/deep/er/d.parquet"):
        file = tmp_path / "t" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"x" * (len(want) + 1))
        want[f"file:{file}"] = len(want) + 1
    (tmp_path / "t" / "load=1" / "note.txt").write_text("no data")
    listing = maintenance.storage_listing(spark, str(tmp_path / "t"))
    listing.explain()
    plan = capsys.readouterr().out
    assert plan.count("MapInArrow") == 3 and plan.count("hashpartitioning(path") == 2 and "FileScan" not in plan
    assert {row.path: row.bytes for row in listing.collect()} == want
    # As Spark's own listing has them, times too.
    own = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    own = own.load(str(tmp_path / "t")).selectExpr("path", "length", "date_trunc('second', modificationTime)")
    seconds = listing.selectExpr("path", "bytes", "date_trunc('second', modified_at)")
    assert sorted(map(tuple, seconds.collect())) == sorted(map(tuple, own.collect()))
    assert maintenance.storage_listing(spark, str(tmp_path / "absent")).count() == 0


@pytest.mark.parametrize("lost", ["SET", "ADD", "DROP", "UNSET"])
def test_lost_compaction_is_completed_by_the_next(spark, fragmented, monkeypatch, lost):
    """The run ends right after one of its statements, the first time that it is made."""
    table, settings = fragmented
    monkeypatch.setattr(maintenance, "STATEMENT_PARTITIONS", 40)  # several batches, and several statements for each
    before = unzoned(tables.read_table(spark, table, settings)).cache()
    before.count()

    class Losing:
        def __init__(self):
            self.lost = False

        def __getattr__(self, name):
            return getattr(spark, name)

        def sql(self, text):
            result = spark.sql(text)
            if text.startswith("ALTER") and f" {lost} " in text and not self.lost:
                self.lost = True
                raise ConnectionError("lost")
            return result

    losing = Losing()
    with pytest.raises(ConnectionError):
        maintenance.compact(losing, table, settings)
    later = datetime.now() + timedelta(days=2)
    unfinished = maintenance.open_compaction(spark, table, settings)
    assert (unfinished is None) == (lost == "UNSET")
    if unfinished:  # its files are no orphans, registered or not
        orphans = maintenance.table_orphans(spark, table, settings, later)
        assert orphans.filter(F.col("path").contains(unfinished)).count() == 0
    maintenance.compact(spark, table, settings)
    assert maintenance.open_compaction(spark, table, settings) is None
    after = unzoned(tables.read_table(spark, table, settings))
    assert after.count() == 3000 and after.exceptAll(before).count() == 0 and before.exceptAll(after).count() == 0
    before.unpersist()


def test_small_files_beside_large_ones_are_merged(spark, tmp_path):
    settings = Settings(root=str(tmp_path), compact_min_bytes=20_000, compact_target_bytes=40_000)
    table = replace(tables.RAW, schema="upkeep_mixed")
    tables.create_schema(spark, table.schema, settings)
    tables.create_table(spark, table, settings)
    time = F.lit("2024-03-01 12:00:00").cast("timestamp")
    text = F.concat_ws(" ", *[F.md5(F.concat_ws("-", "id", F.lit(k))) for k in range(4)])
    rows = spark.range(1003).select(F.col("id").cast("string").alias("id"), text.alias("json_data"), time.alias("timestamp"))
    location = tables.load_location(table, settings, "batch")
    # One large file and three small ones in the same folder.
    by_file = F.when(F.col("id") < 1000, 0).otherwise(F.col("id").cast("int") - 999)
    dealt = tables.with_day(rows, table).repartitionByRange(4, by_file)
    dealt.write.partitionBy(table.day_column).parquet(location)
    spark.sql(f"MSCK REPAIR TABLE {table.full_name(settings)}")
    small = lambda: maintenance.table_listing(spark, table, settings).join(
        maintenance.registered_folders(spark, table, settings), "folder", "left_semi").filter("bytes < 20000").count()
    assert small() == 3
    assert maintenance.compact(spark, table, settings) == 1
    assert small() <= 1 and maintenance.folders_to_merge(spark, table, settings).count() == 0
    assert tables.read_table(spark, table, settings).select("id").distinct().count() == 1003
    assert tables.read_table(spark, table, settings).count() == 1003


def test_nothing_to_merge(spark, tmp_path):
    settings = Settings(root=str(tmp_path))
    table = replace(tables.RAW, schema="upkeep_empty")
    tables.create_schema(spark, table.schema, settings)
    tables.create_table(spark, table, settings)
    rows = spark.range(5).selectExpr("uuid() id", "'x' json_data", "current_timestamp() timestamp")
    tables.write_load(rows, table, settings, tables.load_name("q", 0))
    assert maintenance.compact(spark, table, settings) == 0
