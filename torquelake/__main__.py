"""Command line of the jobs: ``python -m torquelake --root <folder> <command>``."""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from torquelake.config import SCHEMA_DIMS, SCHEMA_RAW, AlertRules, Settings, configure
from torquelake.plans import explore
from torquelake.plans.maintenance import maintain_all
from torquelake.sources import tables
from torquelake.sources.dims import inline_colors, inline_models
from torquelake.streaming import jobs
from torquelake.streaming.control import request_stop, stored_status, streaming_status, supervise

MAINTAINED = {(table.schema, table.name): table for table in tables.ALL_TABLES if table.day_column}

# Settings that the command line takes by their names.
TUNABLE = (
    "window watermark trigger table_trigger max_files_per_trigger max_offsets_per_trigger state_partitions "
    "broadcast_rows broadcast_bytes compact_target_bytes compact_min_bytes expire_days expire_retain_last orphan_days"
).split()
RULES = ("max_speed", "max_rpm", "speed_per_gear")


def create_all(spark: SparkSession, settings: Settings) -> None:
    """Make the schemas and tables that are absent, and load the built-in dimensions."""
    for schema in (SCHEMA_DIMS, SCHEMA_RAW):
        tables.create_schema(spark, schema, settings)
    for table in tables.ALL_TABLES:
        tables.create_table(spark, table, settings)
    tables.reload_table(inline_models(spark), tables.MODELS, settings)
    tables.reload_table(inline_colors(spark), tables.COLORS, settings)


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="torquelake")
    parser.add_argument("--root", required=True, help="folder of tables, file topics and checkpoints")
    parser.add_argument("--table-format", choices=["parquet", "iceberg"], default="parquet")
    parser.add_argument("--catalog", default="spark_catalog")
    parser.add_argument("--topic-format", choices=["files", "kafka"], default="files")
    parser.add_argument("--kafka-servers", default="")
    parser.add_argument("--rocksdb", action="store_true", help="keep streaming state in RocksDB")
    defaults = Settings()
    for name in TUNABLE:
        value = getattr(defaults, name)
        kind = str if isinstance(value, str) or name == "table_trigger" else int
        parser.add_argument(f"--{name.replace('_', '-')}", type=kind, default=value)
    for name in RULES:
        parser.add_argument(f"--{name.replace('_', '-')}", type=int, default=getattr(defaults.rules, name))
    command = parser.add_subparsers(dest="command", required=True)
    command.add_parser("init", help="make schemas and tables, load models and colors")
    command.add_parser("load-cars", help="replace the cars").add_argument("parquet")
    for name in ("enrich", "flag", "aggregate"):
        job = command.add_parser(name, help="run a streaming job")
        job.add_argument("--once", action="store_true", help="handle what is there, then end")
        job.add_argument("--starting", default="latest", help="first offsets of the aggregation")
    command.add_parser("backfill", help="summarise the alerts that wait, as one batch, before the first aggregate")
    command.add_parser("status", help="streaming queries over this folder, of all sessions")
    stop = command.add_parser("stop", help="ask for the end of streaming queries, wherever they run")
    stop.add_argument("names", nargs="*", help="names of queries; none: all")
    upkeep = command.add_parser("maintain", help="maintain a table, or the fact and the raw table")
    upkeep.add_argument("schema", nargs="?")
    upkeep.add_argument("table", nargs="?")
    upkeep.add_argument("--apply", action="store_true", help="act, instead of telling what would be done")
    command.add_parser("schemas")
    listing = command.add_parser("tables")
    listing.add_argument("schema")
    listing.add_argument("--short", action="store_true", help=f"the first {explore.TABLES_SHOWN} only")
    command.add_parser("count").add_argument("table")
    command.add_parser("preview").add_argument("table")
    command.add_parser("query").add_argument("sql", nargs="+")
    return parser


def _print_lines(names: DataFrame) -> None:
    for row in names.toLocalIterator():
        print(row[0])


def run(spark: SparkSession, settings: Settings, args: argparse.Namespace) -> None:
    match args.command:
        case "init":
            create_all(spark, settings)
        case "load-cars":
            tables.reload_table(spark.read.parquet(args.parquet), tables.CARS, settings)
        case "enrich" | "flag" | "aggregate":
            started = {
                "enrich": lambda: [
                    jobs.start_enrich_topic(spark, settings, once=args.once),
                    jobs.start_raw_table(spark, settings, once=args.once),
                    jobs.start_unreadable_table(spark, settings, once=args.once),
                ],
                "flag": lambda: [
                    jobs.start_flag_table(spark, settings, once=args.once),
                    jobs.start_alert_topic(spark, settings, once=args.once),
                ],
                "aggregate": lambda: [jobs.start_alert_outputs(spark, settings, args.once, args.starting)],
            }[args.command]()
            streaming_status(spark).show(truncate=False)
            if args.once:
                jobs.finish(*started)
            else:
                supervise(spark, settings, started)
        case "backfill":
            print("backfilled" if jobs.backfill(spark, settings) else "no alerts")
        case "status":
            stored_status(spark, settings).orderBy("name").show(truncate=False)
        case "stop":
            for name in request_stop(spark, settings, args.names or None):
                print(name)
        case "maintain":
            chosen = [MAINTAINED[args.schema, args.table]] if args.table else [tables.ENRICHED, tables.RAW]
            now = datetime.now(UTC).replace(tzinfo=None)
            maintain_all(spark, chosen, settings, now, args.apply).show(truncate=False)
        case "schemas":
            _print_lines(explore.list_schemas(spark))
        case "tables":
            limit = explore.TABLES_SHOWN if args.short else None
            _print_lines(explore.list_tables(spark, args.schema, limit))
        case "count":
            explore.count_table(spark, args.table).show(truncate=False)
        case "preview":
            explore.preview(spark.table(args.table)).show(truncate=False)
        case "query":
            print(explore.run_select(spark, " ".join(args.sql)).text())


def main() -> None:
    args = arguments().parse_args()
    settings = Settings(
        root=args.root,
        table_format=args.table_format,
        catalog=args.catalog,
        topic_format=args.topic_format,
        kafka_servers=args.kafka_servers,
        rules=AlertRules(**{name: getattr(args, name) for name in RULES}),
        **{name: getattr(args, name) for name in TUNABLE},
    )
    # A file topic outlives the session, and so should the tables: the catalog is Hive's.
    builder = configure(SparkSession.builder.appName("torquelake"), settings, args.rocksdb).enableHiveSupport()
    spark = builder.getOrCreate()
    try:
        run(spark, settings, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
