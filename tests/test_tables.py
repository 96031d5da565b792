from dataclasses import replace
from datetime import date

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from torquelake.config import Settings
from torquelake.queries import flagged, unzoned, zoned
from torquelake.sources import tables
from torquelake.sources.dims import CAR_MODELS, inline_models


@pytest.fixture
def settings(tmp_path):
    return Settings(root=str(tmp_path))


def own_schema(spark, table, settings, name):
    placed = replace(table, schema=name)
    tables.create_schema(spark, name, settings)
    tables.create_table(spark, placed, settings)
    return placed


def test_parquet_definition(spark, settings):
    sql = tables.create_table_sql(tables.ENRICHED, settings)
    assert sql.startswith("CREATE TABLE IF NOT EXISTS dims.cars_enriched (event_id STRING,event_time TIMESTAMP,")
    assert "PARTITIONED BY (load, event_day)" in sql
    assert f"LOCATION '{settings.root}/data/dims/cars_enriched'" in sql


def test_iceberg_definition(spark, settings):
    lake = replace(settings, table_format="iceberg", catalog="lake")
    sql = tables.create_table_sql(tables.RAW, lake)
    assert sql.startswith("CREATE TABLE IF NOT EXISTS lake.cars_raw.cars_raw (id STRING,json_data STRING,timestamp TIMESTAMP)")
    assert "USING iceberg\nPARTITIONED BY (days(timestamp))" in sql
    assert "'format-version' = '2', 'write.parquet.compression-codec' = 'snappy'" in sql
    assert "PARTITIONED BY" not in tables.create_table_sql(tables.CARS, lake)


def test_creating_twice_and_reloading_keeps_one_copy(spark, settings, tmp_path):
    table = own_schema(spark, tables.MODELS, settings, "reload_dims")
    for _ in range(2):
        tables.create_table(spark, table, settings)
        tables.reload_table(inline_models(spark), table, settings)
    assert sorted(map(tuple, spark.table("reload_dims.car_models").collect())) == CAR_MODELS
    files = list((tmp_path / "data/reload_dims/car_models").glob("*.parquet"))
    assert len(files) == 1
    assert ".snappy" in files[0].name


def test_append_adds(spark, settings):
    table = own_schema(spark, tables.MODELS, settings, "append_dims")
    tables.append_table(inline_models(spark), table, settings)
    tables.append_table(inline_models(spark), table, settings)
    assert spark.table("append_dims.car_models").count() == 14


@pytest.mark.parametrize("catalogued", [True, False])
def test_writing_a_load_again_replaces_it(spark, settings, catalogued):
    settings = replace(settings, catalogued=catalogued)
    table = own_schema(spark, tables.ENRICHED, settings, f"loads_{catalogued}") if catalogued else tables.ENRICHED
    rows = zoned(flagged(spark, SMALL))
    tables.write_load(rows, table, settings, "first")
    tables.write_load(rows, table, settings, "second")
    tables.write_load(rows, table, settings, "second")
    assert tables.read_table(spark, table, settings).count() == 2000


def test_day_range_prunes_partitions(spark, settings, capsys):
    table = own_schema(spark, tables.ENRICHED, settings, "pruned")
    rows = zoned(flagged(spark, SMALL))
    tables.write_load(rows, table, settings, "all")
    found = tables.read_table(spark, table, settings, date(2024, 1, 3), date(2024, 1, 4))
    expected = rows.filter(F.to_date("event_time").between("2024-01-03", "2024-01-04"))
    assert unzoned(found).exceptAll(unzoned(expected)).count() == 0
    assert found.count() == expected.count() > 0
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(event_day" in plan
    assert "PushedFilters: [IsNotNull(event_time), GreaterThanOrEqual(event_time" in plan


def test_rows_without_a_time_are_kept(spark, settings):
    settings = replace(settings, catalogued=False)
    rows = zoned(flagged(spark, SMALL)).limit(1).withColumn("event_time", F.lit(None).cast("timestamp"))
    tables.write_load(rows, tables.ENRICHED, settings, "odd")
    assert tables.read_table(spark, tables.ENRICHED, settings).first().event_time is None
