"""The commands one after another, on the session of the tests."""

import pytest
from conftest import SMALL

from torquelake.__main__ import arguments, run
from torquelake.config import TOPIC_SENSORS, Settings
from torquelake.queries import messages
from torquelake.sources.given import given_cars
from torquelake.sources.topics import write_topic


@pytest.fixture
def command(spark, tmp_path, capsys):
    settings = Settings(root=str(tmp_path), state_partitions=2)

    def call(*words):
        run(spark, settings, arguments().parse_args(["--root", str(tmp_path), *words]))
        return capsys.readouterr().out

    yield call, settings
    for schema in ("dims", "cars_raw"):
        spark.sql(f"DROP DATABASE IF EXISTS {schema} CASCADE")


def test_commands(spark, command, tmp_path):
    call, settings = command
    given_cars(spark, SMALL).write.parquet(f"{tmp_path}/cars_in")
    write_topic(messages(spark, SMALL), TOPIC_SENSORS, settings)
    call("init")
    call("load-cars", f"{tmp_path}/cars_in")
    call("enrich", "--once")
    call("flag", "--once")
    call("aggregate", "--once", "--starting", "earliest")
    assert "dims" in call("schemas")
    assert "cars_enriched" in call("tables", "dims")
    assert "*150* rows" in call("count", "dims.cars")
    assert "*150* rows" in call("count", "cars")
    assert "*1,000* rows" in call("count", "cars_raw.cars_raw")
    assert "Picanto" in call("preview", "dims.car_models") or "Mazda" in call("preview", "dims.car_models")
    counted = call("query", "SELECT", "count(*)", "AS", "n", "FROM", "dims.cars_enriched", "WHERE", "is_alert")
    assert counted.strip().splitlines()[-1] == "918"
    windows = call("query", "SELECT count(*) AS n FROM dims.notifications")
    assert windows.strip().splitlines()[-1] == "905"
    assert "folders to merge" in call("maintain", "dims", "cars_enriched")
    both = call("maintain")
    assert both.index("dims.cars_enriched") < both.index("cars_raw.cars_raw")
    call("init")
    assert "*7* rows" in call("count", "dims.car_models")
    assert "*1,000* rows" in call("count", "dims.cars_enriched")


def test_unknown_command_is_refused():
    with pytest.raises(SystemExit):
        arguments().parse_args(["--root", "x", "unknown"])
