import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

REPO = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(REPO))

from torquelake import Settings, configure  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("session")
    os.environ.setdefault("TZ", "UTC")
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("torquelake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
    )
    session = configure(builder, Settings()).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
