from types import SimpleNamespace

import pytest
from pyspark.sql import SparkSession

from torquelake.config import Settings, configure, prepare_session, scratch_folder, session_options
from torquelake.sources.topics import kafka_read_options, kafka_write_options


def fake_session(master, folder=None):
    conf = {} if folder is None else {"spark.checkpoint.dir": folder}
    context = SimpleNamespace(master=master, getConf=lambda: conf, getCheckpointDir=lambda: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))


def test_scratch_is_below_the_shared_folder():
    folder = scratch_folder(fake_session("spark://host:7077", "s3a://shared/ckpt/"), "x")
    assert folder.startswith("s3a://shared/ckpt/x-")


def test_scratch_is_new_each_time():
    session = fake_session("spark://host:7077", "/shared")
    assert scratch_folder(session, "x") != scratch_folder(session, "x")


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(fake_session("yarn"), "x")


def test_shared_folder_of_the_session_is_used(spark):
    assert scratch_folder(spark, "x").startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))


def test_session_options_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session_options(spark, {"spark.sql.shuffle.partitions": "3", "torquelake.test": "x"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("torquelake.test", None) is None


def test_session_runs_in_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert prepare_session(spark).conf.get("spark.sql.session.timeZone") == "UTC"


def test_iceberg_options_only_when_asked_for():
    class Builder:
        def __init__(self):
            self.options = {}

        def config(self, key, value):
            self.options[key] = value
            return self

    plain = configure(Builder(), Settings()).options
    assert not any("iceberg" in value for value in plain.values())
    lake = configure(Builder(), Settings(table_format="iceberg", catalog="lake"), rocksdb=True).options
    assert lake["spark.sql.catalog.lake"] == "org.apache.iceberg.spark.SparkCatalog"
    assert "RocksDB" in lake["spark.sql.streaming.stateStore.providerClass"]
    assert SparkSession.builder is not None


def test_kafka_options():
    settings = Settings(topic_format="kafka", kafka_servers="broker:9092", max_offsets_per_trigger=1000)
    assert kafka_read_options("t", settings, "earliest") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "1000",
    }
    assert kafka_write_options("t", settings) == {"kafka.bootstrap.servers": "broker:9092", "topic": "t"}
