"""Topics: streams of JSON messages, as folders of JSON lines or on Kafka.

A file topic has one kind of writer, either a streaming query or batches: once a streaming
query has written to a folder, Spark reads only the files that query has recorded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.readwriter import DataStreamWriter

from torquelake.config import Settings


def kafka_read_options(topic: str, settings: Settings, starting: str) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": settings.kafka_servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    if settings.max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(settings.max_offsets_per_trigger)
    return options


def kafka_write_options(topic: str, settings: Settings) -> dict[str, str]:
    return {"kafka.bootstrap.servers": settings.kafka_servers, "topic": topic}


def _file_system(spark: SparkSession, location: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def topic_exists(spark: SparkSession, topic: str, settings: Settings) -> bool:
    """Whether a file topic has a folder; Kafka makes topics itself."""
    if settings.topic_format != "files":
        return True
    system, path = _file_system(spark, settings.topic_location(topic))
    return system.exists(path)


def ensure_topic(spark: SparkSession, topic: str, settings: Settings) -> None:
    """Make the folder of a file topic if it is absent, so that it can be read before the first message."""
    if not topic_exists(spark, topic, settings):
        spark.createDataFrame([], "value string").write.mode("append").text(settings.topic_location(topic))


def topic_source(spark: SparkSession, topic: str, settings: Settings, starting: str = "earliest") -> DataFrame:
    """Stream of the messages of a topic, with at least the column ``value``.

    ``starting`` is for Kafka. A file topic has no offsets and is read from its first file.
    """
    if settings.topic_format == "kafka":
        return spark.readStream.format("kafka").options(**kafka_read_options(topic, settings, starting)).load()
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if settings.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", settings.max_files_per_trigger)
    return reader.load(settings.topic_location(topic))


def topic_batch(spark: SparkSession, topic: str, settings: Settings) -> DataFrame:
    """All messages a topic holds now."""
    if settings.topic_format == "kafka":
        return spark.read.format("kafka").options(**kafka_read_options(topic, settings, "earliest")).load()
    return spark.read.option("recursiveFileLookup", "true").text(settings.topic_location(topic))


def topic_sink(payload: DataFrame, topic: str, settings: Settings, query: str) -> DataStreamWriter:
    """Writer that appends a stream of ``value`` to a topic."""
    writer = (
        payload.writeStream.queryName(query)
        .outputMode("append")
        .option("checkpointLocation", settings.checkpoint_location(query))
    )
    if settings.topic_format == "kafka":
        return writer.format("kafka").options(**kafka_write_options(topic, settings))
    return writer.format("text").option("path", settings.topic_location(topic))


def write_topic(payload: DataFrame, topic: str, settings: Settings) -> None:
    """Append a batch of ``value`` to a topic."""
    if settings.topic_format == "kafka":
        payload.write.format("kafka").options(**kafka_write_options(topic, settings)).save()
    else:
        payload.write.mode("append").text(settings.topic_location(topic))


def write_topic_batch(payload: DataFrame, topic: str, settings: Settings, name: str) -> bool:
    """Append a named batch of ``value`` to a topic; False if a file topic has it already.

    The files are written beside the topic and get into it by one renaming of their folder, so a
    reader sees all of the batch or nothing. A batch that is repeated after a failure finds its
    folder and is left out, also if its rows have changed: readers may have taken the first.
    """
    if settings.topic_format == "kafka":
        write_topic(payload, topic, settings)
        return True
    spark = payload.sparkSession
    system, target = _file_system(spark, f"{settings.topic_location(topic)}/{name}")
    if system.exists(target):
        return False
    written = f"{settings.root.rstrip('/')}/topic-batches/{topic}/{name}"
    payload.write.mode("overwrite").text(written)
    move_folder(spark, written, f"{settings.topic_location(topic)}/{name}")
    return True


def move_folder(spark: SparkSession, written: str, location: str) -> None:
    """Put a written folder in its place by one renaming; the place must be free."""
    system, target = _file_system(spark, location)
    system.mkdirs(target.getParent())
    if not system.rename(_file_system(spark, written)[1], target):
        raise OSError(f"{written} could not be moved to {location}")
