"""What several operators share: identity of a row, words, stored stages, joins that stand a hot key.

A document is known by its id and a 64-bit hash of its text. Rows that repeat both are the
same document: they get the same result, each of them. A null id is an id like any other.
"""

from __future__ import annotations

import gc
import math
import pickle
import tempfile
import time
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import reduce
from typing import Any

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from torquelake.config import scratch_folder
from torquelake.llm.subwords import release

# The white space of the contracts, [\x20\x09-\x0D], and what is no letter or digit.
SPACE = " \t\n\u000b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A key with more than this share of the rows is hot, so there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.001
#: Rows up to which a measured table is broadcast.
BROADCAST_ROWS = 200_000
#: Bytes of a model that come to the driver at a time, and the rows that they come in.
PIECE, PIECES = 1 << 22, "number int, piece binary"
#: Seconds between two times that the driver gives memory back, and when it last did.
SPARED_EVERY = 10.0
_spared = -math.inf


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents as ``_id, _h, _text`` (null text: empty); other columns are left out."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), text.alias("_text")).withColumn("_h", F.xxhash64("_text"))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` does that where all characters are ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def stored(frame: DataFrame, name: str, partition_by: tuple[str, ...] = (), compression: str = "snappy") -> DataFrame:
    """Write a stage to the shared folder and read it back: lost executors lose nothing of it."""
    spark = frame.sparkSession
    folder = scratch_folder(spark, name)
    schema = frame.schema
    frame.write.partitionBy(*partition_by).option("compression", compression).parquet(folder)
    spare_driver(spark)
    return spark.read.schema(schema).parquet(folder)


def spare_driver(spark: SparkSession, seconds: float = SPARED_EVERY) -> None:
    """Let the driver give memory back to the system, if it didn't in the last ``seconds``.

    Frames that nothing refers to keep plans, broadcasts and shuffles until both heaps are collected.
    The JVM's heap shrinks with it; what its native code has freed stays with its allocator until told.
    """
    global _spared
    if time.monotonic() < _spared + seconds:
        return
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    release()
    with suppress(Py4JError):  # not every JVM has the command
        trim_native_heap(spark)
    _spared = time.monotonic()


def trim_native_heap(spark: SparkSession) -> str:
    """What the JVM says to its own command for that; the class of its bean server can't be called but by reflection."""
    jvm, new_array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    named = jvm.java.lang.Class.forName
    kinds, values = new_array(jvm.java.lang.Class, 4), new_array(jvm.java.lang.Object, 4)
    for k, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
        kinds[k] = named(kind)
    values[0], values[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    return str(named("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(server, values))


def fit_in_task(sample: DataFrame, fit: Callable[[pa.Table | None], Any]) -> Any:
    """Fit a model in one task, on a sample whose bound the caller states; None stands for no rows.

    The driver gets the model only, and a lost executor costs a new attempt.
    """

    size = PIECE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        yield from in_pieces(fit(pa.Table.from_batches(found) if found else None), size)

    found = received(sample.repartition(1).mapInArrow(run, PIECES))
    return found[0] if found else fit(None)  # an empty plan may have no task


def in_pieces(model: Any, size: int) -> Iterator[pa.RecordBatch]:
    """A model as rows of ``PIECES``, each of ``size`` bytes at most."""
    data = pickle.dumps(model)
    for number, at in enumerate(range(0, len(data), size)):
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([data[at : at + size]], pa.binary())], names=["number", "piece"])


def received(pieces: DataFrame) -> list[Any]:
    """The model that a task gave ``in_pieces``, or nothing if there was no task.

    The driver's JVM holds one piece at a time, its Python the model alone.
    """
    pieces = stored(pieces, "model-pieces")
    with tempfile.TemporaryFile() as file:
        for number in range(n := pieces.count()):
            file.write(pieces.filter(F.col("number") == number).first()["piece"])
        file.seek(0)
        return [pickle.load(file)] if n else []


def within(sizes: list[int], most: int) -> list[bool]:
    """Which of the sizes, one after the other, fit into ``most`` together; one that doesn't is passed over."""
    fits = []
    for size in sizes:
        fits.append(size <= most)
        most -= size if fits[-1] else 0
    return fits


def match(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join by keys of the same names, null equal to null; the keys of the left side stay."""
    if how in ("left_semi", "left_anti"):
        renamed, drop = right.select([F.col(k).alias(f"_r{k}") for k in keys]), []
    else:
        renamed, drop = right.withColumnsRenamed({k: f"_r{k}" for k in keys}), [f"_r{k}" for k in keys]
    condition = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*drop)


def match_hot(left: DataFrame, right: DataFrame, keys: list[str], rows: Column, total: int) -> DataFrame:
    """Inner join where a key may hold a third of ``left``.

    ``right`` has one row for each key, and ``rows``, the number of the key's rows in ``left``, of
    which there are ``total``. The hot keys are at most ``1 / HOT_SHARE``: they are broadcast. The
    others are shuffled, none with more than that share.
    """
    hot = right.filter(rows > total * HOT_SHARE)
    cold = right.filter(~(rows > total * HOT_SHARE))
    return match(left, F.broadcast(hot), keys).unionByName(match(left, cold, keys))


def match_few(left: DataFrame, right: DataFrame, keys: list[str], n_right: int, how: str = "inner") -> DataFrame:
    """Join with a measured side: broadcast within ``BROADCAST_ROWS``, else shuffled with salt.

    Beyond the limit every row of ``right`` is copied to 32 salts, over which a hot key of
    ``left`` is dealt.
    """
    if n_right <= BROADCAST_ROWS:
        return match(left, F.broadcast(right), keys, how)
    salts = F.explode(F.sequence(F.lit(0), F.lit(31)))
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(32)).cast("int"))
    return match(salted, right.withColumn("_salt", salts), [*keys, "_salt"], how).drop("_salt")


def in_fold(ident: str, fold: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder by 5; a null id is in none."""
    return F.coalesce(F.crc32(F.col(ident).cast("string").cast("binary")) % 5 == fold, F.lit(False))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
