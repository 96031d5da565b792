"""Token files: ids by frequency rank, one to four bytes each, with the lengths in control bytes.

A file is a Parquet part of chunks. A chunk holds whole documents, in ascending order of their
ids, with about ``CHUNK`` tokens:

* ``ranks``: token ids by falling frequency in the chunk, 32 bits each;
* ``data``: for each token the bytes of its rank, lowest first, without leading zeros;
* ``control``: two bits for each token, its number of bytes less one, four tokens to a byte;
* ``doc_ids``, ``lengths``: the documents and their numbers of tokens;
* ``part``, ``chunk``, ``before``: place of the file, of the chunk in it, and tokens of the file before.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from torquelake.config import scratch_folder, session_options
from torquelake.llm.common import identified, match_few
from torquelake.llm.subwords import encoder, release

CHUNK = 1_000_000
#: Texts that come to a task at a time.
ROWS_AT_ONCE = 2000
#: For each control byte the lengths of its four tokens.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def pack(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """``ranks, control, data`` of token ids."""
    counts = np.bincount(ids)
    values = np.flatnonzero(counts)
    values = values[np.argsort(-counts[values], kind="stable")]
    rank_of = np.zeros(len(counts), dtype="<u4")
    rank_of[values] = np.arange(len(values), dtype="<u4")
    ranks = rank_of[ids]
    codes = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    used = np.arange(4) <= codes[:, None]
    data = ranks.view(np.uint8).reshape(-1, 4)[used]
    four = np.pad(codes, (0, -len(codes) % 4)).reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    return values.astype("<u4").tobytes(), control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(ranks: bytes, control: bytes, data: bytes, n: int) -> np.ndarray:
    """The token ids again: lengths by table, then all tokens of a length at once."""
    lengths = LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:n]
    places = np.cumsum(lengths, dtype=np.int64) - lengths
    raw = np.frombuffer(data, dtype=np.uint8)
    out = raw[places].astype(np.uint32) if n else np.zeros(0, dtype=np.uint32)
    for k in range(1, 4):
        longer = np.flatnonzero(lengths > k)
        out[longer] |= raw[places[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return np.frombuffer(ranks, dtype="<u4")[out]


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode whole texts (null: empty), each with ``end_id`` behind it, and write the files.

    Documents are ordered by id (null first), equal ids by a hash of the text; rows that repeat
    are written as often. An empty table gives files without chunks.
    """
    rows = identified(docs, id_col, text_col)
    id_type = rows.schema["_id"].dataType
    ordered = rows.repartitionByRange(F.col("_id").asc_nulls_first()).sortWithinPartitions(F.col("_id").asc_nulls_first(), "_h")
    schema = T.StructType(
        [T.StructField(n, t) for n, t in (
            ("part", T.IntegerType()), ("chunk", T.IntegerType()), ("before", T.LongType()), ("n_tokens", T.LongType()),
            ("doc_ids", T.ArrayType(id_type)), ("lengths", T.ArrayType(T.LongType())),
            ("ranks", T.BinaryType()), ("control", T.BinaryType()), ("data", T.BinaryType()),
        )]
    )

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()  # what the stages before have left in this worker
        codec = encoder(tokenizer)
        end = np.array([end_id], dtype=codec.dtype).tobytes()
        part, number, before = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        texts: list[bytes] = []
        size, id_kind = 0, None

        def chunk() -> pa.RecordBatch:
            lengths = [len(t) // codec.dtype.itemsize for t in texts]
            packed = pack(np.frombuffer(b"".join(texts), dtype=codec.dtype))
            columns = [[part], [number], [before], [sum(lengths)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)]
                + [pa.array([ids], pa.list_(id_kind)), pa.array([lengths], pa.list_(pa.int64()))]
                + [pa.array([x], pa.binary()) for x in packed],
                names=schema.names,
            )

        for batch in batches:
            id_kind = batch.schema.field(0).type
            encoded = codec.encode(batch.column(1).to_pylist(), special=True)
            for doc, text in zip(batch.column(0).to_pylist(), encoded, strict=True):
                ids.append(doc)
                texts.append(text + end)
                size += len(texts[-1]) // codec.dtype.itemsize
                if size >= CHUNK:
                    yield chunk()
                    release()
                    number, before, size, ids, texts = number + 1, before + size, 0, [], []
        if ids:
            yield chunk()

    with session_options(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(ROWS_AT_ONCE)}):
        ordered.select("_id", "_text").mapInArrow(chunks, schema).write.parquet(folder)


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """The documents of token files: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``.

    ``start`` counts the tokens of all documents before. Chunks are decoded where they are; only the
    sums of the files (one row each) are added up in one place.
    """
    chunks = spark.read.parquet(folder)
    id_type = chunks.schema["doc_ids"].dataType.elementType
    fields = [("part", T.IntegerType()), ("doc_id", id_type), ("_start", T.LongType()), ("n_tokens", T.LongType()), ("ids_crc32", T.LongType())]
    fields += [("ids", T.ArrayType(T.LongType()))] * with_ids
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k] for n in batch.schema.names}
                lengths = np.asarray(row["lengths"].values.to_numpy(zero_copy_only=False), dtype=np.int64)
                ids = unpack(*(row[n].as_py() for n in ("ranks", "control", "data")), int(lengths.sum())).astype("<u4")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                view = memoryview(ids.tobytes())
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [
                    pa.array(np.full(len(lengths), row["part"].as_py(), dtype=np.int32)),
                    row["doc_ids"].values,
                    pa.array(starts + row["before"].as_py()),
                    pa.array(lengths),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1:]).astype(np.int32)), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    sums = chunks.groupBy("part").agg(F.sum("n_tokens").alias("_sum"))
    before = F.sum("_sum").over(Window.orderBy("part")) - F.col("_sum")
    rows = chunks.drop("chunk", "n_tokens").mapInArrow(decoded, schema)
    placed = match_few(rows, sums.select("part", before.alias("_before")), ["part"], sums.count(), "left")
    out = ["doc_id", (F.col("_before") + F.col("_start")).alias("start"), "n_tokens", "ids_crc32"]
    return placed.select(*out, *["ids"] * with_ids)


def token_digest(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the files to the shared folder, read them back, and return a row for each document."""
    folder = scratch_folder(docs.sparkSession, "token-files")
    write_token_files(docs, folder, tokenizer, end_id)
    return read_token_files(docs.sparkSession, folder, with_ids=False)
