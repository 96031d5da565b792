"""Importance resampling towards a target distribution, by hashed word runs and an exact cutoff.

A text's features are its runs of ``1..max_n`` consecutive words, hashed into buckets. Every bucket
has a gain, the scaled log ratio of its share in the target to its share in the documents, held
in one array; a document's weight is the sum of its features' gains. With Gumbel noise from
the id added, the documents with the highest scores are a draw without replacement in proportion to
exp(weight / 1000).

The cutoff is found without sorting everything. In every round each partition gives the median key
of what is left in it on either side of the last pivot. The median of these, weighted by how many
rows are left, is the next pivot: at least about a quarter of the rows lies on either side of it, so
a round discards that share. A last few rows are sorted, and so are the winners.

Keys are ordered by falling score, then rising id (null last), text hash and row, so there are no ties.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from torquelake.llm.common import identified, match, match_few, stored

#: Rows of a task are numbered from its partition's number times this on.
ROWS_A_PART = 1 << 33
#: Keys that are sorted together once no more are left.
SORTED_AT_LAST = 10_000

# A-Z become a-z; ASCII characters that are neither letters nor digits part words.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


@dataclass(frozen=True)
class Resampling:
    """Longest word run, number of buckets, seed of the noise; of the documents with ``min_words`` words ``num / den`` are drawn."""

    max_n: int = 1
    buckets: int = 10_000
    seed: int = 2024
    min_words: int = 20
    num: int = 10
    den: int = 100

    @property
    def dtype(self) -> np.dtype:
        return np.dtype("<u2" if self.buckets <= 65_536 else "<u4")


def run_buckets(text: bytes, rule: Resampling) -> tuple[int, np.ndarray]:
    """Number of words of a text in UTF-8, and the bucket of each of its word runs."""
    words = text.translate(_WORDS).split()
    runs = list(map(zlib.crc32, words))
    found = runs.copy()
    for n in range(2, rule.max_n + 1):  # crc32 goes on from that of the run shorter by a word
        spaced = [zlib.crc32(b" ", c) for c in runs[: len(words) - n + 1]]
        runs = list(map(zlib.crc32, words[n - 1 :], spaced))
        found += runs
    return len(words), (np.array(found, dtype=np.int64) % rule.buckets).astype(rule.dtype)


def hashed_features(docs: DataFrame, rule: Resampling, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_row, _id, _h, n_words, n_features, buckets`` (an array's bytes) of every row; a null text has none."""
    rows = identified(docs, id_col, text_col).select("_id", "_h", F.col("_text").cast("binary").alias("_text"))
    fields = [("_row", T.LongType()), ("_id", rows.schema["_id"].dataType), ("_h", T.LongType())]
    fields += [("n_words", T.LongType()), ("n_features", T.LongType()), ("buckets", T.BinaryType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() * ROWS_A_PART
        for batch in batches:
            found = [run_buckets(t.as_py(), rule) for t in batch.column(2)]
            columns = [
                pa.array(np.arange(row, row + len(found), dtype=np.int64)),
                batch.column(0),
                batch.column(1),
                pa.array([n for n, _ in found], pa.int64()),
                pa.array([len(b) for _, b in found], pa.int64()),
                pa.array([b.tobytes() for _, b in found], pa.binary()),
            ]
            row += len(found)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(hashed, schema)


def bucket_counts(features: DataFrame, rule: Resampling) -> np.ndarray:
    """How many features of all rows fall into each bucket; tasks count before the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(rule.buckets, dtype=np.int64)
        for batch in batches:
            found = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=rule.dtype)
            counts += np.bincount(found, minlength=rule.buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["bucket", "n"])

    sums = features.select("buckets").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(rule.buckets, dtype=np.int64)
    for bucket, n in sums.collect():  # at most one row for each bucket
        out[bucket] = n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket: thousandths of the log of its smoothed share in the target over that in the source."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    ratio = [
        (float(t + 1) * float(s_all + n)) / (float(s + 1) * float(t_all + n))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)
    ]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def score_documents(
    docs: DataFrame, target: DataFrame, rule: Resampling, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text"
) -> DataFrame:
    """``_row, _id, _h, n_words, n_features, weight, score`` of every row, written to the shared folder.

    A null or empty text has no features and weight 0; it is scored like any other. The noise depends on
    seed and id alone, so rows that repeat an id share it; a null id counts as the text ``null``. With
    an empty target, or an empty table, the gains come from what there is.
    """
    features = stored(hashed_features(docs, rule, id_col, text_col), "importance-features")
    aim = hashed_features(target.select(F.lit(0).alias("_none"), target_text), rule, "_none", target_text)
    gains = bucket_gains(bucket_counts(features, rule), bucket_counts(aim, rule))

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(np.array(batch.column("n_features").to_pylist(), dtype=np.int64))
            found = np.frombuffer(b"".join(batch.column("buckets").to_pylist()), dtype=rule.dtype)
            sums = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(gains[found])])
            weights = np.diff(sums[np.concatenate([np.zeros(1, dtype=np.int64), ends])])
            kept = [batch.column(n) for n in names[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(weights)], names=names)

    names = ["_row", "_id", "_h", "n_words", "n_features", "weight"]
    schema = T.StructType([*features.schema.fields[:5], T.StructField("weight", T.LongType())])
    key = F.concat(F.lit(f"{rule.seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = features.mapInArrow(weighed, schema).withColumn("score", F.col("weight") + noise)
    return stored(scored, "importance-scores")


KEYS = ["score", "_id", "_h", "_row"]


def in_order() -> list[Column]:
    return [F.col("score").desc(), F.col("_id").asc_nulls_last(), F.col("_h").asc(), F.col("_row").asc()]


def not_after(cut: Row, id_type: T.DataType) -> Column:
    """Whether a row's key is the given one or comes before it."""
    known = F.lit(cut["_id"]).cast(id_type)
    steps = [
        (F.col("score") > cut["score"], F.col("score") == cut["score"]),
        (F.col("_id").isNotNull() & (known.isNull() | (F.col("_id") < known)), F.col("_id").eqNullSafe(known)),
        (F.col("_h") < cut["_h"], F.col("_h") == cut["_h"]),
        (F.col("_row") < cut["_row"], F.col("_row") == cut["_row"]),
    ]
    lower = [F.coalesce(reduce(Column.__and__, [same for _, same in steps[:k]], less), F.lit(False)) for k, (less, _) in enumerate(steps)]
    same = reduce(Column.__and__, [same for _, same in steps])
    return reduce(Column.__or__, lower, same)


def _place(row: Row) -> tuple:
    return -row["score"], (1,) if row["_id"] is None else (0, row["_id"]), row["_h"], row["_row"]


def partition_medians(keys: DataFrame) -> list[Row]:
    """For both values of ``first``, ``n`` and the median key of what each partition holds; two rows a partition."""
    schema = T.StructType([T.StructField("first", T.BooleanType()), T.StructField("n", T.LongType()), *keys.select(*KEYS).schema.fields])
    order = [("score", "descending"), ("_id", "ascending"), ("_h", "ascending"), ("_row", "ascending")]

    def medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        for first in (True, False):
            side = table.filter(pc.equal(table["first"], first)).select(KEYS)
            if side.num_rows:
                at = pc.sort_indices(side, sort_keys=order, null_placement="at_end")[(side.num_rows - 1) // 2].as_py()
                middle = side.slice(at, 1).combine_chunks()
                counted = [pa.array([first]), pa.array([side.num_rows], pa.int64()), *(middle[k].combine_chunks() for k in KEYS)]
                yield pa.RecordBatch.from_arrays(counted, names=schema.names)

    return keys.select("first", *KEYS).mapInArrow(medians, schema).collect()


def weighted_median(medians: list[Row]) -> Row:
    """The key up to which half of the rows behind the partitions' medians lie."""
    ordered = sorted(medians, key=_place)
    half, below = sum(m["n"] for m in ordered) / 2, 0
    for m in ordered:
        below += m["n"]
        if below >= half:
            return m
    raise ValueError("no medians")


def cutoff(keys: DataFrame, k: int, sorted_at_last: int = SORTED_AT_LAST) -> Row | None:
    """The ``k``-th key in order among written rows; None if ``k`` is 0.

    The driver gets two rows a partition and round, and at most ``sorted_at_last`` keys in the end.
    """
    if k <= 0:
        return None
    id_type = keys.schema["_id"].dataType
    left, pivot = keys, None
    while True:
        side = F.lit(True) if pivot is None else not_after(pivot, id_type)
        medians = partition_medians(left.withColumn("first", side))
        if pivot is not None:
            first = [m for m in medians if m["first"]]
            n_first = sum(m["n"] for m in first)
            into = k <= n_first
            left = left.filter(not_after(pivot, id_type) if into else ~not_after(pivot, id_type))
            medians = first if into else [m for m in medians if not m["first"]]
            k -= 0 if into else n_first
        if sum(m["n"] for m in medians) <= sorted_at_last:
            return left.select(*KEYS).orderBy(*in_order()).limit(k).collect()[-1]
        pivot = weighted_median(medians)
        if sum(m["n"] for m in medians) == 1:
            return pivot


def ranked(winners: DataFrame, name: str = "importance-winners") -> DataFrame:
    """The rows with ``rank`` 1, 2, 3... in order: sorted by ranges, which are counted and laid end to end."""
    ordered = winners.repartitionByRange(*in_order()).sortWithinPartitions(*in_order())
    ordered = stored(ordered.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    parts = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    placed = match_few(ordered.withColumn("_part", part), parts.select("_part", before.alias("_before")), ["_part"], parts.count())
    rank = F.col("_before") + F.col("_at") - F.col("_part") * ROWS_A_PART + 1
    return placed.withColumn("rank", rank).drop("_at", "_part", "_before")


def draw(scored: DataFrame, rule: Resampling, sorted_at_last: int = SORTED_AT_LAST) -> tuple[DataFrame, DataFrame]:
    """Drawn rows with their rank, and all others. Rows with fewer than ``min_words`` words can't be drawn.

    Of rows that repeat id and text, as many are drawn as come before the cutoff.
    """
    fit = scored.filter(F.col("n_words") >= rule.min_words)
    cut = cutoff(fit, rule.num * fit.count() // rule.den, sorted_at_last)
    if cut is None:
        return scored.limit(0).withColumn("rank", F.lit(0).cast("long")), scored
    won = (F.col("n_words") >= rule.min_words) & not_after(cut, scored.schema["_id"].dataType)
    return ranked(scored.filter(won)), scored.filter(~won)


def resample(
    docs: DataFrame, target: DataFrame, rule: Resampling = Resampling(), id_col: str = "doc_id", text_col: str = "text", target_text: str = "text"
) -> DataFrame:
    """The drawn documents, with all their columns.

    Rows with equal id and text have one score; if the cutoff falls between them, any as many as were
    drawn are kept. Empty tables give none.
    """
    won, _ = draw(score_documents(docs, target, rule, id_col, text_col, target_text), rule)
    copies = won.groupBy("_id", "_h").agg(F.count(F.lit(1)).alias("_drawn"))
    last = won.orderBy(F.col("rank").desc()).select("_id", "_h").limit(1)
    cut = match(copies, F.broadcast(last), ["_id", "_h"])
    own = docs.withColumns({"_id": F.col(id_col), "_h": F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))})
    whole = match(own, match(won.select("_id", "_h").distinct(), F.broadcast(last), ["_id", "_h"], "left_anti"), ["_id", "_h"], "left_semi")
    drawn = cut.first()
    n = drawn["_drawn"] if drawn else 0
    partly = match(own, F.broadcast(last), ["_id", "_h"], "left_semi").limit(n)
    return whole.unionByName(partly).select(*docs.columns)


def resample_digest(docs: DataFrame, target: DataFrame, rule: Resampling = Resampling(), sorted_at_last: int = SORTED_AT_LAST) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; the rank of one that is not drawn is null."""
    won, lost = draw(score_documents(docs, target, rule), rule, sorted_at_last)
    both = won.unionByName(lost.withColumn("rank", F.lit(None).cast("long")))
    return both.select(F.col("_id").alias("doc_id"), "n_features", "weight", "score", "rank")
