"""Line dedup over sorted hashes: which lines of each document are repeated, as bitmaps.

Every line becomes a 128-bit hash of its key with its document and position. These rows are
range-partitioned by hash and document and sorted by hash, document and position, so a line that
is in a third of all documents is spread over many ranges. A stream over each range marks the first
occurrence of a hash in a document; hashes are counted from those marks, combined before they are
shuffled. Decisions come back as one bitmap for each document, 64 lines a word, without words that
have no bit set. Texts are read for splitting and, by ``apply_bitmaps``, for the lines that stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from torquelake.llm.common import SPACE, ascii_lower, identified, match, match_hot, stored

LINE_KEYS = ["_h1", "_h2"]
DOC_KEYS = ["_id", "_h"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def line_occurrences(docs: DataFrame, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The sorted occurrences: ``_h1, _h2, _id, _h, _pos`` and ``_first``, 1 once for each document."""
    lines = identified(docs, id_col, text_col).select(*DOC_KEYS, F.posexplode(F.split("_text", "\n")).alias("_pos", "_line"))
    keyed = lines.select(*DOC_KEYS, "_pos", line_key(F.col("_line")).alias("_key")).filter(F.length("_key") >= min_chars)
    hashes = [F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(7), "_key").alias("_h2")]
    # Written before it is sampled for ranges, so that the texts are split once.
    occurrences = stored(keyed.select(*hashes, *DOC_KEYS, "_pos"), "line-hashes")
    order = [*LINE_KEYS, *DOC_KEYS]
    ranged = occurrences.repartitionByRange(*order).sortWithinPartitions(*order, "_pos")
    nth = F.row_number().over(Window.partitionBy(*order).orderBy("_pos"))
    return stored(ranged.withColumn("_first", (nth == 1).cast("int")), "line-occurrences")


def repeated_lines(occurrences: DataFrame, min_docs: int = 2, keep: str = "first") -> DataFrame:
    """Occurrences to drop: of keys in ``min_docs`` documents or more, all or all but the first.

    The first occurrence is the one of the lowest document id (null first) and line.
    """
    first = F.min(F.struct(*DOC_KEYS, "_pos"))
    counted = occurrences.groupBy(*LINE_KEYS).agg(F.sum("_first").alias("_docs"), F.count("*").alias("_rows"), first.alias("_start"))
    if keep == "none":
        counted = counted.drop("_start")
    often = stored(counted.filter(F.col("_docs") >= min_docs), "line-repeats")
    rows = match_hot(occurrences, often, LINE_KEYS, F.col("_rows"), occurrences.count())
    if keep == "first":
        rows = rows.filter(~F.struct(*DOC_KEYS, "_pos").eqNullSafe(F.col("_start")))
    return rows.select(*DOC_KEYS, "_pos")


def drop_bitmaps(dropped: DataFrame) -> DataFrame:
    """One row for each document with drops: ``bitmap``, map of word number to 64 bits, set where a line goes."""
    bit = F.expr("shiftleft(1L, _pos % 64)")
    words = dropped.groupBy(*DOC_KEYS, F.expr("_pos div 64").alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    return words.groupBy(*DOC_KEYS).agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("bitmap"))


def line_dedup(
    docs: DataFrame,
    min_docs: int = 2,
    keep: str = "first",
    min_chars: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``_id, _h, bitmap`` of the documents that lose lines.

    A line is compared without white space at its ends and with A-Z lower-cased; lines shorter
    than ``min_chars`` then are never dropped. A null or empty text is one empty line. Rows that
    repeat id and text count as one document. An empty table gives an empty result.
    """
    return drop_bitmaps(repeated_lines(line_occurrences(docs, min_chars, id_col, text_col), min_docs, keep))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` for every row of ``docs``; ``kept`` is the text that stays."""
    rows = match(identified(docs, id_col, text_col), bitmaps, DOC_KEYS, "left")
    stays = "(shiftright(coalesce(element_at(bitmap, CAST(i div 64 AS BIGINT)), 0L), i % 64) & 1L) = 0L"
    lines = F.split("_text", "\n")
    return rows.select(
        F.col("_id").alias("doc_id"),
        F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.expr("aggregate(map_values(bitmap), 0L, (a, x) -> a + bit_count(x))"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("bitmap").isNull(), F.col("_text"))
        .otherwise(F.expr(f"array_join(filter(split(_text, '\\n'), (x, i) -> {stays}), '\\n')"))
        .alias("kept"),
    )


def dedup_digest(docs: DataFrame, min_docs: int, keep: str, min_chars: int) -> DataFrame:
    kept = apply_bitmaps(docs, line_dedup(docs, min_docs, keep, min_chars))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
