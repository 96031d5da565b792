"""Benchmark decontamination with a positional inverted index.

The index holds, for every term of the benchmark, where it stands in the training documents:
``_term, _id, _h, _pos``. A window of an item is looked up by its rarest term in the index; each
place of that term proposes a start of the window. The starts are intersected with the places of
the next rarest term, shifted by its offset, and those left with the places of all other terms.
What is left are the exact places of the window; no text is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from torquelake.llm.common import TERM, ascii_lower, identified, match, match_few, stored

DOC = ["_id", "_h"]


def terms(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(TERM), F.lit(0))


def phrase_windows(items: DataFrame, size: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``_window, _item, _terms``: every run of ``size`` terms of an item; a shorter item is one window.

    Items that repeat are one. An item without terms has no window. A null id is written as an
    empty one.
    """
    item = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_item")
    words = items.select(item, terms(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("_all")).filter(F.size("_all") > 0)
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.size("_all") - size, F.lit(0))))
    runs = words.select("_item", "_all", starts.alias("_from"))
    runs = runs.select("_item", F.expr(f"slice(_all, _from + 1, {size})").alias("_terms")).distinct()
    return runs.withColumn("_window", F.xxhash64("_item", "_terms"))


def positional_index(docs: DataFrame, vocabulary: DataFrame, n_vocabulary: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings of the terms of ``vocabulary`` (``_term``), and one row for each document with ``_n_words``.

    Documents are split once. A term of the vocabulary that is on every page is a large list, but
    no task holds it: postings stay in the order in which they are read.
    """
    rows = identified(docs, id_col, text_col).select(*DOC, terms(F.col("_text")).alias("_all"))
    placed = rows.select(*DOC, F.size("_all").alias("_n_words"), F.posexplode_outer("_all").alias("_pos", "_term"))
    known = match_few(placed, vocabulary.withColumn("_known", F.lit(True)), ["_term"], n_vocabulary, "left")
    kept = known.filter("_known OR coalesce(_pos, 0) = 0")
    first = F.coalesce(F.col("_pos"), F.lit(0)) == 0
    return stored(
        kept.select(*DOC, F.when(F.col("_known"), F.col("_term")).alias("_term"), F.coalesce("_pos", F.lit(0)).alias("_pos"),
                    F.when(first, F.col("_n_words")).alias("_n_words")), "positional-index")


def _ranked_terms(windows: DataFrame, index: DataFrame) -> DataFrame:
    """``_window, _len, _term, _offset, _rank``: the terms of each window, rarest in the index first."""
    counts = index.filter("_term IS NOT NULL").groupBy("_term").agg(F.count("*").alias("_count"))
    each = windows.select("_window", F.size("_terms").alias("_len"), F.posexplode("_terms").alias("_offset", "_term")).distinct()
    counted = match(each, counts, ["_term"], "left").withColumn("_count", F.coalesce("_count", F.lit(0)))
    rarest = Window.partitionBy("_window").orderBy("_count", "_term", "_offset")
    return counted.withColumn("_rank", F.row_number().over(rarest))


def phrase_matches(index: DataFrame, windows: DataFrame) -> DataFrame:
    """``_id, _h, _window, _start, _len``: every place where a window stands word for word."""
    postings = index.filter("_term IS NOT NULL").select("_term", *DOC, "_pos")
    ranked = stored(_ranked_terms(windows, index), "window-terms")
    # A window with a term that is nowhere is nowhere.
    nowhere = ranked.filter("_count = 0").select("_window").distinct()
    ranked = match(ranked, nowhere, ["_window"], "left_anti")
    n_terms = ranked.count()
    starts = (F.col("_pos") - F.col("_offset")).alias("_start")

    def proposed(rank: int) -> DataFrame:
        asked = ranked.filter(F.col("_rank") == rank).select("_window", "_len", "_term", "_offset")
        found = match_few(postings, asked, ["_term"], min(n_terms, asked.count()))
        return found.select(*DOC, "_window", "_len", starts).filter("_start >= 0")

    place = [*DOC, "_window", "_start"]
    single = proposed(1).filter("_len = 1")
    pair = match(proposed(1).filter("_len > 1"), proposed(2).select(*place), place, "left_semi")
    pair = stored(pair.distinct(), "window-pairs")
    # Of the other terms only postings in the documents that are left are looked at.
    left = stored(pair.select(*DOC).distinct(), "window-documents")
    inside = match_few(postings, left, DOC, left.count(), "left_semi")
    rest = ranked.filter("_rank > 2").select("_window", "_term", "_offset")
    wanted = match_few(pair.filter("_len > 2"), rest, ["_window"], n_terms)
    wanted = wanted.withColumn("_pos", F.col("_start") + F.col("_offset"))
    seen = match(wanted, inside, ["_term", *DOC, "_pos"], "left_semi")
    full = seen.groupBy(*place, "_len").agg(F.count("*").alias("_seen")).filter("_seen = _len - 2").drop("_seen")
    return single.distinct().unionByName(pair.filter("_len = 2")).unionByName(full)


def proximity_matches(index: DataFrame, pairs: DataFrame, within: int) -> DataFrame:
    """``_id, _h, first, second, _pos``: places of ``first`` with a ``second`` at most ``within`` words behind.

    Places are dealt by document and stretch of ``within`` words, so a frequent pair is no one task.
    """
    postings = index.filter("_term IS NOT NULL").select("_term", *DOC, "_pos")
    n_pairs = pairs.count()
    near = F.expr(f"_pos div {within}")
    a = match_few(postings, pairs.select(F.col("first").alias("_term"), "second"), ["_term"], n_pairs)
    a = a.select(*DOC, "_pos", F.col("_term").alias("first"), "second", F.explode(F.array(near, near + 1)).alias("_cell"))
    b = match(postings, pairs.select(F.col("second").alias("_term")).distinct(), ["_term"], "left_semi")
    b = b.select(*DOC, F.col("_term").alias("second"), F.col("_pos").alias("_at"), near.alias("_cell"))
    joined = match(a, b, [*DOC, "second", "_cell"]).filter(f"_at > _pos AND _at <= _pos + {within}")
    return joined.select(*DOC, "first", "second", "_pos").distinct()


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    size: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, _h, n_words, n_hit, items, contaminated`` for every row of ``docs``; ``_h`` is the text's hash.

    ``n_hit`` counts the words inside any place of a window, each once; ``items`` are the ids of the
    items found, as sorted strings. A null or empty text has no words. Rows that repeat id and text
    get the same answer. Without documents the result is empty, without items nothing is hit.
    """
    windows = stored(phrase_windows(items, size, item_id_col, item_text_col), "benchmark-windows")
    vocabulary = stored(windows.select(F.explode("_terms").alias("_term")).distinct(), "benchmark-terms")
    index = positional_index(docs, vocabulary, vocabulary.count(), id_col, text_col)
    found = stored(phrase_matches(index, windows), "window-places")

    # Places of all windows of a document in order: each adds what lies behind the furthest end so far.
    so_far = Window.partitionBy(*DOC).orderBy("_start", "_end").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.select(*DOC, "_start", (F.col("_start") + F.col("_len")).alias("_end")).distinct()
    spans = spans.withColumn("_reach", F.coalesce(F.max("_end").over(so_far), F.lit(0)))
    new = F.greatest(F.col("_end") - F.greatest("_start", "_reach"), F.lit(0))
    hit = spans.groupBy(*DOC).agg(F.sum(new).alias("n_hit"))
    named = match_few(found.select(*DOC, "_window").distinct(), windows.select("_window", "_item"), ["_window"], windows.count())
    named = named.select(*DOC, "_item").distinct().groupBy(*DOC).agg(F.array_sort(F.collect_list("_item")).alias("items"))

    rows = index.filter("_n_words IS NOT NULL").select(*DOC, "_n_words")
    rows = match(match(rows, hit, DOC, "left"), named, DOC, "left")
    return rows.select(
        F.col("_id").alias("doc_id"),
        "_h",
        F.col("_n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of an item stands."""
    found = decontaminate(docs, items, size, id_col, text_col).filter("contaminated")
    gone = stored(found.select(F.col("doc_id").alias("_id"), "_h").distinct(), "contaminated")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keys = docs.withColumns({"_id": F.col(id_col), "_h": F.xxhash64(text)})
    return match_few(keys, gone, DOC, gone.count(), "left_anti").select(docs.columns)


def contamination_digest(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    rows = decontaminate(docs, items, size)
    joined = F.sha2(F.concat_ws(",", "items"), 256)
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), joined.alias("items_sha256"), "contaminated")
