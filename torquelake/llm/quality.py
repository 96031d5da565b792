"""Quality rules whose cutoffs have a controlled risk.

For each stratum (language) and each measure of a text, labelled documents say which cutoff may
be used: the lowest of a fixed grid for which an exact binomial test shows that it rejects too few
good documents to matter, and which rejects more bad ones than good ones. ``RISK`` is shared by the
measures, and ``ERROR`` by all cutoffs of all strata (Bonferroni): with probability ``1 - ERROR``
no stratum loses more than ``RISK`` of its good documents to these rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torquelake.llm.common import SPACE, WORD, match, match_few, stored

#: Share of good documents that a stratum may lose, and the chance that any loses more.
RISK = 0.03
ERROR = 0.05
#: Measures and the value of each that is the last place of the grid; larger is worse in all.
MEASURES = {"symbols": 1, "repeats": 1, "dup_lines": 1, "short": 1, "word_length": 64, "upper": 1}
#: Places of the grid; they lie closer where the measure is small.
GRID = 64

SYMBOLS = r"[#*$%&|<>]"


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """``doc_id, stratum``, the counts of the contract and the measures, for every row.

    A null text has no words. Without words the shares are 0. A null stratum is one of its own.
    All is done inside the row, without explode or shuffle. For repeats, the hashes of all windows
    of three words are sorted with their places; equal neighbours mark three words each. Texts whose
    windows all differ skip that.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    stratum = F.col(stratum_col) if stratum_col else F.lit("all")
    rows = docs.select(F.col(id_col).alias("doc_id"), stratum.cast("string").alias("stratum"), text.alias("_text"))
    rows = rows.withColumn("_w", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
    rows = rows.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    rows = rows.withColumn("n_words", F.size("_w").cast("bigint"))
    triples = "transform(sequence(0, n_words - 3), i -> xxhash64(_w[i], _w[i + 1], _w[i + 2]))"
    rows = rows.withColumn("_t", F.when(F.col("n_words") >= 3, F.expr(triples)).otherwise(F.expr("array()").cast("array<bigint>")))
    placed = "sort_array(transform(_t, (h, i) -> struct(h, i)))"
    rows = rows.withColumn("_s", F.when(F.size(F.array_distinct("_t")) < F.size("_t"), F.expr(placed)))
    twice = (
        "transform(filter(transform(_s, (x, k) -> struct(x.i AS i, "
        "(k > 0 AND _s[k - 1].h = x.h) OR (k + 1 < size(_s) AND _s[k + 1].h = x.h) AS twice)), x -> x.twice), x -> x.i)"
    )
    rows = rows.withColumn("_at", F.expr(twice))
    covered = "size(array_distinct(flatten(array(_at, transform(_at, i -> i + 1), transform(_at, i -> i + 2)))))"
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    rows = rows.select(
        "doc_id",
        "stratum",
        "n_words",
        F.length(F.array_join("_w", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("_lines").alias("_n_lines"),
        F.regexp_count("_text", F.lit("[A-Z]")).alias("_n_upper"),
        F.when(F.col("_at").isNull(), F.lit(0)).otherwise(F.expr(covered)).cast("bigint").alias("n_repeat_words"),
    )
    return rows.select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ratio("n_symbols", "word_chars").alias("symbols"),
        ratio("n_repeat_words", "n_words").alias("repeats"),
        ratio("n_dup_lines", "_n_lines").alias("dup_lines"),
        (1 / (F.col("n_words") + 1)).alias("short"),
        ratio("word_chars", "n_words").alias("word_length"),
        ratio("_n_upper", "word_chars").alias("upper"),
    )


def places(rows: DataFrame) -> DataFrame:
    """``_at``: measure to place on the grid, 0 to ``GRID``."""
    place = lambda m, top: F.floor(F.sqrt(F.least(F.col(m) / top, F.lit(1.0))) * GRID).cast("int")
    return rows.withColumn("_at", F.array(*[F.struct(F.lit(m).alias("measure"), place(m, top).alias("place")) for m, top in MEASURES.items()]))


def at_most(n: str, k: str, rate: float) -> Column:
    """The probability of ``k`` or fewer of ``n`` at a rate, summed in logarithms term by term."""
    term = f"acc.t + ln(({n} - j + 1D) / j) + ln({rate!r}D / (1 - {rate!r}D))"
    total = f"greatest(acc.s, {term}) + log1p(exp(-abs(acc.s - ({term}))))"
    first = f"{n} * ln(1 - {rate!r}D)"
    ks = f"CASE WHEN {k} > 0 THEN sequence(1L, {k}) ELSE CAST(array() AS array<bigint>) END"
    return F.expr(f"aggregate({ks}, struct({first} AS t, {first} AS s), (acc, j) -> struct({term} AS t, {total} AS s), acc -> exp(acc.s))")


def cutoffs(rows: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``stratum, limits``: measure to the place from which on it rejects.

    ``rows`` are those of ``measured``. Labels without an id or a quality say nothing; where labels
    repeat an id, each counts. A measure without a proven cutoff has no limit, as have all measures
    of a stratum with few labels.
    """
    marked = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").select("doc_id", (F.col("quality") == 1).cast("bigint").alias("_good"))
    held = match(places(rows).select("doc_id", "stratum", "_at"), marked, ["doc_id"]).select("stratum", "_good", F.inline("_at"))
    counted = held.groupBy("stratum", "measure", "place").agg(F.sum("_good").alias("good"), F.sum(1 - F.col("_good")).alias("bad"))
    each = counted.groupBy("stratum", "measure").agg(
        F.sum("good").alias("_n"), F.collect_list(F.struct("place", "good", "bad")).alias("_all"))
    above = lambda field: F.expr(f"aggregate(filter(_all, x -> x.place >= place), 0L, (a, x) -> a + x.{field})")
    tried = each.select("*", F.explode(F.sequence(F.lit(1), F.lit(GRID))).alias("place"))
    tried = tried.select("stratum", "measure", "place", "_n", above("good").alias("_k"), above("bad").alias("_bad"))
    strata = stored(rows.select("stratum").distinct(), "quality-strata").count()
    rate, level = risk / len(MEASURES), error / (max(strata, 1) * len(MEASURES) * GRID)
    allowed = tried.filter(f"_bad > _k AND _k < _n * {rate!r}D").filter(at_most("_n", "_k", rate) <= level)
    lowest = allowed.groupBy("stratum", "measure").agg(F.min("place").alias("place"))
    return lowest.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("measure", "place"))).alias("limits"))


def quality_filter(
    docs: DataFrame,
    labels: DataFrame,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str | None = "lang",
) -> DataFrame:
    """The counts, ``base_failed``, ``kept`` and the measures that rejected, for every row.

    Texts are read once and their measures written. An empty table gives an empty result; without
    labels only the base rules reject. Rows that repeat are judged as often.
    """
    rows = stored(measured(docs, id_col, text_col, stratum_col), "quality-measures")
    limits = stored(cutoffs(rows, labels), "quality-cutoffs")
    judged = match_few(places(rows), limits, ["stratum"], limits.count(), "left")
    reasons = F.expr("transform(filter(_at, x -> coalesce(x.place >= limits[x.measure], false)), x -> x.measure)")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    judged = judged.withColumn("reasons", reasons).withColumn("base_failed", failed)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("reasons") == 0)).alias("kept"), "reasons",
    )
