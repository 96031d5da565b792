"""Mixing sources to target weights by Pareto order sampling.

A source gets a target in words by its weight. Its documents are wanted ``target / size`` times
each: the whole part are certain copies, the rest is the probability of one more. These odds
rank the documents: ``q = (u / (1 - u)) / (p / (1 - p))`` with a random ``u`` for each, and the
lowest are taken until the words that are left to the target are reached.

No source is ever in one task. The place where the taking ends is found by counting words in
buckets of ``log2 q``, then in parts of the bucket where it ends, and only documents in that part
(about one in a million) are put in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from torquelake.llm.common import HOT_SHARE, WORD, match, match_few, stored

#: Buckets in a unit of log2 q, and parts of a bucket.
FINE, FINER = 64, 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def random_unit(seed: int, ident: Column, text_md5: Column, number: Column) -> Column:
    """A number between 0 and 1 from the first 52 bits of a hash; the same in every run.

    It depends on the id, the text and the number within rows that repeat both, so rows without an
    id, or with one id, do not tie.
    """
    ident = F.coalesce(ident.cast("string"), F.lit("null"))
    text = F.concat_ws(":", F.lit(str(seed)), ident, text_md5, number.cast("string"))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def numbered(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` with ``_n``, their number from 1 within equal ``keys``.

    Rows are written with the partition they come from and numbered within key and partition. Such a
    part starts where those of the same key before it end. A key with a third of all rows is so
    dealt over as many tasks as the input has, and a part never grows beyond a partition.
    """
    rows = stored(rows.withColumn("_part", F.spark_partition_id()), name)
    parts = rows.groupBy(*keys, "_part").agg(F.count("*").alias("_rows_here"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(*keys, "_part", F.sum("_rows_here").over(before).alias("_before")).filter("_before > 0")
    starts = stored(starts, f"{name}-starts")
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy("_part")).cast("bigint"))
    if not starts.isEmpty():
        rows = match(rows, starts, [*keys, "_part"], "left")
        rows = rows.withColumn("_n", F.col("_n") + F.coalesce("_before", F.lit(0))).drop("_before")
    return rows.drop("_part")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Target words of each source from ``source, source_size``.

    Sources by code point, null last, take the weights in turn and share all words by them. No
    target is above ``most`` times its source; what is over is shared by the others. Sources are
    ordered by size for a unit of weight: those that are full come first. There is one row for
    each source here, not for each document.
    """
    names = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(names) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), place + 1)
    full = (F.col("source_size") * most).alias("_cap")
    rows = sources.withColumn("_weight", weight).select("*", full)
    by_fill = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.select(
        "*",
        F.row_number().over(by_fill).alias("_n"),
        (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("_cap").over(before), F.lit(0))).alias("_left"),
        F.sum("_weight").over(after).alias("_weights"),
    )
    is_full = F.col("_cap") * F.col("_weights") <= F.col("_left") * F.col("_weight")
    first_open = F.min(F.when(~is_full, F.struct("_n", "_left", "_weights"))).over(Window.partitionBy())
    rows = rows.select("*", is_full.alias("_full"), first_open.alias("_open"))
    words = F.col("_weight") * F.col("_open._left")
    share = words.cast("double") / F.col("_open._weights").cast("double")
    copies = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(
        F.expr("(_weight * _open._left) div (_open._weights * source_size)")
    )
    return rows.select(
        "source",
        "source_size",
        F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(share).alias("target"),
        F.when(F.col("_full"), F.lit(most)).otherwise(copies).cast("bigint").alias("_certain"),
    )


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    seed: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How often each document is taken.

    Returns ``doc_id, source, size`` (words; null text: 0), ``source_size, target, copies, taken``
    (``copies * size``), ``_h``, the text's hash, and ``_n``, the number within rows that repeat id,
    text and source, for every row. Taking in order ends before the target would be passed; then
    the document whose size is nearest to what is missing is added, if that brings the source
    closer. A source without words has target 0 and no copies. Null is an id like any other; rows
    that repeat id and text are drawn one by one. An empty table gives an empty result; columns of
    other names are left out.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text).alias("_h"),
        F.substring(F.md5(text), 1, 16).alias("_m"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
    )
    rows = numbered(rows, ["doc_id", "_h", "_m", "source"], "mix-sizes")
    rows = stored(rows.withColumn("_u", random_unit(seed, F.col("doc_id"), F.col("_m"), F.col("_n"))), "mix-odds")
    sources = stored(
        source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "mix-targets"
    )
    n_sources = sources.count()
    few = lambda frame, side: match_few(frame, side, ["source"], n_sources, "left")

    odds = F.col("target") / F.col("source_size") - F.col("_certain")
    rows = few(rows, sources).withColumn("_p", F.when(F.col("source_size") > 0, odds).otherwise(F.lit(0.0)))
    q = (F.col("_u") / (1 - F.col("_u"))) / (F.col("_p") / (1 - F.col("_p")))
    rows = rows.withColumn("_q", F.when(F.col("_p") > 0, q))
    level = (F.log2("_q") + 64) * FINE
    rows = rows.withColumn("_b", F.floor(level)).withColumn("_f", F.floor((level - F.floor(level)) * FINER))
    ranked = rows.filter("_q IS NOT NULL")

    missing = sources.withColumn("_rest", F.col("target") - F.col("_certain") * F.col("source_size"))
    coarse = _end(ranked, missing.select("source", "_rest"), "_b", few)
    inside = few(ranked, coarse).filter("_b = _end_b")
    fine = _end(inside, coarse.select("source", F.col("_rest_b").alias("_rest")), "_f", few)
    ends = stored(coarse.drop("_rest_b").join(fine, coarse["source"].eqNullSafe(fine["source"]), "left").drop(fine["source"]), "mix-ends")

    rows = few(rows, ends)
    in_order = Window.partitionBy("source").orderBy("_q", F.col("doc_id").asc_nulls_first(), "_m", "_n")
    last = rows.filter("_q IS NOT NULL AND _b = _end_b AND _f = _end_f")
    last = last.withColumn("_sum", F.sum("size").over(in_order)).withColumn("_in", F.col("_sum") <= F.col("_rest_f"))
    others = rows.filter("NOT (_q IS NOT NULL AND _b = _end_b AND _f = _end_f) OR _q IS NULL OR _end_b IS NULL OR _end_f IS NULL")
    # Without an end all that are ranked fit.
    before = F.expr("_q IS NOT NULL AND (_end_b IS NULL OR _b < _end_b OR (_b = _end_b AND (_end_f IS NULL OR _f < _end_f)))")
    drawn = stored(others.withColumn("_in", before).unionByName(last.drop("_sum")).select(
        "doc_id", "_h", "_m", "_n", "source", "size", "source_size", "target", "_certain", "_p", "_in"), "mix-drawn")

    got = drawn.groupBy("source").agg(F.sum((F.col("_certain") + F.col("_in").cast("bigint")) * F.col("size")).alias("_got"))
    drawn = few(drawn, got)
    gap = F.col("target") - F.col("_got")
    one = F.struct(F.abs(gap - F.col("size")).alias("off"), F.col("size"), F.col("doc_id").alias("id"), "_m", "_n", gap.alias("gap"))
    nearest = drawn.filter("NOT _in AND _p > 0 AND size > 0").groupBy("source").agg(F.min(one).alias("_near"))
    drawn = few(drawn, nearest)
    same = "size = _near.size AND doc_id <=> _near.id AND _m = _near._m AND _n = _near._n"
    added = F.expr(f"NOT _in AND _p > 0 AND _near.off < _near.gap AND {same}")
    copies = F.col("_certain") + (F.col("_in") | F.coalesce(added, F.lit(False))).cast("bigint")
    return drawn.select("doc_id", "_h", "_n", "source", "size", "source_size", "target", copies.alias("copies")).withColumn(
        "taken", F.col("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 20) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their columns.

    Rows that repeat id, text and source are told apart by number; which of them has which number is
    not fixed where they differ in other columns. An empty table gives an empty result.
    """
    keys = ["_id", "_h", "_source"]
    copies = mix_sources(docs, weights, most, seed).select(
        F.col("doc_id").alias("_id"), "_h", F.col("source").alias("_source"), "_n", F.col("copies").alias("_copies"))
    copies = stored(copies, "mix-copies")
    alike = stored(copies.groupBy(*keys).agg(F.count("*").alias("_rows"), F.sum("_copies").alias("_all")).filter("_all > 0"), "mix-alike")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumns({"_id": F.col("doc_id"), "_h": F.xxhash64(text), "_source": F.col("source")})

    hot = F.col("_rows") > F.lit(copies.count() * HOT_SHARE) + 1
    repeated = []
    if not alike.filter(hot).isEmpty():
        marked = match(keyed, F.broadcast(alike.filter(hot).drop("_all")), keys, "left")
        repeated.append(marked.filter("_rows IS NOT NULL").drop("_rows"))
        keyed = marked.filter("_rows IS NULL").drop("_rows")
    taken = [match(keyed, alike.filter("_rows = 1").select(*keys, F.col("_all").alias("_copies")), keys)]
    some = alike.filter(~hot).filter("_rows > 1")
    if not some.isEmpty():
        repeated.append(match(keyed, some.select(*keys), keys))
    if repeated:
        rows = numbered(reduce(DataFrame.unionByName, repeated), keys, "mix-repeats")
        taken.append(match(rows, copies.filter("_copies > 0"), [*keys, "_n"]).drop("_n"))
    out = reduce(DataFrame.unionByName, taken)
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(docs.columns)


def _end(ranked: DataFrame, rest: DataFrame, bucket: str, few) -> DataFrame:
    """For each source the bucket where the words of ``_rest`` end and what is left for it there."""
    counted = ranked.groupBy("source", bucket).agg(F.sum("size").alias("_words"))
    so_far = Window.partitionBy("source").orderBy(bucket)
    counted = few(counted, rest).withColumn("_sum", F.sum("_words").over(so_far)).filter(F.col("_sum") > F.col("_rest"))
    first = counted.groupBy("source").agg(F.min(F.struct(bucket, (F.col("_rest") - (F.col("_sum") - F.col("_words"))).alias("left"))).alias("_first"))
    return first.select("source", F.col(f"_first.{bucket}").alias(f"_end{bucket}"), F.col("_first.left").alias(f"_rest{bucket}"))
