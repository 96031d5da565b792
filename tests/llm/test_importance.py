"""Importance resampling against a plain computation in Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from torquelake.llm import importance
from torquelake.llm.importance import Resampling

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, max_n):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = TERM.findall(low)
    return len(words), [" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, rule):
    """``(id, n_features, weight, score, rank)`` by rank; equal keys are told apart by nothing."""
    buckets = lambda features: [zlib.crc32(f.encode()) % rule.buckets for f in features]
    source = Counter(b for _, text in docs for b in buckets(runs(text, rule.max_n)[1]))
    aim = Counter(b for text in target for b in buckets(runs(text, rule.max_n)[1]))
    s_all, t_all = sum(source.values()), sum(aim.values())

    def gain(b):
        return math.floor(1000 * math.log(((aim[b] + 1) * (s_all + rule.buckets)) / ((source[b] + 1) * (t_all + rule.buckets))))

    out = []
    for ident, text in docs:
        n, features = runs(text, rule.max_n)
        weight = sum(map(gain, buckets(features)))
        h = int(hashlib.sha256(f"{rule.seed}:{'null' if ident is None else ident}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((n >= rule.min_words, ident, len(features), weight, score))
    fit = sorted((r for r in out if r[0]), key=lambda r: (-r[4], r[1] is None, r[1] or 0))
    drawn = fit[: rule.num * len(fit) // rule.den]
    ranks = [(*r[1:], k + 1) for k, r in enumerate(drawn)]
    rest = [(*r[1:], None) for r in fit[len(drawn) :] + [r for r in out if not r[0]]]
    return Counter(ranks + rest)


def digest(docs, target, rule, sorted_at_last=importance.SORTED_AT_LAST):
    return Counter(map(tuple, importance.resample_digest(docs, target, rule, sorted_at_last).collect()))


@pytest.mark.parametrize("rule", [Resampling(min_words=2, num=50), Resampling(max_n=3, buckets=70_000, min_words=1, num=33, seed=7)])
def test_edges_match_plain_computation(spark, edge_docs, rule):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    aim = ["w1x w2x w3x shared line", None, "", "two words"]
    target = spark.createDataFrame([(t,) for t in aim], "text string")
    assert digest(edge_docs, target, rule, 1) == plain(rows, aim, rule)


def test_selection_by_rounds_alone(spark):
    """Many partitions, a third of the rows with one id, and pivots down to the last key."""
    docs = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 42).otherwise(F.col("id")).alias("doc_id"),
        F.concat(F.lit("a b c word"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)).alias("text"),
    )
    rule = Resampling(min_words=1, num=41)
    rows = [tuple(r) for r in docs.collect()]
    target = spark.createDataFrame([("word1 word2",)], "text string")
    assert digest(docs.repartition(13), target, rule, 1) == plain(rows, ["word1 word2"], rule)


def test_every_key_can_be_the_cutoff(spark):
    keys = spark.range(40).select(F.expr("id % 4 score"), F.expr("nullif(id % 9, 3) _id"), F.lit(1).cast("long").alias("_h"), F.col("id").alias("_row"))
    keys = keys.repartition(5).cache()
    want = sorted(keys.collect(), key=importance._place)
    for k in (1, 2, 17, 39, 40):
        assert importance.cutoff(keys, k, sorted_at_last=0)["_row"] == want[k - 1]["_row"]
    keys.unpersist()


def test_empty_tables(spark, no_docs, edge_docs):
    none = spark.createDataFrame([], "text string")
    assert importance.resample_digest(no_docs, none).count() == 0
    assert importance.resample(no_docs, none).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert digest(edge_docs, none, Resampling()) == plain(rows, [], Resampling())


def test_drawn_documents_keep_their_columns(spark, edge_docs):
    target = spark.createDataFrame([("shared line",)], "text string")
    rule = Resampling(min_words=1, num=50)
    drawn = importance.resample(edge_docs, target, rule)
    assert drawn.columns == edge_docs.columns
    ranked = importance.resample_digest(edge_docs, target, rule).filter("rank is not null")
    ids = lambda frame: Counter(r[0] for r in frame.select("doc_id").collect())
    assert ids(drawn) == ids(ranked)


def test_string_ids(spark):
    docs = spark.createDataFrame([(f"d{k}", "one two three " * (k % 3)) for k in range(30)], "doc_id string, text string")
    target = spark.createDataFrame([("one",)], "text string")
    found = importance.resample_digest(docs, target, Resampling(min_words=1, num=50), 1).filter("rank is not null").collect()
    assert sorted(r["rank"] for r in found) == list(range(1, 11))
    assert [r["score"] for r in sorted(found, key=lambda r: r["rank"])] == sorted((r["score"] for r in found), reverse=True)
