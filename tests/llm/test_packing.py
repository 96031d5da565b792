"""Sequence packing: the search against the best packing, and packed pieces against the tokenizer."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import MEDIUM
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from torquelake.llm import packing
from torquelake.llm.packing import Sequences, best_fit, complete_bins, completions, least_sequences
from torquelake.llm.queries import registered_queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def fewest(items, capacity):
    """Fewest sequences by trying every place for every piece."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins) if b + items[i] <= capacity}.values():
            bins[k] += items[i]
            go(i + 1, bins)
            bins[k] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def check_uses(uses, counts, capacity):
    total = np.zeros(capacity + 1, dtype=int)
    for filling, times in uses:
        assert times > 0 and sum(n * each for n, each in filling) <= capacity
        for length, each in filling:
            total[length] += each * times
    assert (total == counts).all()


def test_search_finds_the_best_packing():
    pick = random.Random(3)
    for _ in range(300):
        capacity = pick.choice([10, 20, 50, 100])
        items = [pick.randint(1, capacity) for _ in range(pick.randint(0, 11))]
        counts = np.bincount(items, minlength=capacity + 1)
        uses, bound = complete_bins(counts, capacity)
        check_uses(uses, counts, capacity)
        got = sum(times for _, times in uses)
        assert bound <= got == (fewest(items, capacity) if items else 0)


def test_search_beats_best_fit():
    """Best fit takes 4, 4 + 3 + 3 of ten each and leaves pieces over; the fillings 6 + 4 and 4 + 3 + 3 are full."""
    counts = np.bincount([5, 5, 4, 4, 3, 3, 3, 3], minlength=11)
    assert sum(t for _, t in complete_bins(counts, 10)[0]) == least_sequences(counts, 10) == 3
    items = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6]
    counts = np.bincount(items, minlength=61)
    assert sum(t for _, t in complete_bins(counts, 60)[0]) == fewest(items, 60) <= sum(t for _, t in best_fit(counts, 60))


@pytest.mark.parametrize("low, high, n", [(1, 1024, 1_000_000), (300, 700, 3000), (1, 5, 1000), (1024, 1024, 50), (513, 513, 9)])
def test_many_pieces(low, high, n):
    counts = np.bincount(np.random.default_rng(1).integers(low, high + 1, n), minlength=1025)
    uses, bound = complete_bins(counts, 1024, steps=200)
    check_uses(uses, counts, 1024)
    assert bound <= sum(t for _, t in uses) <= 1.02 * bound + 1


def test_completions_are_not_dominated():
    counts = np.bincount([60, 40, 39, 20, 20, 1], minlength=101)
    assert completions(counts, 100) == [((60, 1), (40, 1))]
    counts = np.bincount([60, 38, 20, 19, 10, 2], minlength=101)
    found = completions(counts, 100)
    assert ((60, 1), (38, 1), (2, 1)) == found[0]
    assert ((60, 1), (20, 1), (19, 1)) in found and ((60, 1), (20, 1), (10, 1)) not in found


def check_packed(rows, docs, capacity, end_id):
    """All of the contract: pieces, places, ids. Returns the number of sequences."""
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for ident, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end_id]
        first = len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want[ident, piece, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


def test_edges(spark, edge_docs):
    rule = Sequences(capacity=64, end_id=2)
    rows = packing.packing_digest(edge_docs, PATH, rule).collect()
    check_packed(rows, [(r["doc_id"], r["text"]) for r in edge_docs.collect()], 64, 2)


def test_empty_table(spark, no_docs):
    assert packing.packing_digest(no_docs, PATH).count() == 0
    assert packing.pack_sequences(no_docs, PATH).count() == 0


def test_frequent_length_spans_parts(spark):
    """A third of the rows are one text; numbers within a length go on over the parts."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a b c").otherwise(F.concat_ws(" ", F.sequence(F.lit(0), F.col("id") % 40))).alias("text"))
    rows = packing.packing_digest(docs, PATH, Sequences(capacity=50)).collect()
    n = check_packed(rows, [tuple(r) for r in docs.collect()], 50, 2)
    lengths = np.bincount([r["length"] for r in rows], minlength=51)
    assert n <= 1.02 * least_sequences(lengths, 50)


def test_query_packs_whole_table(spark):
    rows = registered_queries()["op12_sequence_packing"](spark, MEDIUM).collect()
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()
    n = check_packed(rows, [tuple(r) for r in docs], 1024, 2)
    assert n <= 1 + least_sequences(np.bincount([r["length"] for r in rows], minlength=1025), 1024)


def test_sequences_hold_the_tokens(spark, edge_docs):
    library = Tokenizer.from_file(PATH)
    by_id = {r["doc_id"]: library.encode(r["text"] or "", add_special_tokens=False).ids + [2] for r in edge_docs.collect()}
    rule = Sequences(capacity=64)
    total = 0
    for row in packing.pack_sequences(edge_docs, PATH, rule).collect():
        for part in row["documents"]:
            ids = by_id[part["doc_id"]]
            start = 0 if part["piece"] == 0 else (len(ids) - 1) % 64 + 1 + 64 * (part["piece"] - 1)
            assert row["ids"][part["offset"] : part["offset"] + part["length"]] == ids[start : start + part["length"]]
            total += part["length"]
        assert len(row["ids"]) == sum(p["length"] for p in row["documents"])
    assert total == sum(len(by_id[r["doc_id"]]) for r in edge_docs.collect())
