"""N-gram Jaccard join: a blocked sparse product of documents by n-grams.

1. Every text becomes its set of n-gram hashes. Equal sets are one node from here on.
2. Blocks. If two sets are similar, at most ``d`` n-grams are in one of them only, ``d`` following
   from their sizes. All n-grams are dealt over ``d + 1 + spare`` parts, so the two sets are the
   same in at least ``1 + spare`` parts. Each set is posted under the content of its parts, and sets
   that share a posting, directly or through others, form a block. Of its parts a set leaves out the
   ``spare`` weakest: those with the fewest n-grams that are rare in the corpus, ties by key. Two similar
   sets share ``1 + spare`` parts at least; at most ``spare`` of them are as weak as the strongest that either leaves
   out, so one is posted by both. Passages that many documents share hardly ever make up a
   strong part, so they pull few unlike documents into a block.
3. Product. Within a block, overlap counts are summed up along inverted lists, for pairs whose sizes
   allow the similarity, and compared with the exact bound. Pairs that are connected
   already are not looked at, and only links that connect something new leave a task. A large block
   is cut: every cut is compared with one pivot first, and what the pivot does not reach with all cuts.
   Where links are counted, every two cuts meet and all pairs are looked at.
4. Links become components.

The result is exact but for 64-bit hash collisions of n-grams within two documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torquelake.config import session_options
from torquelake.llm.common import identified, match, match_few, match_hot, stored
from torquelake.llm.components import connected_components
from torquelake.llm.subwords import forget
from torquelake.llm.wordhash import U64, mix, word_hashes

#: An n-gram is frequent if it is counted in so many documents, or in this share of all.
FREQUENT_DOCS, FREQUENT_SHARE = 10, 0.0001
#: Sets in a cut of a block, and n-grams.
CUT, CUT_NGRAMS = 1000, 500_000
#: N-grams that are worked on together.
TOGETHER = 100_000
#: N-grams that a task counts together, and rows that come to a task at a time.
COUNTED, ROWS_AT_ONCE = 4_000_000, 2_000
DOC = ["_id", "_h"]


@dataclass(frozen=True)
class Similar:
    """N-grams of ``words`` words; two sets are linked if ``den * overlap >= num * union``."""

    words: int = 3
    num: int = 90
    den: int = 100

    def linked(self, overlap, a, b):
        return (overlap > 0) & (self.den * overlap >= self.num * (a + b - overlap))

    def size_classes(self, most: int) -> np.ndarray:
        """Lower ends of the classes of sizes; neighbouring sizes of a link are in one or the next.

        The last two are above ``most``, so the class above that of any set has its true end.
        """
        ends = [1]
        while len(ends) < 2 or ends[-2] <= most:
            ends.append(max(ends[-1] + 1, ends[-1] * max(3 * self.num, 2 * self.den) // (2 * self.num) + 1))
        return np.array(ends, dtype=np.int64)


def ngram_sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, ascending, and where each text's begin."""
    words, begin = word_hashes(column)
    counts = np.diff(begin)
    grams = np.maximum(counts - n + 1, (counts > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(counts)), grams)
    at = np.repeat(begin[:-1], grams) + np.arange(len(doc)) - np.repeat(np.cumsum(grams) - grams, grams)
    length = np.repeat(np.minimum(counts, n), grams)
    hashes = length.astype(np.uint64)
    padded = np.append(words, np.zeros(n, dtype=np.uint64))
    for k in range(n):
        hashes = mix(hashes * U64(0x9E3779B97F4A7C15) + np.where(k < length, padded[np.minimum(at + k, len(words))], U64(0)))
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    hashes, doc = hashes[new], doc[new]
    return hashes, np.searchsorted(doc, np.arange(len(counts) + 1))


def groups(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts are together about ``TOGETHER`` n-grams."""
    for batch in batches:
        sizes = np.cumsum([0, *(len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(text))]) // 5
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(sizes, sizes[first] + TOGETHER, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last


def _sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of slices of 64-bit numbers, 0 for empty ones."""
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[begin[1:]] - total[begin[:-1]]


def node_ids(hashes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set, the same for equal sets only."""
    return tuple(_sums(mix(hashes ^ U64(salt)), begin).view(np.int64) for salt in (0xA5A5A5A5, 0x5C5C5C5C5C5C))  # type: ignore[return-value]


def part_keys(hashes: np.ndarray, begin: np.ndarray, similar: Similar, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the parts that are posted, and the set of each."""
    sizes = np.diff(begin)
    classes = similar.size_classes(int(sizes.max(initial=0)))
    own = np.searchsorted(classes, sizes, "right") - 1
    upper = classes[own + 1]
    also = (sizes > 0) & (sizes * similar.den >= similar.num * upper)
    ids = np.concatenate([np.flatnonzero(sizes > 0), np.flatnonzero(also)])
    label = np.concatenate([own[sizes > 0], own[also] + 1])
    largest = classes[label + 1] - 1
    apart = 2 * largest * (similar.den - similar.num) // (similar.den + similar.num)
    ids, label, apart = ids[apart > 0], label[apart > 0], apart[apart > 0]  # else only equal sets are linked
    if not len(ids):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    spare = np.maximum(3, apart)
    parts = apart + 1 + spare
    base = np.cumsum(parts) - parts
    count = sizes[ids]
    at = np.repeat(begin[ids], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    values = hashes[at]
    rare = np.ones(len(values), dtype=bool)
    if len(frequent):
        rare = frequent[np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)] != values
    dealt = mix(values ^ U64(0x1234567)) >> U64(33)
    slot = np.repeat(base, count) + (dealt % np.repeat(parts, count).astype(np.uint64)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    cuts = np.searchsorted(slot[order], np.arange(parts.sum() + 1))
    content = _sums(mix(values[order] ^ U64(0x77777)), cuts)
    n_rare = _sums(rare[order].astype(np.uint64), cuts)
    owner = np.repeat(np.arange(len(ids)), parts)
    number = np.arange(parts.sum()) - base[owner]
    place = label[owner].astype(np.uint64) * U64(1 << 40) + number.astype(np.uint64)
    keys = mix(content + mix(place + U64(0xABCDEF)))
    ranked = np.lexsort((keys, n_rare, owner))  # the weakest parts of each set come first
    posted = ranked[number >= spare[owner]]
    return keys[posted].view(np.int64), ids[owner[posted]]


def frequent_ngrams(rows: DataFrame, similar: Similar, n_docs: int) -> np.ndarray:
    """Sorted hashes of n-grams that are in many documents.

    A task only reports n-grams that it meets twice or more, so the counts are lower bounds; the
    choice changes how much is compared, not what is found. There are at most ``1 / FREQUENT_SHARE``
    times the n-grams of an average document, however many documents there are.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        held: list[np.ndarray] = []

        def often() -> Iterator[pa.RecordBatch]:
            seen = np.concatenate([np.zeros(0, dtype=np.uint64), *held])
            for k in range(16):  # a share of the n-grams at a time, for little memory
                values, counts = np.unique(seen[seen & U64(15) == U64(k)], return_counts=True)
                again = counts >= 2
                yield pa.RecordBatch.from_arrays([pa.array(values[again].view(np.int64)), pa.array(counts[again])], names=["gram", "n"])

        for part in groups(batches, 0):
            held.append(ngram_sets(part.column(0), similar.words)[0])
            if sum(map(len, held)) >= COUNTED:
                yield from often()
                held.clear()
        yield from often()

    found = rows.select("_text").mapInArrow(counted, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    often = found.filter(F.col("n") >= max(FREQUENT_DOCS, FREQUENT_SHARE * n_docs)).select("gram").toArrow()
    return np.sort(often.column("gram").to_numpy().view(np.uint64)) if often.num_rows else np.zeros(0, dtype=np.uint64)


def condensed(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``key, node, is_pair`` of some postings: each key once, with its first set, and the pairs of that
    set with the others of its keys.

    The key of a pair is the other set, so a posting that is everywhere is one row for each call.
    """
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    first = nodes[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))]
    apart = nodes != first
    pairs = np.unique(np.stack([nodes[apart], first[apart]], axis=1), axis=0)
    is_pair = np.concatenate([np.zeros(int(new.sum()), dtype=bool), np.ones(len(pairs), dtype=bool)])
    return np.concatenate([keys[new], pairs[:, 0]]), np.concatenate([nodes[new], pairs[:, 1]]), is_pair


def _star_edges(postings: DataFrame) -> DataFrame:
    """``a, b``: sets with a common posting, each with the first of its key.

    ``key, node, is_pair`` are dealt by key. A key that is everywhere has few rows, as they were
    condensed before; pairs pass through.
    """

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None  # key and its first set at the end of the batch before
        for batch in batches:
            keys, sets = (batch.column(k).to_numpy() for k in (0, 1))
            is_pair = batch.column(2).to_numpy(zero_copy_only=False)
            through = np.stack([keys[is_pair], sets[is_pair]], axis=1)
            keys, sets = keys[~is_pair], sets[~is_pair]
            first = np.zeros(0, dtype=np.int64)
            if len(keys):
                new = np.ones(len(keys), dtype=bool)
                new[1:] = keys[1:] != keys[:-1]
                begin = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
                first = sets[begin]
                if tail is not None and keys[0] == tail[0]:
                    first = np.where(begin == 0, tail[1], first)
                tail = (keys[-1], first[-1])
            pairs = np.unique(np.concatenate([np.stack([sets, first], axis=1)[sets != first], through]), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, k])) for k in (1, 0)], names=["a", "b"])

    dealt = postings.repartition("key").sortWithinPartitions("key", "node")
    return stored(dealt.mapInArrow(linked, "a bigint, b bigint"), "block-edges").filter("a <> b").distinct()


def hits(sizes: np.ndarray, sets: list[np.ndarray], similar: Similar, rows: np.ndarray, root: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Each of ``rows`` that has any with the sets it is linked with, itself perhaps among them.

    Sets come by size. For a row, overlaps with all sets of fitting size are counted along the
    inverted lists of its n-grams. Rows whose fitting sets all have their ``root`` are left out.
    """
    m = len(sets)
    counts = np.array([len(s) for s in sets])
    _, gram = np.unique(np.concatenate(sets), return_inverse=True)
    doc = np.repeat(np.arange(m), counts)
    order = np.argsort(gram, kind="stable")
    inverted, begin = doc[order], np.searchsorted(gram[order], np.arange(gram.max(initial=-1) + 2))
    shared = (begin[1:] - begin[:-1])[gram] > 1
    ends = np.cumsum(counts)
    low = np.searchsorted(sizes, -(-similar.num * sizes // similar.den), "left")
    high = np.searchsorted(sizes, sizes * similar.den // similar.num, "right")
    for p in rows.tolist():
        near = slice(low[p], high[p])
        if root is not None and (root[near] == root[p]).all():
            continue
        own = slice(ends[p] - counts[p], ends[p])
        grams = gram[own][shared[own]]
        if not len(grams):
            continue
        lists = [inverted[begin[g] : begin[g + 1]] for g in grams.tolist()]
        overlap = np.bincount(np.concatenate(lists), minlength=m)[near]
        yield p, np.flatnonzero(similar.linked(overlap, sizes[p], sizes[near])) + low[p]


def connect(root: np.ndarray, p: int, hit: np.ndarray) -> None:
    joined = np.unique(root[hit])
    if len(joined) > 1 or (len(joined) == 1 and joined[0] != root[p]):
        every = np.append(joined, root[p])
        root[np.isin(root, every)] = every.min()


def product(sizes: np.ndarray, sets: list[np.ndarray], similar: Similar, root: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Link all pairs of ``rows`` with any set; returns the roots. ``root`` holds what is known to be connected."""
    for p, hit in hits(sizes, sets, similar, rows, root):
        connect(root, p, hit)
    return root


def _count(similar: Similar):
    """All pairs of two cuts of a block, or of one: for each set the first one that it is connected to,
    and the number of rows that it is linked with."""

    def count(table: pa.Table) -> pa.Table:
        forget()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("grams").to_pylist()]
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        order = np.argsort(sizes, kind="stable")
        node = [x for x in np.array(table.column("node").to_pylist(), dtype=object)[order]]
        copies = table.column("copies").to_numpy()[order]
        one = table.column("low")[0].as_py() == table.column("high")[0].as_py()
        first = (table.column("cut").to_numpy() == table.column("low")[0].as_py())[order]
        root, n = np.arange(len(sets)), np.zeros(len(sets), dtype=np.int64)
        for p, hit in hits(sizes[order], [sets[i] for i in order], similar, np.flatnonzero(first)):
            hit = hit[hit != p] if one else hit[~first[hit]]
            n[p] += copies[hit].sum()
            if not one:
                n[hit] += copies[p]
            connect(root, p, hit)
        return pa.table({"a": pa.array([node[r] for r in root], pa.string()), "b": pa.array(node, pa.string()), "n": pa.array(n)})

    return count


def _compare(similar: Similar, rows_only: bool):
    """Links of one cut of a block: between the roots that sets had before, and only such as connect something new.

    A set has one root in all pairs of cuts, so many of its pairs find the same link, not one for each set.
    """

    def compare(table: pa.Table) -> pa.Table:
        forget()
        root = table.column("root").to_pylist()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("grams").to_pylist()]
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        order = np.argsort(sizes, kind="stable")
        names = {x: k for k, x in enumerate(dict.fromkeys(root))}
        known = np.array([names[root[i]] for i in order])
        asked = np.array(table.column("asked").to_pylist(), dtype=bool)[order] if rows_only else np.ones(len(sets), dtype=bool)
        found = product(sizes[order], [sets[i] for i in order], similar, known.copy(), np.flatnonzero(asked))
        label = list(names)
        new = np.unique(np.stack([found, known], axis=1)[found != known], axis=0)
        return pa.table({k: pa.array([label[r] for r in ends.tolist()], pa.string()) for k, ends in (("a", new[:, 0]), ("b", new[:, 1]))})

    return compare


def _linked_nodes(blocks: DataFrame, similar: Similar, rows: DataFrame, counted: bool) -> DataFrame:
    """``a, b``: links that connect the sets of each block; ``counted``: with ``n``, rows that ``b`` is linked with in a pair of cuts."""
    # One document for each set, with the number of sets in its block.
    sized = blocks.groupBy("block").agg(F.count("*").alias("_sets"), F.min("node").alias("_pivot"), F.sum("n_shingles").alias("_grams"))
    sized = sized.withColumn("_cuts", F.ceil(F.greatest(F.col("_sets") / CUT, F.col("_grams") / CUT_NGRAMS)).cast("int")).drop("_grams")
    members = match_hot(blocks, sized, ["block"], F.col("_sets"), blocks.count()).filter("_sets > 1")
    cut = F.pmod(F.xxhash64("node"), F.col("_cuts")).cast("int")
    members = stored(members.withColumn("cut", cut), "block-members")
    # The texts of those documents are read where they are.
    texts = match_few(rows, members, DOC, members.count())

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for part in groups(batches, 0):
            hashes, begin = ngram_sets(part.column(0), similar.words)
            raw = [hashes[a:b].tobytes() for a, b in zip(begin, begin[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(raw, pa.binary())], names=[*part.schema.names[1:], "grams"])

    fields = ["block", "node", "cut", "copies", "_cuts", "_sets", "_pivot"]
    sets = texts.select("_text", *fields).mapInArrow(with_sets, "block bigint, node string, cut int, copies bigint, _cuts int, _sets bigint, _pivot string, grams binary")
    sets = stored(sets, "block-sets")
    if sets.count() > members.count():  # rows repeat an id and a text
        sets = stored(sets.dropDuplicates(["node"]), "block-sets")

    links = "a string, b string"
    cuts = F.col("_cuts")
    if counted:
        pairs = sets.withColumn("_other", F.explode(F.sequence(F.lit(0), cuts - 1)))
        pairs = pairs.select("block", F.least("cut", "_other").alias("low"), F.greatest("cut", "_other").alias("high"), "cut", "node", "copies", "grams")
        return pairs.groupBy("block", "low", "high").applyInArrow(_count(similar), f"{links}, n bigint")
    pivots = sets.filter("node = _pivot").withColumn("_own", F.col("cut")).withColumn("cut", F.explode(F.sequence(F.lit(0), cuts - 1))).filter("cut <> _own")
    once = sets.select("block", "cut", "node", F.col("node").alias("root"), "grams").union(pivots.select("block", "cut", "node", F.col("node").alias("root"), "grams"))
    near = stored(once.groupBy("block", "cut").applyInArrow(_compare(similar, rows_only=False), links), "links")

    # In blocks of several cuts, what is not connected with the pivot meets all other cuts.
    many = sets.filter("_cuts > 1")
    if many.isEmpty():
        return near
    labels = connected_components(near)
    labelled = match(many, labels, ["node"], "left").withColumn("root", F.coalesce("component", "node")).drop("component")
    labelled = stored(labelled, "labelled-sets")
    reached = labelled.filter("node = _pivot").select("block", F.col("root").alias("_reached"))
    open_ = match(labelled, F.broadcast(reached) if reached.count() <= 10_000 else reached, ["block"]).filter("root <> _reached")
    left = stored(open_.groupBy("block").agg(F.count("*").alias("_open"), F.first("_sets").alias("_all"), F.first("_cuts").alias("_parts")), "open-blocks")
    # Where most sets are open, every two cuts meet once.
    mostly = left.filter("2 * _open > _all").select("block", "_open")
    here = F.col("cut")
    paired = match(labelled, mostly, ["block"]).join(open_.select("node", F.lit(True).alias("_is_open")), "node", "left")
    paired = paired.withColumn("_other", F.explode(F.sequence(F.lit(0), cuts - 1))).filter("_other <> cut")
    paired = paired.select("block", F.least(here, "_other").alias("cut"), F.greatest(here, "_other").alias("part"), "node", "root", "grams",
                           F.coalesce("_is_open", F.lit(False)).alias("asked"))
    left = left.filter("2 * _open <= _all").select("block", F.ceil(F.col("_open") * F.col("_parts") / F.col("_all")).cast("int").alias("_groups"))
    open_ = match(open_, left, ["block"])
    groups_of = F.col("_groups")
    asked = open_.withColumn("part", F.pmod(F.xxhash64(F.lit(3), "node"), groups_of).cast("int"))
    asked = asked.withColumn("cut", F.explode(F.sequence(F.lit(0), cuts - 1)))
    others = match(labelled, left, ["block"]).withColumn("part", F.explode(F.sequence(F.lit(0), groups_of - 1)))
    columns = ["block", "cut", "part", "node", "root", "grams"]
    asked, others = asked.select(*columns, F.lit(True).alias("asked")), others.select(*columns, F.lit(False).alias("asked"))
    # A set that is asked for and in the cut itself is there once, as asked.
    both = asked.union(match(others, asked.select("block", "cut", "part", "node"), ["block", "cut", "part", "node"], "left_anti"))
    met = paired.groupBy("block", "cut", "part").applyInArrow(_compare(similar, rows_only=True), links)
    return near.union(met).union(both.groupBy("block", "cut", "part").applyInArrow(_compare(similar, rows_only=True), links))


def ngram_components(docs: DataFrame, similar: Similar = Similar(), id_col: str = "doc_id", text_col: str = "text", counted: bool = True) -> DataFrame:
    """``_id, _h, n_shingles, component_id, group, n_links`` for every row.

    ``n_links`` is the number of other rows that are similar enough, those with an equal set among them; 0
    without words. All pairs of a block are compared for it; without ``counted`` the column is left out.

    ``component_id`` is the smallest linked id; ``group`` names the component, null without words. Null and empty texts, and those without words, have no n-grams and are linked with nothing; with
    fewer words than an n-gram the whole sequence is one. Rows that repeat are linked as equal texts
    are. Null ids never become a component's id unless it has no other. An empty table gives an
    empty result; other columns are left out.
    """
    with session_options(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(ROWS_AT_ONCE)}):
        return _ngram_components(docs, similar, id_col, text_col, counted)


def _ngram_components(docs: DataFrame, similar: Similar, id_col: str, text_col: str, counted: bool) -> DataFrame:
    rows = identified(docs, id_col, text_col)
    n_docs = rows.count()
    frequent = rows.sparkSession.sparkContext.broadcast(frequent_ngrams(rows, similar, n_docs))
    id_type = rows.schema["_id"].dataType.simpleString()

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for part in groups(batches, 2):
            hashes, begin = ngram_sets(part.column(2), similar.words)
            low, high = node_ids(hashes, begin)
            columns = [part.column(0), part.column(1), pa.array(np.diff(begin)), pa.array(low), pa.array(high)]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "_h", "n_shingles", "_low", "_high"])

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for part in groups(batches, 0):
            hashes, begin = ngram_sets(part.column(0), similar.words)
            keys, owner = part_keys(hashes, begin, similar, frequent.value)
            condense = condensed(keys, node_ids(hashes, begin)[0][owner])
            yield pa.RecordBatch.from_arrays(list(map(pa.array, condense)), names=["key", "node", "is_pair"])

    signed_rows = rows.select(*DOC, "_text").mapInArrow(signed, f"_id {id_type}, _h bigint, n_shingles bigint, _low bigint, _high bigint")
    known = stored(signed_rows.withColumn("node", F.concat(F.lpad(F.hex("_low"), 16, "0"), F.lpad(F.hex("_high"), 16, "0"))), "ngram-sets")

    postings = rows.select("_text").mapInArrow(posted, "key bigint, node bigint, is_pair boolean")
    coarse = connected_components(_star_edges(postings)).select(F.col("node").alias("_low"), F.col("component").alias("block"))
    # One document stands for all that have its set.
    standing = known.filter("n_shingles > 0").groupBy("_low", "node").agg(
        F.min(F.struct(*DOC)).alias("_doc"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"))
    blocks = stored(match(standing, coarse, ["_low"]).select("block", "node", "copies", "n_shingles", "_doc._id", "_doc._h"), "blocks")
    links = stored(_linked_nodes(blocks, similar, rows, counted), "ngram-links")
    labels = connected_components(links.select("a", "b"))

    if counted:  # once for each set, as a set may have many rows
        degrees = links.filter("n > 0").groupBy(F.col("b").alias("node")).agg(F.sum("n").alias("_n"))
        each = standing.select("node", "copies")
        each = stored(match(each, degrees, ["node"], "left").select("node", "copies", (F.coalesce("_n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "ngram-degrees")
        worded = match_hot(known.filter("n_shingles > 0"), each, ["node"], F.col("copies"), n_docs).drop("copies")
        known = worded.unionByName(known.filter("n_shingles = 0").withColumn("n_links", F.lit(0).cast("bigint")))
    grouped = match(known.drop("_low", "_high"), labels.withColumnRenamed("component", "_group"), ["node"], "left")
    grouped = stored(grouped.withColumn("_group", F.coalesce("_group", "node")).drop("node"), "ngram-groups")
    smallest = grouped.filter("n_shingles > 0").groupBy("_group").agg(F.min("_id").alias("component_id"), F.count("*").alias("_rows"))
    linked = match_hot(grouped.filter("n_shingles > 0"), smallest, ["_group"], F.col("_rows"), n_docs)
    alone = grouped.filter("n_shingles = 0").withColumn("component_id", F.col("_id")).withColumn("_group", F.lit(None).cast("string"))
    columns = [*DOC, "n_shingles", "component_id", F.col("_group").alias("group"), *(["n_links"] if counted else [])]
    return linked.select(columns).unionByName(alone.select(columns))


def keep_one(docs: DataFrame, similar: Similar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, of each component the document with the smallest id (null first).

    Rows without words are linked with nothing and all stay; of rows that repeat id and text one stays.
    """
    linked = stored(ngram_components(docs, similar, id_col, text_col, counted=False).filter("group IS NOT NULL").select(*DOC, "group"), "linked-documents")
    first = linked.groupBy("group").agg(F.min(F.struct(*DOC)).alias("_first"), F.count("*").alias("_rows"))
    marked = match_hot(linked, first, ["group"], F.col("_rows"), linked.count())
    gone = stored(marked.filter(~F.struct(*DOC).eqNullSafe(F.col("_first"))).select(*DOC).distinct(), "dropped-documents")
    repeated = stored(linked.groupBy(*DOC).count().filter("count > 1").select(*DOC), "repeated-documents")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keys = docs.withColumns({"_id": F.col(id_col), "_h": F.xxhash64(text)})
    # Texts are only shuffled if what is dropped is too much to be broadcast, or among rows that repeat.
    kept = match_few(keys, gone, DOC, gone.count(), "left_anti")
    n_repeated = repeated.count()
    if n_repeated:
        twice = match_few(kept, repeated, DOC, n_repeated, "left_semi").dropDuplicates(DOC)
        kept = match_few(kept, repeated, DOC, n_repeated, "left_anti").unionByName(twice)
    return kept.select(docs.columns)


def component_digest(docs: DataFrame, similar: Similar) -> DataFrame:
    return ngram_components(docs, similar, counted=False).select(F.col("_id").alias("doc_id"), "n_shingles", "component_id")


def link_digest(docs: DataFrame, similar: Similar) -> DataFrame:
    return ngram_components(docs, similar).select(F.col("_id").alias("doc_id"), "n_shingles", "component_id", "n_links")
