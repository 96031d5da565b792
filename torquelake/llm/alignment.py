"""Alignment of two tokenizers' tokens over the same bytes, by sparse incidence products.

A token covers a run of a text's bytes, so a tokenization is an incidence matrix of tokens and
bytes, kept in CSR form: A for the byte-level BPE, B for the SentencePiece model. The product
A·Bᵀ, row by row as Gustavson's method has it, holds for each pair of tokens the number of bytes
they share: its entries are the overlap links. Offsets at which tokens of both end cut a
text into groups; incidence matrices of tokens and groups give in the same way the links between
tokens of a group, whose number is known from the first, symbolic, step of the product.

Texts are tokenized once and the ids written. A second pass counts in how many documents each pair
of ids is linked, a third looks the counts up. Pairs above a share of all counts, of which there can
only be so many, are looked up in every task; the others are shuffled.

A text that is null or empty, or whose tokens of either side don't spell the text behind a space,
has no tokens. Rows that repeat count as often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from torquelake.config import session_options
from torquelake.llm.common import identified, stored
from torquelake.llm.subwords import PieceEncoder, SentencePieceEncoder

#: A pair with more than this share of all counts is looked up in every task; there are at most 1 / HOT_PAIRS of them.
HOT_PAIRS = 1 / 200_000
#: Bytes of text whose matrices are multiplied together, so that they stay in a processor's cache.
TOGETHER = 200_000
#: Documents that are tokenized together.
ENCODED = 1_000
#: Entries that a task gathers before it passes counts on.
GATHERED = 1_000_000
#: Pieces that are remembered for each side, and rows that come to a task at a time.
REMEMBERED, ROWS_AT_ONCE = 200_000, 2_000
#: Rows of a task are numbered from its partition's number times this on.
ROWS_A_PART = 1 << 33


@dataclass(frozen=True)
class Csr:
    """A sparse 0/1 matrix: the columns of row ``i`` are ``columns[begins[i] : begins[i + 1]]``."""

    begins: np.ndarray
    columns: np.ndarray
    n_columns: int

    @property
    def n_rows(self) -> int:
        return len(self.begins) - 1


def runs(lengths: np.ndarray) -> Csr:
    """Row ``i`` holds the ``lengths[i]`` columns behind those of the row before."""
    begins = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(lengths, dtype=np.int64)])
    return Csr(begins, np.arange(begins[-1], dtype=np.int64), int(begins[-1]))


def transposed_runs(lengths: np.ndarray) -> Csr:
    """The transpose of ``runs``: each row holds one column."""
    columns = np.repeat(np.arange(len(lengths)), lengths)
    return Csr(np.arange(len(columns) + 1), columns, len(lengths))


def transposed(matrix: Csr) -> Csr:
    rows = np.repeat(np.arange(matrix.n_rows), np.diff(matrix.begins))
    order = np.argsort(matrix.columns, kind="stable")
    counts = np.bincount(matrix.columns, minlength=matrix.n_columns)
    return Csr(np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(counts)]), rows[order], matrix.n_rows)


def product_sizes(left: Csr, right: Csr) -> np.ndarray:
    """For each row of the product, how many terms it adds up: the symbolic step."""
    terms = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(np.diff(right.begins)[left.columns])])
    return terms[left.begins[1:]] - terms[left.begins[:-1]]


def product(left: Csr, right: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of ``left · right``: each row adds up the rows of ``right`` that its columns name."""
    rows = np.repeat(np.arange(left.n_rows), np.diff(left.begins))
    if len(right.columns) == right.n_rows and (np.diff(right.begins) == 1).all():
        key = rows * right.n_columns + right.columns[left.columns]  # one term for each column
    else:
        sizes = np.diff(right.begins)[left.columns]
        starts = np.repeat(right.begins[:-1][left.columns] - np.cumsum(sizes) + sizes, sizes)
        key = np.repeat(rows, sizes) * right.n_columns + right.columns[starts + np.arange(sizes.sum())]
    if len(key) and (key[1:] < key[:-1]).any():
        key = np.sort(key)
    new = np.flatnonzero(np.diff(key, prepend=-1))
    return key[new] // right.n_columns, key[new] % right.n_columns, np.diff(np.append(new, len(key)))


@dataclass(frozen=True)
class Aligned:
    """Both tokenizations of some texts over a common axis of bytes: links as places of tokens, and groups."""

    link_a: np.ndarray
    link_b: np.ndarray
    overlap: np.ndarray
    group_a: np.ndarray  # the group of each token
    group_b: np.ndarray
    group_end: np.ndarray  # last byte of each group, exclusive


def align_lengths(bytes_a: np.ndarray, bytes_b: np.ndarray) -> Aligned:
    """Align tokens by their numbers of bytes; both sides cover the same bytes."""
    a, b_t = runs(bytes_a), transposed_runs(bytes_b)
    link_a, link_b, overlap = product(a, b_t)
    ends_a, ends_b = a.begins[1:], np.cumsum(bytes_b)
    ended = np.zeros(a.n_columns + 1, dtype=bool)
    ended[ends_a] = True
    ends = ends_b[ended[ends_b]]
    group_a = np.searchsorted(ends, ends_a)
    group_b = np.searchsorted(ends, ends_b)
    return Aligned(link_a, link_b, overlap, group_a, group_b, ends)


def group_incidence(groups: np.ndarray, n_groups: int) -> Csr:
    """Token ``i`` is in the one group ``groups[i]``."""
    return Csr(np.arange(len(groups) + 1, dtype=np.int64), groups.astype(np.int64), n_groups)


class TokenBytes:
    """Both tokenizers, and the bytes that each of their ids stands for."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = PieceEncoder(path_a), SentencePieceEncoder(path_b)
        self.a.remembered = self.b.remembered = REMEMBERED
        spelled = _byte_signs()
        vocabulary = self.a.tokenizer.get_vocab(True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, ident in vocabulary.items():
            plain = all(c in spelled for c in token)
            self.bytes_a[ident] = bytes(spelled[c] for c in token) if plain else token.encode()
        self.bytes_b = []
        pieces = self.b.processor
        for ident in range(pieces.get_piece_size()):
            piece = pieces.id_to_piece(ident)
            # A byte piece is <0xHH>, U+2581 stands for a space.
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(ident) else piece.replace("▁", " ").encode())
        self.size_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        #: How an id is written in a list of groups: before another one of its side, and as the last.
        self.written = [f"{k}{end}" for k in range(len(self.bytes_a)) for end in ",|"] + [f"{k}{end}" for k in range(len(self.bytes_b)) for end in ",;"]

    def without_pieces(self) -> TokenBytes:
        """For tasks that tokenize nothing: what was remembered is given back."""
        self.a.pieces.clear()
        self.b.pieces.clear()
        pa.default_memory_pool().release_unused()
        return self

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of both sides as the bytes of arrays; none where they don't spell a space and the text."""
        out: list[tuple[bytes, bytes]] = []
        for text, a, b in zip(texts, self.a.encode([f" {t}" for t in texts]), self.b.encode(texts), strict=True):
            want = f" {text}".encode()
            spelled_a = b"".join(map(self.bytes_a.__getitem__, np.frombuffer(a, dtype=self.a.dtype).tolist()))
            spelled_b = b"".join(map(self.bytes_b.__getitem__, np.frombuffer(b, dtype=self.b.dtype).tolist()))
            out.append((a, b) if text and spelled_a == want == spelled_b else (b"", b""))
        return out


def _byte_signs() -> dict[str, int]:
    """The sign that a byte-level vocabulary writes for each byte: printable ones stand for themselves, the others follow from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # fixed values
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def token_bytes(path_a: str, path_b: str) -> TokenBytes:
    """One for each pair of files in a Python worker."""
    return TokenBytes(path_a, path_b)


def encode_both(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_row, _id, ids_a, ids_b`` (arrays' bytes) of every row, written to the shared folder."""
    rows = identified(docs, id_col, text_col).select("_id", "_text")
    fields = [("_row", T.LongType()), ("_id", rows.schema["_id"].dataType), ("ids_a", T.BinaryType()), ("ids_b", T.BinaryType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = token_bytes(path_a, path_b)
        row = TaskContext.get().partitionId() * ROWS_A_PART
        for batch in batches:
            for first in range(0, batch.num_rows, ENCODED):
                some = batch.slice(first, ENCODED)
                found = both.encode(some.column(1).to_pylist())
                columns = [pa.array(np.arange(row, row + len(found), dtype=np.int64)), some.column(0)]
                columns += [pa.array([ids[k] for ids in found], pa.binary()) for k in (0, 1)]
                row += len(found)
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return stored(rows.mapInArrow(encoded, schema), "alignment-ids")


@dataclass(frozen=True)
class Block:
    """Some documents' tokens on a common axis, aligned. Documents are told apart by where their tokens begin."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    begin_a: np.ndarray
    begin_b: np.ndarray
    aligned: Aligned

    @property
    def link_doc(self) -> np.ndarray:
        """The document of each link; links are in order of their documents."""
        return self.doc_a[self.aligned.link_a]

    @property
    def doc_a(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.begin_a) - 1), np.diff(self.begin_a))


def blocks(batch: pa.RecordBatch, both: TokenBytes) -> Iterator[tuple[int, int, Block]]:
    """The documents of a batch by blocks of about ``TOGETHER`` bytes, as first and last place and aligned tokens."""
    raw_a, raw_b = (batch.column(n).to_pylist() for n in ("ids_a", "ids_b"))
    at = 0
    while at < len(raw_a):
        end, size = at, 0
        while end < len(raw_a) and (end == at or size + 2 * len(raw_a[end]) <= TOGETHER):
            size += 2 * len(raw_a[end])
            end += 1
        begins = []
        ids = []
        for raw, dtype in ((raw_a[at:end], both.a.dtype), (raw_b[at:end], both.b.dtype)):
            ids.append(np.frombuffer(b"".join(raw), dtype=dtype).astype(np.int64))
            counts = [len(r) // dtype.itemsize for r in raw]
            begins.append(np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(counts, dtype=np.int64)]))
        aligned = align_lengths(both.size_a[ids[0]], both.size_b[ids[1]])
        yield at, end, Block(ids[0], ids[1], begins[0], begins[1], aligned)
        at = end


def distinct_pairs(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, linked pairs of ids, and how many links each stands for; sorted by both."""
    known_a, known_b = np.unique(block.ids_a), np.unique(block.ids_b)  # small numbers, so that a key fits 64 bits
    a, b = np.searchsorted(known_a, block.ids_a), np.searchsorted(known_b, block.ids_b)
    doc = block.link_doc
    key = (doc * len(known_a) + a[block.aligned.link_a]) * len(known_b) + b[block.aligned.link_b]
    key.sort()
    new = np.flatnonzero(np.diff(key, prepend=-1))
    links = np.diff(np.append(new, len(key)))
    rest, b = np.divmod(key[new], max(len(known_b), 1))
    doc, a = np.divmod(rest, max(len(known_a), 1))
    return doc, known_a[a] << 32 | known_b[b], links


def pair_counts(encoded: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``pair, n``: in how many documents each pair of ids is linked, written; tasks count before the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = token_bytes(path_a, path_b).without_pieces()
        pairs = np.zeros(0, dtype=np.int64)
        counts = np.zeros(0, dtype=np.int64)
        held: list[np.ndarray] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            found, n = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *held]), return_counts=True)
            every, place = np.unique(np.concatenate([pairs, found]), return_inverse=True)
            return every, np.bincount(place, weights=np.concatenate([counts, n]), minlength=len(every)).astype(np.int64)

        for batch in batches:
            for _, _, block in blocks(batch, both):
                held.append(distinct_pairs(block)[1])
                size += len(held[-1])
                if size >= GATHERED:
                    pairs, counts = merged()
                    held, size = [], 0
                    if len(pairs) >= GATHERED:
                        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])
                        pairs = counts = np.zeros(0, dtype=np.int64)
        pairs, counts = merged()
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])

    partial = encoded.select("ids_a", "ids_b").mapInArrow(counted, "pair long, n long")
    return stored(partial.groupBy("pair").agg(F.sum("n").alias("n")), "alignment-pairs")


@dataclass(frozen=True)
class Counts:
    """What every task knows of the corpus: the highest count of each A id, and the frequent pairs' counts."""

    best: np.ndarray
    pairs: np.ndarray
    n: np.ndarray


def corpus_counts(counts: DataFrame) -> tuple[Counts, DataFrame]:
    """The counts for all tasks, bounded by the vocabulary and 1 / HOT_PAIRS, and the table of the other pairs, with ``_top``, the highest of their A id."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    by_a = counts.groupBy(F.shiftright("pair", 32).alias("_a")).agg(F.max("n").alias("_top"))  # at most the vocabulary
    tops = by_a.collect()
    best = np.zeros(max((r["_a"] for r in tops), default=0) + 1, dtype=np.int64)
    for r in tops:
        best[r["_a"]] = r["_top"]
    hot = F.col("n") > total * HOT_PAIRS
    found = counts.filter(hot).toArrow()
    pairs, n = (found.column(k).to_numpy().astype(np.int64) for k in ("pair", "n"))
    order = np.argsort(pairs)
    return Counts(best, pairs[order], n[order]), counts.filter(~hot).withColumn("_a", F.shiftright("pair", 32)).join(F.broadcast(by_a), "_a").drop("_a")


def _looked_up(pair: np.ndarray, known: Counts) -> np.ndarray:
    """Counts of the frequent pairs, 0 for the others."""
    if not len(known.pairs):
        return np.zeros(len(pair), dtype=np.int64)
    at = np.minimum(np.searchsorted(known.pairs, pair), len(known.pairs) - 1)
    return np.where(known.pairs[at] == pair, known.n[at], 0)


def _per_document(n: int, doc: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """Number, or sum of weights, of each document's entries; they are in order of their documents."""
    ends = np.searchsorted(doc, np.arange(n + 1))
    if weights is None:
        return np.diff(ends)
    sums = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(weights, dtype=np.int64)])
    return sums[ends[1:]] - sums[ends[:-1]]


def align_digest(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Numbers of tokens, groups and links of every document, what the corpus says of its links, and its groups' hash.

    ``doc_id, n_a, n_b, n_groups, n_links, n_group_links, n_best, count_sum, groups_sha256``: ``n_best``
    counts links whose pair is in as many documents as any pair of its A id, ``count_sum`` adds up the
    documents of all links' pairs, ``n_group_links`` counts pairs of tokens that share a group.
    """
    with session_options(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(ROWS_AT_ONCE)}):
        return _align_digest(docs, path_a, path_b)


def _align_digest(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    encoded = encode_both(docs, path_a, path_b)
    known, rare = corpus_counts(pair_counts(encoded, path_a, path_b))
    id_type = encoded.schema["_id"].dataType
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_group_links", "n_best", "count_sum"]
    fields = [("_row", T.LongType()), ("_id", id_type), *((n, T.LongType()) for n in numbers), ("groups_sha256", T.StringType())]
    fields += [("_pairs", T.ArrayType(T.LongType())), ("_links", T.ArrayType(T.LongType()))]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = token_bytes(path_a, path_b).without_pieces()
        for batch in batches:
            for first, end, block in blocks(batch, both):
                n = end - first
                x = block.aligned
                n_groups = len(x.group_end)
                of_group = block.doc_a[np.flatnonzero(np.diff(x.group_a, prepend=-1))]
                a, b = (group_incidence(g, n_groups) for g in (x.group_a, x.group_b))
                doc, pair, links = distinct_pairs(block)
                count = _looked_up(pair, known)
                best = (count > 0) & (count == known.best[pair >> 32])
                columns = [
                    np.diff(block.begin_a),
                    np.diff(block.begin_b),
                    _per_document(n, of_group),
                    _per_document(n, block.link_doc),
                    _per_document(n, block.doc_a, product_sizes(a, transposed(b))),
                    _per_document(n, doc, links * best),
                    _per_document(n, doc, links * count),
                ]
                left = np.flatnonzero(count == 0)
                begins = pa.array(np.searchsorted(doc[left], np.arange(n + 1)).astype(np.int32))
                others = [pa.ListArray.from_arrays(begins, pa.array(v[left])) for v in (pair, links)]
                kept = [batch.column(k).slice(first, n) for k in (0, 1)]
                hashes = pa.array(_group_hashes(block, both), pa.string())
                yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, columns), hashes, *others], names=schema.names)

    rows = stored(encoded.mapInArrow(digested, schema), "alignment-rows")
    others = rows.select("_row", F.explode(F.arrays_zip("_pairs", "_links")).alias("_x")).select("_row", F.col("_x._pairs").alias("pair"), F.col("_x._links").alias("_links"))
    sums = others.join(rare, "pair").groupBy("_row").agg(
        F.sum(F.when(F.col("n") == F.col("_top"), F.col("_links")).otherwise(0)).alias("_best"),
        F.sum(F.col("_links") * F.col("n")).alias("_sum"),
    )
    rows = rows.join(sums, "_row", "left")
    more = {"n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0))}
    return rows.withColumns(more).select(F.col("_id").alias("doc_id"), *numbers, "groups_sha256")


def _first_tokens(groups: np.ndarray) -> np.ndarray:
    """The first token of each group, groups being numbered along the tokens."""
    return np.flatnonzero(np.diff(groups, prepend=-1))


def group_texts(block: Block, both: TokenBytes) -> list[str]:
    """Each document's groups, as ``a1,a2|b1;a3|b2,b3``."""
    x = block.aligned
    n_groups = len(x.group_end)
    # A group's A tokens come first, then its B tokens; the last of either has another sign behind it.
    until_a = np.cumsum(np.bincount(x.group_a, minlength=n_groups))
    until_b = np.cumsum(np.bincount(x.group_b, minlength=n_groups))
    order = np.empty(len(x.group_a) + len(x.group_b), dtype=np.int64)
    last_a, last_b = (np.diff(g, append=n_groups) != 0 for g in (x.group_a, x.group_b))
    before_b = np.concatenate([np.zeros(1, dtype=np.int64), until_b])
    order[np.arange(len(x.group_a)) + before_b[x.group_a]] = 2 * block.ids_a + last_a
    order[np.arange(len(x.group_b)) + until_a[x.group_b]] = 2 * (len(both.bytes_a) + block.ids_b) + last_b
    written = list(map(both.written.__getitem__, order.tolist()))
    at = (block.begin_a + block.begin_b).tolist()
    return ["".join(written[a:b])[:-1] for a, b in zip(at, at[1:], strict=False)]


def _group_hashes(block: Block, both: TokenBytes) -> list[str]:
    return [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in group_texts(block, both)]


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The alignment of every document: ids, links and groups.

    ``links`` are triples of a token's place on either side and the bytes they share, ``groups`` the
    numbers of A and B tokens and the last byte (exclusive, the space in front counted) of each group.
    """
    encoded = encode_both(docs, path_a, path_b, id_col, text_col)
    link = T.StructType([T.StructField(n, T.IntegerType()) for n in ("a", "b", "bytes")])
    group = T.StructType([T.StructField(n, T.IntegerType()) for n in ("n_a", "n_b", "end")])
    lists = [("ids_a", T.IntegerType()), ("ids_b", T.IntegerType()), ("links", link), ("groups", group)]
    schema = T.StructType([T.StructField("doc_id", encoded.schema["_id"].dataType), *(T.StructField(n, T.ArrayType(t)) for n, t in lists)])

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = token_bytes(path_a, path_b).without_pieces()

        def structs(begins: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Array:
            values = pa.StructArray.from_arrays([pa.array(c.astype(np.int32)) for c in columns.values()], names=list(columns))
            return pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), values)

        for batch in batches:
            for first, end, block in blocks(batch, both):
                x = block.aligned
                docs_of = np.arange(end - first + 1)
                link_begin = np.searchsorted(block.link_doc, docs_of)
                group_doc = np.searchsorted(block.begin_a, _first_tokens(x.group_a), "right") - 1
                group_begin = np.searchsorted(group_doc, docs_of)
                byte_begin = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(both.size_a[block.ids_a])])[block.begin_a]
                links = {"a": x.link_a - block.begin_a[block.link_doc], "b": x.link_b - block.begin_b[block.link_doc], "bytes": x.overlap}
                n_groups = len(x.group_end)
                groups = {
                    "n_a": np.bincount(x.group_a, minlength=n_groups),
                    "n_b": np.bincount(x.group_b, minlength=n_groups),
                    "end": x.group_end - byte_begin[group_doc],
                }
                ids = [
                    pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(values.astype(np.int32)))
                    for begin, values in ((block.begin_a, block.ids_a), (block.begin_b, block.ids_b))
                ]
                columns = [batch.column(1).slice(first, end - first), *ids, structs(link_begin, links), structs(group_begin, groups)]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(zip(schema.names, [c.type for c in columns], strict=True))))

    return encoded.mapInArrow(aligned, schema)
