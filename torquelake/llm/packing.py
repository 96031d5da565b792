"""Packing of token pieces into sequences of a fixed length, by bin completion over their lengths.

A document longer than a sequence is cut into whole sequences; its first piece holds the rest. How
pieces are put together depends on their lengths alone, so the search works on the number of pieces
of each length: at most ``capacity`` numbers, whatever the size of the corpus. It is run in one task,
and yields fillings with the number of times that each is used. All pieces are then numbered
within their length, where a range partition keeps a frequent length from being one task's, and
a piece's number says which use of which filling it belongs to.

The search (``complete_bins``) takes the longest piece that is left, enumerates the fillings of the
space beside it that no other one dominates, and branches on them, fullest first. A branch ends when
the space that it has wasted, with what must be wasted in any packing of the rest, allows no
fewer sequences than the best packing known. Best-fit packings of what is left are the incumbents.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from torquelake.llm.common import fit_in_task, identified, match_few, stored
from torquelake.llm.subwords import encoder

#: Search steps, in each order of branches, after which the best packing so far is taken without a proof that it is the best.
STEPS = 2_500
#: After so many steps what is left is packed by best fit, too.
FITTED = 8
#: What a piece costs, in tokens, in the orders in which branches are tried.
PRICES = (0, 2, 8, 32)
#: A filling: lengths with how often each occurs in it, longest first.
Filling = tuple[tuple[int, int], ...]


@dataclass(frozen=True)
class Sequences:
    """Length of a sequence, and the id behind each document."""

    capacity: int = 1024
    end_id: int = 2
    steps: int = STEPS


def least_sequences(counts: np.ndarray, capacity: int) -> int:
    """Fewest sequences that pieces of these lengths can need: the best of the bounds by size classes.

    For each limit up to half of a sequence: pieces longer than what a piece of that limit leaves are
    alone, those over a half are in different sequences, and the others go into the space beside them.
    """
    lengths = np.arange(capacity + 1)
    number = np.concatenate([[0], np.cumsum(counts)])
    volume = np.concatenate([[0], np.cumsum(counts * lengths)])
    limit = np.arange(0, capacity // 2 + 1)
    alone = number[capacity + 1] - number[capacity - limit + 1]
    half = capacity // 2
    halves = number[capacity - limit + 1] - number[half + 1]
    space = halves * capacity - (volume[capacity - limit + 1] - volume[half + 1])
    small = volume[half + 1] - volume[limit]
    more = np.maximum(0, -((space - small) // capacity))
    return int((alone + halves + more).max())


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Filling, int]]:
    """Longest first, each piece into the fullest sequence that has room; equal sequences together."""
    rooms: dict[int, Counter] = {}  # room -> fillings and how many sequences hold them
    free: list[int] = []  # rooms, ascending

    def put(room: int, filling: Filling, times: int) -> None:
        if room not in rooms:
            rooms[room] = Counter()
            free.insert(bisect_right(free, room), room)
        rooms[room][filling] += times

    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            at = bisect_right(free, length - 1)
            if at == len(free):
                each = capacity // length
                if left >= each:
                    put(capacity - each * length, ((length, each),), left // each)
                if left % each:
                    put(capacity - left % each * length, ((length, left % each),), 1)
                break
            room = free[at]
            filling, have = next(iter(rooms[room].items()))
            each = min(room // length, left)
            times = min(have, left // each)
            rooms[room][filling] -= times
            if rooms[room][filling] == 0:
                del rooms[room][filling]
            if not rooms[room]:
                del rooms[room]
                free.pop(at)
            put(room - each * length, (*filling, (length, each)), times)
            left -= each * times
    return [(filling, times) for by_filling in rooms.values() for filling, times in by_filling.items()]


def _without(counts: np.ndarray, filling: Filling, times: int) -> np.ndarray:
    out = counts.copy()
    for length, each in filling:
        out[length] -= each * times
    return out


def _fullest(counts: np.ndarray, room: int) -> list[int]:
    """Lengths of a filling of ``room`` whose sum no other filling exceeds: subset sums as the bits of a number."""
    lengths: list[int] = []
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        lengths += [length] * min(int(counts[length]), room // length)
    reach, mask, before = 1, (1 << room + 1) - 1, []
    for length in lengths:
        before.append(reach)
        reach |= reach << length & mask
        if reach >> room & 1:
            break
    found, rest = [], reach.bit_length() - 1
    for length, earlier in zip(lengths[: len(before)][::-1], before[::-1], strict=True):
        if not earlier >> rest & 1:
            found.append(length)
            rest -= length
    return found


def completions(counts: np.ndarray, capacity: int, price: int = 0, width: int = 6) -> list[Filling]:
    """Fillings around the longest piece, fullest first, none dominated by another of them.

    With a ``price``, each piece counts as so many wasted tokens in this order, which spares short pieces.

    One filling dominates another if the pieces of the other fit into the places of its own pieces. Of
    single pieces only the longest that fits is not dominated; of two, those that are fuller than it, with the
    longest second piece to each first. The fullest filling of any number of pieces is always among
    them.
    """
    longest = int(np.flatnonzero(counts)[-1])
    rest = counts.copy()
    rest[longest] -= 1
    room = capacity - longest
    held = np.flatnonzero(rest[: room + 1])
    if not len(held):
        return [((longest, 1),)]
    single = int(held[-1])
    options: list[tuple[int, ...]] = [(single,)]
    if single < room:
        up_to = np.zeros(room + 1, dtype=np.int64)  # longest length not above each number
        up_to[held] = held
        up_to = np.maximum.accumulate(up_to)
        second = up_to[np.minimum(room - held, held)]
        same = (second == held) & (rest[held] < 2)
        second[same] = up_to[np.maximum(held[same] - 1, 0)]
        sums = held + second
        good = np.flatnonzero((second > 0) & (sums > single))
        best = good[np.argsort(-(sums[good] * (capacity + 1) + held[good]), kind="stable")][: 4 * width]
        undominated: list[tuple[int, int]] = []
        for a, b in zip(held[best].tolist(), second[best].tolist(), strict=True):
            if not any(a <= x and b <= y for x, y in undominated):
                undominated.append((a, b))
        options += undominated[:width]
        if max(sum(o) for o in options) < room:
            options.append(tuple(_fullest(rest, room)))
    ranked = sorted(set(options), key=lambda o: (price * len(o) - sum(o), len(o), [-x for x in o]))
    return [tuple(sorted(Counter((longest, *o)).items(), reverse=True)) for o in ranked]


def complete_bins(counts: np.ndarray, capacity: int, steps: int = STEPS) -> tuple[list[tuple[Filling, int]], int]:
    """Fillings with their numbers of uses, and the fewest sequences that any packing can need.

    ``counts[n]`` pieces have the length ``n``, up to ``capacity``. A step uses a filling as often as it
    can be had, or once, as another branch. The search is made again with other orders of the branches, and ends
    when the bound is met or after ``steps`` in each.
    """
    counts = np.asarray(counts, dtype=np.int64)
    bound = least_sequences(counts, capacity)
    best = best_fit(counts, capacity)
    for price in PRICES:
        best = _search(counts, capacity, price, steps, best, bound)
    return best, bound


def _search(
    counts: np.ndarray, capacity: int, price: int, steps: int, best: list[tuple[Filling, int]], bound: int
) -> list[tuple[Filling, int]]:
    """The best packing that a branch-and-bound search of so many steps comes to, ``best`` being known."""
    size = sum(times for _, times in best)
    stack: list[tuple[np.ndarray, tuple, int]] = [(counts, (), 0)]  # what is left, uses so far as linked pairs, sequences so far
    tried = 0
    while stack and size > bound and tried < steps:
        left, path, used = stack.pop()
        if not left.any():
            if used < size:
                best, size = _listed(path), used
            continue
        if used + least_sequences(left, capacity) >= size:
            continue
        tried += 1
        if tried % FITTED == 0:
            rest = best_fit(left, capacity)
            if used + sum(times for _, times in rest) < size:
                best = _listed(path) + rest
                size = used + sum(times for _, times in rest)
        branches = []
        for filling in completions(left, capacity, price):
            most = min(int(left[length]) // each for length, each in filling)
            for times in (most, 1) if most > 1 else (1,):
                branches.append((_without(left, filling, times), (path, (filling, times)), used + times))
        stack += branches[::-1]
    return best


def _listed(path: tuple) -> list[tuple[Filling, int]]:
    out = []
    while path:
        path, use = path
        out.append(use)
    return out[::-1]


def cut(n_tokens: int, capacity: int) -> Iterator[tuple[int, int]]:
    """Start and length of a document's pieces: the first takes what whole sequences leave."""
    first = (n_tokens - 1) % capacity + 1
    yield 0, first
    for start in range(first, n_tokens, capacity):
        yield start, capacity


def token_pieces(docs: DataFrame, tokenizer: str, rule: Sequences, with_ids: bool, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, _h, piece, start, length, ids_crc32`` and, if asked for, ``ids`` (an array's bytes) of every piece.

    Texts are encoded whole (null: empty), with the end id behind; a row that repeats has pieces of its own.
    """
    rows = identified(docs, id_col, text_col).select("_id", "_h", "_text")
    fields = [("_id", rows.schema["_id"].dataType), ("_h", T.LongType()), ("piece", T.IntegerType()), ("start", T.LongType())]
    fields += [("length", T.LongType()), ("ids_crc32", T.LongType())] + [("ids", T.BinaryType())] * with_ids
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(tokenizer)
        end = np.array([rule.end_id], dtype=codec.dtype).tobytes()
        for batch in batches:
            owner, piece, start, length, crc, ids = [], [], [], [], [], []
            for k, text in enumerate(codec.encode(batch.column(2).to_pylist(), special=True)):
                wide = np.frombuffer(text + end, dtype=codec.dtype).astype("<u4")
                view = memoryview(wide.tobytes())
                for number, (a, n) in enumerate(cut(len(wide), rule.capacity)):
                    part = view[4 * a : 4 * (a + n)]
                    owner.append(k)
                    piece.append(number)
                    start.append(a)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(bytes(part))
            took = pa.array(owner, pa.int64())
            columns = [batch.column(0).take(took), batch.column(1).take(took), pa.array(piece, pa.int32())]
            columns += [pa.array(c, pa.int64()) for c in (start, length, crc)] + [pa.array(ids, pa.binary())] * with_ids
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(pieces, schema)


def numbered(pieces: DataFrame, by: str) -> DataFrame:
    """The rows with ``number``, 0, 1, 2... within each value of ``by``, in order of id, text hash and piece.

    Rows are dealt by ranges of value and order and written, so that a frequent value spans many
    parts. A part numbers its rows; the sums of the parts, as many as there are parts and values at
    most, are laid end to end.
    """
    order = [F.col(by), F.col("_id").asc_nulls_first(), F.col("_h"), F.col("piece")]
    dealt = pieces.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), "packing-dealt")
    dealt = dealt.withColumn("_part", F.shiftright("_at", 33))
    firsts = dealt.groupBy("_part", by).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy(by).orderBy("_part")) - F.col("_n")
    firsts = firsts.select("_part", by, "_first", before.alias("_before"))
    placed = match_few(dealt, firsts, ["_part", by], firsts.count())
    return placed.withColumn("number", F.col("_before") + F.col("_at") - F.col("_first")).drop("_at", "_part", "_before", "_first")


def pack_pieces(pieces: DataFrame, rule: Sequences) -> DataFrame:
    """The written pieces, each with ``sequence_id`` and ``offset``; sequences have no gaps from 0 on."""
    lengths = pieces.groupBy(F.col("length").cast("long")).agg(F.count(F.lit(1)).alias("n"))

    def search(sample: pa.Table | None) -> list[tuple[Filling, int]]:
        counts = np.zeros(rule.capacity + 1, dtype=np.int64)
        if sample is not None:
            counts[sample.column(0).to_numpy()] = sample.column(1).to_numpy()
        return complete_bins(counts, rule.capacity, rule.steps)[0]

    uses = sorted(fit_in_task(lengths, search), reverse=True)
    # A run of numbers of a length: from which number on, first sequence, pieces of the length in a sequence, offset.
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: Counter = Counter()
    sequence = 0
    for filling, times in uses:
        offset = 0
        for length, each in filling:
            runs.setdefault(length, []).append((taken[length], sequence, each, offset))
            taken[length] += each * times
            offset += length * each
        sequence += times
    by_length = {length: np.array(r, dtype=np.int64) for length, r in runs.items()}
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(n).to_numpy() for n in ("length", "number"))
            place, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
            for value in np.unique(length).tolist():
                rows = np.flatnonzero(length == value)
                table = by_length[value]
                run = table[np.searchsorted(table[:, 0], number[rows], "right") - 1]
                use, within = np.divmod(number[rows] - run[:, 0], run[:, 2])
                place[rows] = run[:, 1] + use
                offset[rows] = run[:, 3] + within * value
            kept = [batch.column(n) for n in schema.names[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(place), pa.array(offset)], names=schema.names)

    return numbered(pieces, "length").mapInArrow(assigned, schema)


def pack_sequences(docs: DataFrame, tokenizer: str, rule: Sequences = Sequences(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``sequence_id, ids, documents``: the tokens of every sequence, and which pieces they come from.

    A sequence gathers at most ``capacity`` tokens. An empty table gives no sequence.
    """
    packed = pack_pieces(stored(token_pieces(docs, tokenizer, rule, True, id_col, text_col), "packing-pieces"), rule)
    row = F.struct("offset", "_id", "piece", "length", "ids")
    sequences = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    schema = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType()))])
    items = F.transform("_rows", lambda r: F.struct(r["_id"].alias("doc_id"), r["piece"].alias("piece"), r["offset"].alias("offset"), r["length"].alias("length")))
    schema = schema.add("documents", sequences.select(items.alias("documents")).schema["documents"].dataType)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(b"".join(parts), dtype="<u4").astype(np.int64) for parts in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(ids, pa.list_(pa.int64())), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    parts = F.transform("_rows", lambda r: r["ids"])
    return sequences.select("sequence_id", parts.alias("ids"), items.alias("documents")).mapInArrow(joined, schema)


def packing_digest(docs: DataFrame, tokenizer: str, rule: Sequences = Sequences()) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    packed = pack_pieces(stored(token_pieces(docs, tokenizer, rule, False), "packing-pieces"), rule)
    return packed.select(F.col("_id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
