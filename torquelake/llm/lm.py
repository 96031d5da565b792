"""Scores of texts by a causal self-attention model over subwords, beside a count of words.

Texts are tokenized once: subword ids, and hashes of words with the documents of a block (part of an Arrow
batch) that hold them. Words are counted over all training documents. A word's rows of all blocks
meet in one task, which knows its count then and sends each document its share of the sum; words
that make up much of the text are counted apart (at most ``MOST_HOT`` of them), so no task gets
a word's whole list. Subword counts, over all training documents too, shape the vocabulary of the
attention model. The model starts from a fit on a bounded sample; then it learns from all training
documents in ``ROUNDS`` rounds. In a round every task goes once over the round's documents that it has,
from the same model, and the models of all tasks are averaged by what each of them met.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torquelake.config import session_options
from torquelake.llm.attention import Pass, Scorer, Shape, averaged, train_scorer
from torquelake.llm.common import ascii_lower, fit_in_task, match, stored, within
from torquelake.llm.subwords import encoder, forget, release
from torquelake.llm.wordhash import word_hashes

#: Share of the words in a look at some documents from which on a word is counted apart, and their number.
HOT_WORDS = 0.0001
LOOKED_AT = 1000
MOST_HOT = 1000
#: Training documents and subwords of the sample that the attention model starts from, at most.
SAMPLE_DOCS, SAMPLE_SUBWORDS = 3000, 1_500_000
#: Rounds over the training documents, each document in one of them; tasks that add up models in a round.
ROUNDS, ADDERS = 2, 16
#: Subwords that are learned or scored together.
TOGETHER = 200_000
#: Sums of documents that a task keeps before it hands them on.
KEPT = 2_000_000
#: Documents of a block; a place in it needs 16 bits.
BLOCK = 2048
#: Rows of words that a task hands on at a time.
HANDED_ON = 20_000
WORD, DOC, SUBWORD, HOT = range(4)


def hot_words(rows: DataFrame) -> np.ndarray:
    """Sorted hashes of words that are frequent in some documents; what is chosen changes no result.

    Only the first documents of a partition are looked at, and of further partitions only if
    that one has none.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, counts = np.unique(word_hashes(batch.column(0).slice(0, LOOKED_AT))[0], return_counts=True)
            often = np.flatnonzero(counts > HOT_WORDS * counts.sum())
            often = often[np.argsort(-counts[often], kind="stable")]
            yield pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64))], names=["word"])
            if len(often):
                return

    found = rows.select("_text").mapInArrow(counted, "word bigint").take(MOST_HOT)
    return np.unique(np.array([r["word"] for r in found], dtype=np.int64).view(np.uint64))


def tokenized(rows: DataFrame, hot: np.ndarray, tokenizer: str, end_id: int) -> DataFrame:
    """Rows of four kinds from one pass over ``_id, _h, _held, _text``, written and partitioned by kind.

    ``WORD``: hash in ``key``, ``block``, training count ``n``, and in ``data`` the places (high half)
    and counts (low half) of its documents. ``DOC``: place in the block in ``key``, tokens ``n``,
    subword ids in ``data``, places and counts of hot words in ``more``. ``SUBWORD`` and ``HOT``: id or place
    of a hot word in ``key`` and its training count ``n``.
    """
    sent = rows.sparkSession.sparkContext.broadcast(hot)
    id_type = rows.schema["_id"].dataType.simpleString()
    names = ["kind", "key", "block", "n", "data", "more", "_id", "_h", "_held"]

    def pairs(places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Places and counts in 32 bits; a count beyond 16 bits takes several."""
        times = -(-counts // 65535)
        if len(times) and times.max() > 1:
            number = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            places = np.repeat(places, times)
            counts = np.minimum(65535, np.repeat(counts, times) - number * 65535)
        return (places.astype(np.uint32) << np.uint32(16)) | counts.astype(np.uint32), times

    def rows_of(kind, key, block, n, data=None, more=None, ids=None, hashes=None, held=None, id_kind=None):
        size = len(key)
        none = lambda t: pa.nulls(size, t)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(size, kind, dtype=np.int32)), pa.array(np.asarray(key, dtype=np.int64)),
                pa.array(np.full(size, block, dtype=np.int64)), pa.array(np.asarray(n, dtype=np.int64)),
                none(pa.binary()) if data is None else pa.array(data, pa.binary()),
                none(pa.binary()) if more is None else pa.array(more, pa.binary()),
                none(id_kind) if ids is None else ids,
                none(pa.int64()) if hashes is None else hashes,
                none(pa.bool_()) if held is None else held,
            ],
            names=names,
        )

    def pass_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, hot_list = encoder(tokenizer), sent.value
        number = TaskContext.get().partitionId() << 24
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                id_kind = batch.schema.field(0).type
                held = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
                words, begin = word_hashes(batch.column(3))
                sizes = np.diff(begin)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                values, word = np.unique(words, return_inverse=True)
                # Distinct words of each document with their counts.
                both, times = np.unique(word.astype(np.int64) << 16 | doc, return_counts=True)
                word, doc = both >> 16, both & 0xFFFF
                trained = np.bincount(word, weights=times * ~held[doc], minlength=len(values)).astype(np.int64)
                place = np.minimum(np.searchsorted(hot_list, values), max(len(hot_list) - 1, 0))
                is_hot = hot_list[place] == values if len(hot_list) else np.zeros(len(values), dtype=bool)

                cold = ~is_hot[word]
                packed, spread = pairs(doc[cold], times[cold])
                cuts = np.concatenate([[0], np.cumsum(np.bincount(word[cold], weights=spread, minlength=len(values)).astype(np.int64))])
                raw = packed.tobytes()
                kept = np.flatnonzero(~is_hot)
                data = [raw[4 * a : 4 * b] for a, b in zip(cuts[kept].tolist(), cuts[kept + 1].tolist(), strict=True)]
                for a in range(0, len(kept), HANDED_ON):
                    some = kept[a : a + HANDED_ON]
                    yield rows_of(WORD, values[some].view(np.int64), number, trained[some], data[a : a + HANDED_ON], id_kind=id_kind)
                yield rows_of(HOT, place[is_hot], number, trained[is_hot], id_kind=id_kind)

                by_doc = np.argsort(doc[~cold], kind="stable")
                packed, spread = pairs(place[word[~cold]][by_doc], times[~cold][by_doc])
                cuts = np.concatenate([[0], np.cumsum(np.bincount(doc[~cold][by_doc], weights=spread, minlength=len(sizes)).astype(np.int64))]).tolist()
                raw = packed.tobytes()
                more = [raw[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:], strict=False)]
                # What the words took is free before the subwords take theirs.
                del words, doc, values, word, both, times, place, is_hot, cold, packed, spread, raw, data, by_doc, kept
                release()
                texts = codec.encode(batch.column(3).to_pylist(), special=True)
                yield rows_of(DOC, np.arange(len(sizes)), number, sizes + 1, texts, more, batch.column(0), batch.column(1), batch.column(2), id_kind)

                ids = np.frombuffer(b"".join(t for t, h in zip(texts, held, strict=True) if not h), dtype=codec.dtype)
                counts = np.bincount(ids, minlength=end_id + 1)
                counts[end_id] += (~held).sum()
                used = np.flatnonzero(counts)
                yield rows_of(SUBWORD, used, number, counts[used], id_kind=id_kind)
                number += 1

    schema = f"kind int, key bigint, block bigint, n bigint, data binary, more binary, _id {id_type}, _h bigint, _held boolean"
    with session_options(rows.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BLOCK)}):
        return stored(rows.select("_id", "_h", "_held", "_text").mapInArrow(pass_over, schema), "lm-tokens", ("kind",), "zstd")


def word_sums(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc, total, known`` from rows of ``WORD``: log10(count + 0.5) and known words of each document.

    A document is its block and place. A task adds up what it has of each document and sends it by
    block, packed. The second result is ``trained, distinct``: training counts and known words of each task.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        carried: pa.Table | None = None
        docs, totals, knowns = [np.zeros(0, dtype=np.int64)], [np.zeros(0)], [np.zeros(0, dtype=np.int64)]
        distinct = trained = pending = 0

        def fold() -> None:
            nonlocal docs, totals, knowns, pending
            key, place = np.unique(np.concatenate(docs), return_inverse=True)
            docs, totals = [key], [np.bincount(place, weights=np.concatenate(totals), minlength=len(key))]
            knowns = [np.bincount(place, weights=np.concatenate(knowns), minlength=len(key)).astype(np.int64)]
            pending = len(key)

        def handed_on() -> pa.RecordBatch:
            block, place = docs[0] >> 16, (docs[0] & 0xFFFF).astype("<u2")
            cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]])) if len(block) else np.zeros(1, dtype=np.int64)
            spans = list(zip(cuts.tolist(), cuts[1:].tolist(), strict=False))
            packed = [[x[a:b].tobytes() for a, b in spans] for x in (place, totals[0], knowns[0].astype("<u4"))]
            empty = pa.nulls(len(spans), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(block[cuts[:-1]]), *(pa.array(x, pa.binary()) for x in packed), empty, empty], names=names)

        def work(table: pa.Table) -> None:
            nonlocal distinct, trained, pending
            key, block, n = (table.column(c).to_numpy() for c in ("key", "block", "n"))
            begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            count = np.add.reduceat(n, begin)
            distinct += int((count > 0).sum())
            trained += int(count.sum())
            row_count = np.repeat(count, np.diff(np.append(begin, len(key))))
            data = table.column("data").to_pylist()
            lengths = np.array([len(x) // 4 for x in data])
            entry = np.frombuffer(b"".join(data), dtype="<u4").astype(np.int64)
            times = entry & 0xFFFF
            docs.append(np.repeat(block, lengths) << 16 | entry >> 16)
            totals.append(times * np.repeat(np.log10(row_count + 0.5), lengths))
            knowns.append(times * np.repeat(row_count > 0, lengths))
            pending += len(entry)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if carried is not None:
                table = pa.concat_tables([carried, table])
            key = table.column("key").to_numpy()
            last = int(np.searchsorted(key, key[-1], "left")) if len(key) else 0
            carried = table.slice(last)
            if last:
                work(table.slice(0, last))
            if pending > 2 * KEPT:
                fold()
                if pending > KEPT:
                    yield handed_on()
                    docs, totals, knowns, pending = [docs[0][:0]], [totals[0][:0]], [knowns[0][:0]], 0
        if carried is not None and carried.num_rows:
            work(carried)
        fold()
        yield handed_on()
        none = pa.nulls(1, pa.binary())
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), none, none, none, pa.array([trained]), pa.array([distinct])], names=names)

    def added(table: pa.Table) -> pa.Table:
        raw = lambda column, kind: np.frombuffer(b"".join(table.column(column).to_pylist()), dtype=kind)
        place = raw("places", "<u2").astype(np.int64)
        used = np.flatnonzero(np.bincount(place))
        total, known = np.bincount(place, weights=raw("totals", "<f8")), np.bincount(place, weights=raw("knowns", "<u4"))
        block = table.column("block")[0].as_py()
        return pa.table({"doc": block << 16 | used, "total": total[used], "known": known[used].astype(np.int64)})

    names = ["block", "places", "totals", "knowns", "trained", "distinct"]
    by_word = words.select("key", "block", "n", "data").repartition("key").sortWithinPartitions("key")
    parts = stored(by_word.mapInArrow(
        summed, "block bigint, places binary, totals binary, knowns binary, trained bigint, distinct bigint"), "lm-sums")
    sums = parts.filter("block IS NOT NULL").groupBy("block").applyInArrow(added, "doc bigint, total double, known bigint")
    return sums, parts.filter("block IS NULL").select("trained", "distinct")


def together(texts: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Some texts at a time, of about ``TOGETHER`` subwords."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + TOGETHER, "right")))
        yield texts[first:last]
        first = last


def refined(scorer: Scorer, trained: DataFrame, dtype: np.dtype) -> Scorer:
    """The scorer after learning from all texts in ``trained`` (``block, key, data``)."""
    spark = trained.sparkSession
    for number in range(ROUNDS):
        sent = spark.sparkContext.broadcast(scorer)

        def learned(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            forget()
            own = Pass(sent.value)
            for batch in batches:
                for texts in together([np.frombuffer(x, dtype=dtype) for x in batch.column(0).to_pylist()]):
                    own.learn(texts)
            if own.windows:
                at = TaskContext.get().partitionId() % ADDERS
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([own.weighted().tobytes()], pa.binary())], names=["part", "sums"])

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forget()
            total = None
            for batch in batches:
                for x in batch.column(1):
                    sums = np.frombuffer(x.as_buffer(), dtype=np.float64)
                    total = sums.copy() if total is None else total + sums
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        mine = trained.filter(F.pmod(F.xxhash64("block", "key"), F.lit(ROUNDS)) == number).select("data")
        models = stored(mine.mapInArrow(learned, "part int, sums binary"), "lm-models")
        # A few sums, whatever the number of tasks.
        sums = models.repartition(ADDERS, "part").mapInArrow(added, "sums binary").collect()
        if sums:
            scorer = averaged(scorer, np.sum([np.frombuffer(r["sums"], dtype=np.float64) for r in sums], axis=0))
    return scorer


def score_texts(
    docs: DataFrame,
    held_out: Column,
    tokenizer: str,
    end_id: int,
    shape: Shape | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Tokens are words with A-Z lower-cased and one end. ``base_score`` sums log10 of their smoothed
    shares in the rows that are not held out; ``score`` is the attention model's log10 probability of
    the lower-cased text. A null or empty text is an end alone. Rows that repeat are counted and
    scored as often. If nothing is left to learn from, all counts are 0 and the model is its start.
    An empty table gives an empty result; other columns are left out.
    """
    spark = docs.sparkSession
    text = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.coalesce(held_out, F.lit(False)).alias("_held"))
    rows = rows.withColumn("_h", F.xxhash64("_text"))
    hot = hot_words(rows)
    tokens = tokenized(rows, hot, tokenizer, end_id)
    kind = lambda k: tokens.filter(F.col("kind") == k)

    sums, counted_words = word_sums(kind(WORD))
    cold = counted_words.agg(F.sum("trained"), F.sum("distinct")).first()
    hot_counts = np.zeros(len(hot), dtype=np.int64)
    for r in kind(HOT).groupBy("key").agg(F.sum("n").alias("n")).collect():  # one row for each hot word
        hot_counts[r["key"]] = r["n"]
    n_train = kind(DOC).filter("NOT _held").count()
    train_tokens = int(cold[0] or 0) + int(hot_counts.sum()) + n_train
    n_distinct = int(cold[1] or 0) + int((hot_counts > 0).sum()) + int(n_train > 0)
    whole = math.log10(train_tokens + 0.5 * (n_distinct + 1))
    hot_logs, hot_known, end_log = np.log10(hot_counts + 0.5), hot_counts > 0, math.log10(n_train + 0.5)

    counted = kind(SUBWORD).groupBy("key").agg(F.sum("n").alias("n")).collect()  # one row for each id of the tokenizer
    vocabulary_size = max(end_id + 1, len(encoder(tokenizer).opens))
    id_counts = np.zeros(vocabulary_size)
    for r in counted:
        id_counts[r["key"]] = r["n"]
    dtype = encoder(tokenizer).dtype
    draw = F.md5(F.concat(F.lit("lm:"), F.coalesce(F.col("_id").cast("string"), F.lit("")), F.col("_h").cast("string")))
    sample = kind(DOC).filter("NOT _held").select(draw.alias("draw"), "data").orderBy("draw").limit(SAMPLE_DOCS)

    def fit(table: pa.Table | None) -> Scorer:
        texts = [np.frombuffer(x, dtype=dtype) for x in table.sort_by("draw").column("data").to_pylist()] if table else []
        texts = [t[: SAMPLE_SUBWORDS // 8] for t in texts]
        fits = within([len(t) + 1 for t in texts], SAMPLE_SUBWORDS)
        return train_scorer([t for t, f in zip(texts, fits, strict=True) if f], id_counts, end_id, shape)

    start = fit_in_task(sample, fit)
    sent = spark.sparkContext.broadcast(refined(start, kind(DOC).filter("NOT _held"), dtype))
    id_type = tokens.schema["_id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        model = sent.value
        for batch in batches:
            doc = batch.column(0).to_numpy() << 16 | batch.column(1).to_numpy()
            n, total, known = batch.column(2).to_numpy(), [], []
            for x in batch.column(4).to_pylist():
                entry = np.frombuffer(x, dtype="<u4").astype(np.int64)
                word, times = entry >> 16, entry & 0xFFFF
                total.append(float((times * hot_logs[word]).sum()))
                known.append(int((times * hot_known[word]).sum()))
            texts = [np.frombuffer(x, dtype=dtype) for x in batch.column(3).to_pylist()]
            score = [model.scores(some) for some in together(texts)]
            base = np.array(total) + end_log - n * whole
            columns = [batch.column(5), batch.column(6), pa.array(doc), batch.column(2), pa.array(base), pa.array(known, pa.int64()), pa.array(np.concatenate(score))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "doc", "n_tokens", "base", "hot_known", "score"])

    all_docs = kind(DOC).select("block", "key", "n", "data", "more", "_id", "_held").mapInArrow(
        scored, f"doc_id {id_type}, held_out boolean, doc bigint, n_tokens bigint, base double, hot_known bigint, score double")
    joined = match(all_docs, sums, ["doc"], "left")
    return joined.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("hot_known") + F.coalesce("known", F.lit(0)) + F.lit(int(n_train > 0))).alias("n_known"),
        F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("total", F.lit(0.0))).alias("base_score"),
        "score",
    )

