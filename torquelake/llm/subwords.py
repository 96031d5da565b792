"""Subword ids of a public tokenizer, by way of the pieces between spaces."""

from __future__ import annotations

import ctypes
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces remembered in a worker, and characters of text that are encoded together.
REMEMBERED = 600_000
TOGETHER = 4_000_000
#: New pieces in a string for the tokenizer.
JOINED = 256

_SPLIT = re.compile(r"\x20(?=\S)")
#: Where this is not found, every space has something else than white space behind it.
_MAYBE_ODD = r"\x20(?:[\t-\r\x1c-\x20\x{85}\pZ]|\z)"


def _strings(column: pa.Array) -> list[str]:
    """Strings without a space in them; made at once from their joint bytes."""
    if not len(column):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
    return pc.binary_join(whole, " ")[0].as_py().split(" ")


class PieceCache:
    """Ids of texts by way of their pieces between spaces, which are remembered.

    A text is cut before each space that stands between other characters than white space. How
    the first piece, pieces behind a space and texts with other space are encoded is left to the kinds.
    """

    maybe_odd = _MAYBE_ODD
    dtype: np.dtype
    opens: np.ndarray  # which ids start with a space
    before = ""  # what joined pieces need in front

    def __init__(self) -> None:
        self.pieces: dict[str, bytes] = {}  # those that follow a space, without it
        self.remembered = REMEMBERED

    def ids_of(self, texts: list[str]) -> list[bytes]:
        raise NotImplementedError

    def ids_after_space(self, pieces: list[str]) -> list[bytes]:
        raise NotImplementedError

    def ids_of_odd(self, text: str) -> bytes:
        raise NotImplementedError

    def ids_of_joined(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces without a space in them, joined by spaces and told apart by their first ids."""
        out: list[bytes] = []
        joined = [self.before + " ".join(pieces[k : k + JOINED]) for k in range(0, len(pieces), JOINED)]
        for raw in self.ids_of(joined):
            ids = np.frombuffer(raw, dtype=self.dtype)
            at = (np.append(np.flatnonzero(self.opens[ids]), len(ids)) * self.dtype.itemsize).tolist()
            out += [raw[a:b] for a, b in zip(at, at[1:], strict=False)]
        return out

    def look_up(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces that follow a space."""
        known = self.pieces
        if len(known) > self.remembered:  # frequent pieces come early, so the first half stays
            for piece in list(known)[self.remembered // 2 :]:
                del known[piece]
        ids = list(map(known.get, pieces))
        new = [k for k, found in enumerate(ids) if found is None]
        for k, found in zip(new, self.ids_after_space([pieces[k] for k in new]) if new else (), strict=True):
            ids[k] = known[pieces[k]] = found
        return ids

    def _join(self, heads: list[str], distinct: list[str], pieces: np.ndarray, begins: np.ndarray) -> list[bytes]:
        """Ids of texts whose pieces ``begins[k]`` to ``begins[k + 1]``, as places in ``distinct``, follow a head."""
        parts = self.look_up(distinct) + self.ids_of(heads)
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(parts), dtype=self.dtype)
        order = np.insert(pieces, begins[:-1], len(distinct) + np.arange(len(heads)))
        taken = sizes[order]
        ends = np.cumsum(taken)
        firsts = (np.cumsum(sizes) - sizes)[order]
        ids = flat[np.repeat(firsts - ends + taken, taken) + np.arange(ends[-1])]
        raw = memoryview(ids.tobytes())
        at = np.concatenate([[0], ends])[begins + np.arange(len(begins))] * self.dtype.itemsize
        return [bytes(raw[a:b]) for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]

    def encode_some(self, texts: list[str]) -> list[bytes]:
        """Texts are cut before spaces by Arrow; where other white space follows one, by the expression."""
        column = pa.array(texts, pa.string())
        odd = pc.match_substring_regex(column, self.maybe_odd).to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        plain = np.flatnonzero(~odd)
        if len(plain):
            cut = pc.split_pattern(column.filter(pa.array(~odd)), " ")
            sizes = pc.list_value_length(cut).to_numpy().astype(np.int64)
            firsts = np.cumsum(sizes) - sizes
            words = pc.list_flatten(cut)
            inside = np.ones(len(words), dtype=bool)
            inside[firsts] = False
            coded = words.filter(pa.array(inside)).dictionary_encode()
            distinct = _strings(coded.dictionary)
            begins = np.concatenate([[0], np.cumsum(sizes - 1)])
            heads = words.take(pa.array(firsts)).to_pylist()
            for k, ids in zip(plain.tolist(), self._join(heads, distinct, coded.indices.to_numpy(), begins), strict=True):
                out[k] = ids
        for k in np.flatnonzero(odd).tolist():
            out[k] = self.ids_of_odd(texts[k])
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as the bytes of an array of ``dtype``."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end]) <= TOGETHER):
                chars += len(texts[end])
                end += 1
            out += self.encode_some(texts[at:end])
            at = end
        return out


class PieceEncoder(PieceCache):
    """Ids that a byte-level BPE of the tokenizers library gives a text.

    Its pattern always starts a new piece at a space that is followed by something else than white
    space, so a text may be cut before such spaces, and pieces seen before need no second look.
    The strings of special tokens are ordinary text, but with ``special``, where they are what the
    library makes of them by default.
    """

    before = " "

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65_536 else "<u4")
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.special]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        # Fixed value: the sign of this kind of vocabulary for a space.
        spaced = [i for token, i in self.tokenizer.get_vocab(True).items() if token.startswith("\u0120")]
        self.opens = np.zeros(self.tokenizer.get_vocab_size(True), dtype=bool)
        self.opens[spaced] = True

    def ids_of(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in encoded]

    def ids_after_space(self, pieces: list[str]) -> list[bytes]:
        out = [b""] * len(pieces)
        for spaced, encode in ((False, self.ids_of_joined), (True, lambda odd: self.ids_of([f" {p}" for p in odd]))):
            places = [k for k, p in enumerate(pieces) if (" " in p) == spaced]
            for k, ids in zip(places, encode([pieces[k] for k in places]) if places else (), strict=True):
                out[k] = ids
        return out

    def ids_of_odd(self, text: str) -> bytes:
        pieces = _SPLIT.split(text)
        return b"".join(self.ids_of(pieces[:1]) + self.look_up(pieces[1:]))

    def _whole(self, text: str) -> bytes:
        """Ids of a text with special tokens in it, by the library's default."""
        self.tokenizer.encode_special_tokens = False
        try:
            return self.ids_of([text])[0]
        finally:
            self.tokenizer.encode_special_tokens = True

    def encode(self, texts: list[str], special: bool = False) -> list[bytes]:
        """The ids of each text, as the bytes of an array of ``dtype``."""
        if special and self.special and (odd := [k for k, t in enumerate(texts) if self.special.search(t)]):
            apart = set(odd)
            out = self.encode([t if k not in apart else "" for k, t in enumerate(texts)])
            for k in odd:
                out[k] = self._whole(texts[k])
            return out
        return super().encode(texts)


class SentencePieceEncoder(PieceCache):
    """Ids that a BPE of the sentencepiece library gives a text, which it puts a space in front of.

    None of its pieces may go over the start of a word, and its normalization may not look beyond one;
    where a piece does, texts are encoded whole. So are texts with a space at an end or beside white space, or with the sign for one.
    """

    maybe_odd = rf"\A\x20|\x{{2581}}|{_MAYBE_ODD}"

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        super().__init__()
        self.processor = SentencePieceProcessor(model_file=path)
        names = [self.processor.id_to_piece(k) for k in range(self.processor.get_piece_size())]
        # Fixed value: U+2581 stands for a space.
        self.opens = np.array([name.startswith("\u2581") for name in names])
        if any("\u2581" in name.lstrip("\u2581") for name in names):
            self.maybe_odd = ""
        self.dtype = np.dtype("<u2" if self.processor.get_piece_size() <= 65_536 else "<u4")

    def ids_of(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, dtype=self.dtype).tobytes() for ids in self.processor.encode(texts, num_threads=1)]

    def ids_after_space(self, pieces: list[str]) -> list[bytes]:
        return self.ids_of_joined(pieces)

    def ids_of_odd(self, text: str) -> bytes:
        return self.ids_of([text])[0]


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One for each tokenizer file in a Python worker."""
    return PieceEncoder(path)


def forget() -> None:
    """Give the memory of remembered pieces and of earlier work back; for workers that turn to other work."""
    encoder.cache_clear()
    release()


def release() -> None:
    """Give the memory of earlier work back to the system; pieces stay remembered."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)
