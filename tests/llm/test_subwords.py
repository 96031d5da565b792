"""Piece caches against the libraries, on texts of odd white space and signs."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from torquelake.llm import subwords

SIGNS = [*" \t\n\r\x0b\x0c\x1c\x1f\x85 　  ᠎​", "  ", " x"] + ["a", "bc", "É", "漢", "1", "'s", "!", "🙂", "́"] * 2


def texts(extra):
    pick = random.Random(1)
    made = ["".join(pick.choice(SIGNS + extra) for _ in range(pick.randint(0, 12))) for _ in range(5000)]
    return [*made, "", " ", "a", "word " * 500, "x" * 5000]


def test_byte_level(monkeypatch):
    monkeypatch.setattr(subwords, "REMEMBERED", 300)  # read when a cache is made
    monkeypatch.setattr(subwords, "TOGETHER", 2000)
    path = public_tokenizers.path("byte_bpe_50k.json")
    codec, library = subwords.PieceEncoder(path), Tokenizer.from_file(path)
    some = texts(["<|endoftext|>"])
    want = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
    for _ in range(2):
        assert [np.frombuffer(x, dtype=codec.dtype).tolist() for x in codec.encode(some, special=True)] == want
    library.encode_special_tokens = True
    want = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
    assert [np.frombuffer(x, dtype=codec.dtype).tolist() for x in codec.encode(some)] == want
    assert codec.encode([]) == []


def test_sentence_pieces(monkeypatch):
    monkeypatch.setattr(subwords, "REMEMBERED", 300)
    codec = subwords.SentencePieceEncoder(public_tokenizers.path("piece_bpe_32k.model"))
    some = texts(["▁", "<s>"])
    assert [np.frombuffer(x, dtype=codec.dtype).tolist() for x in codec.encode(some)] == codec.processor.encode(some)
