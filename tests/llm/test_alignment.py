"""Alignment of two tokenizers against a token-by-token computation with the libraries."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SMALL
from tokenizers import Tokenizer

from torquelake.llm import alignment
from torquelake.llm.queries import registered_queries

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    (100, "<|endoftext|> and <s> are text, <0x41> too"),
    (101, "a▁b spells a space"),
    (102, " leading,  double   spaces \n\t and\r\nlines "),
    (103, "é é ﬁ   ​ \U0001f642\U0001f469‍\U0001f680 漢字かな"),
    (104, "\x00\x01\x7f"),
    (105, "x" * 3000),
    (106, "กข" * 300),
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def spell_a(a, ident, signs={}):
    if not signs:
        printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in printable]
        signs.update({chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)})
    return bytes(signs[c] for c in a.id_to_token(ident))


def spell_b(b, ident):
    piece = b.id_to_piece(ident)
    return bytes([int(piece[3:5], 16)]) if b.is_byte(ident) else piece.replace("▁", " ").encode()


def plain(docs, libraries):
    a, b = libraries
    rows, documents = [], Counter()
    for ident, text in docs:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a, bytes_b = [spell_a(a, x) for x in ids_a], [spell_b(b, x) for x in ids_b]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            rows.append((ident, [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        links, groups, i, j, ga, gb = [], [], 0, 0, [], []
        while i < len(ids_a):
            links.append((ids_a[i], ids_b[j]))
            x, y = ends_a[i], ends_b[j]
            if x <= y:
                ga.append(ids_a[i])
                i += 1
            if y <= x:
                gb.append(ids_b[j])
                j += 1
            if x == y:
                groups.append((ga, gb))
                ga, gb = [], []
        documents.update(set(links))
        rows.append((ident, ids_a, ids_b, links, groups))
    best = defaultdict(int)
    for (x, _), n in documents.items():
        best[x] = max(best[x], n)
    out = Counter()
    for ident, ids_a, ids_b, links, *groups in rows:
        groups = groups[0] if groups else []
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out[(
            ident, len(ids_a), len(ids_b), len(groups), len(links), sum(len(g) * len(h) for g, h in groups),
            sum(documents[p] == best[p[0]] for p in links), sum(documents[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        )] += 1
    return out


@pytest.mark.parametrize("hot", [1 / 200_000, 0.001, 2.0])
def test_edges_match_plain_computation(spark, edge_docs, libraries, hot, monkeypatch):
    """With every pair known in each task, some of them, and none."""
    monkeypatch.setattr(alignment, "HOT_PAIRS", hot)
    docs = edge_docs.select("doc_id", "text").unionByName(spark.createDataFrame(ODD, "doc_id bigint, text string")).repartition(3)
    got = alignment.align_digest(docs, *PATHS)
    assert Counter(map(tuple, got.collect())) == plain([tuple(r) for r in docs.collect()], libraries)


def test_small_blocks_and_gathering(spark, edge_docs, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "TOGETHER", 50)
    monkeypatch.setattr(alignment, "GATHERED", 20)
    docs = edge_docs.filter("doc_id is null or doc_id <> 6").select("doc_id", "text")
    encoded = docs.collect()
    both = alignment.token_bytes(*PATHS)
    assert len(both.encode([r["text"] or "" for r in encoded])) == len(encoded)
    got = alignment.align_digest(docs, *PATHS)
    assert Counter(map(tuple, got.collect())) == plain([tuple(r) for r in encoded], libraries)


def test_query_matches_plain_computation(spark, libraries):
    got = registered_queries()["op13_tokenizer_alignment"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert Counter(map(tuple, got.collect())) == plain([tuple(r) for r in docs], libraries)


def test_empty_table(spark, no_docs):
    assert alignment.align_digest(no_docs, *PATHS).count() == 0
    assert alignment.align_documents(no_docs, *PATHS).count() == 0


def test_products_match_dense_ones():
    pick = np.random.default_rng(4)
    for _ in range(50):
        left, right = (pick.integers(0, 2, size) for size in ((pick.integers(1, 8), 6), (6, pick.integers(1, 8))))
        sparse = []
        for dense in (left, right):
            begins = np.concatenate([[0], np.cumsum(dense.sum(axis=1))])
            sparse.append(alignment.Csr(begins, np.nonzero(dense)[1], dense.shape[1]))
        rows, columns, values = alignment.product(*sparse)
        out = np.zeros((left.shape[0], right.shape[1]), dtype=int)
        out[rows, columns] = values
        assert (out == left @ right).all()
        assert alignment.product_sizes(*sparse).tolist() == (left @ right).sum(axis=1).tolist()
        flipped = alignment.transposed(sparse[0])
        assert [flipped.columns[a:b].tolist() for a, b in zip(flipped.begins, flipped.begins[1:])] == [np.flatnonzero(c).tolist() for c in left.T]


def test_links_and_groups_of_documents(spark, edge_docs, libraries):
    a, b = libraries
    for row in alignment.align_documents(edge_docs, *PATHS).collect():
        ends_a = np.cumsum([len(spell_a(a, x)) for x in row["ids_a"]]).tolist()
        ends_b = np.cumsum([len(spell_b(b, x)) for x in row["ids_b"]]).tolist()
        want = []
        i = j = at = 0
        while i < len(ends_a):
            end = min(ends_a[i], ends_b[j])
            want.append((i, j, end - at))
            at, i, j = end, i + (ends_a[i] == end), j + (ends_b[j] == end)
        assert [tuple(x) for x in row["links"]] == want
        assert [g["end"] for g in row["groups"]] == sorted(set(ends_a) & set(ends_b))
        assert sum(g["n_a"] for g in row["groups"]) == len(ends_a) and sum(g["n_b"] for g in row["groups"]) == len(ends_b)
