"""Licence scan with a positional index of rare words.

Templates are indexed by word: in which template and at which place a word stands. Only the words
with the highest inverse document frequency are looked up: so many of each template that a text
without any of them can't reach the accepted share of the template's weight. A hit gives a template
and a start; the other words are compared at their relative places, and a phrase that must be there
is verified word for word. All this happens inside the row of a document.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torquelake.llm.common import TERM, ascii_lower

# Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices of well-known licences, in words, with the phrase that must be there.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc-attribution", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "released into the public domain"),
)

#: Share of a template's weight that has to be found.
ACCEPTED = 0.8


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    weights: tuple[float, ...]  # they add up to 1
    phrase: tuple[str, ...]
    phrase_at: int
    anchors: tuple[str, ...]


def vocabulary(templates=TEMPLATES) -> list[str]:
    return sorted({w for _, text, _ in templates for w in text.split()})


def weighted(templates, idf: dict[str, float], accepted: float = ACCEPTED) -> list[Template]:
    """Templates with weights by idf, and as anchors their rarest words with more than ``1 - accepted`` of it."""
    out = []
    for label, text, phrase in templates:
        words, wanted = text.split(), phrase.split()
        total = sum(idf[w] for w in words)
        weights = [idf[w] / total for w in words]
        anchors, mass = [], 0.0
        for w in sorted(set(words), key=lambda w: (-idf[w], w)):
            if mass > 1 - accepted + 1e-9:
                break
            anchors.append(w)
            mass += sum(x for x, y in zip(weights, words, strict=True) if y == w)
        at = next(i for i in range(len(words)) if words[i : i + len(wanted)] == wanted)
        out.append(Template(label, tuple(words), tuple(weights), tuple(wanted), at, tuple(anchors)))
    return out


def terms(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    return rows.select("doc_id", F.regexp_extract_all(ascii_lower(F.col("_text")), F.lit(TERM), F.lit(0)).alias("_w"))


def document_frequencies(rows: DataFrame, words: list[str]) -> dict[str, float]:
    """Inverse document frequency of the words of the templates, over all documents.

    One row for each word of the templates comes to the driver, whatever the documents are.
    """
    present = F.array_distinct(F.filter("_w", lambda x: x.isin(words)))
    found = rows.select(F.explode(F.array_append(present, F.lit(""))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    counts = {r["word"]: r["n"] for r in found.collect()}
    total = counts.get("", 0)
    return {w: math.log((total + 1) / (counts.get(w, 0) + 0.5)) for w in words}


def _strings(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def license_scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for every row.

    ``score`` is the largest share of a template's weight found at one place, 1 where a base phrase
    stands. A null or empty text has no words, no labels (empty strings) and score 0. Rows that repeat
    are scanned as often; an empty table gives an empty result; other columns are left out.
    """
    rows = terms(docs, id_col, text_col)
    index = weighted(templates, document_frequencies(rows, vocabulary(templates)))
    postings = [(w, t, i) for t, x in enumerate(index) for i, w in enumerate(x.words) if w in x.anchors]
    looked_up = sorted({w for w, _, _ in postings} | {p.split()[0] for p in phrases})

    places = F.filter(F.transform("_w", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(looked_up))
    rows = rows.select("doc_id", "_w", F.size("_w").cast("bigint").alias("n_words"), places.alias("_at"))

    def stands(words, at: Column) -> Column:
        return F.slice("_w", at + 1, len(words)) == _strings(words)

    def phrase_places(words: list[str]) -> Column:
        starts = F.filter("_at", lambda x: (x["w"] == words[0]) & stands(words, x["i"]))
        return F.transform(starts, lambda x: x["i"])

    base = F.array(
        *[F.struct(F.lit(label).alias("label"), phrase_places(p.split()).alias("at")) for p, label in phrases.items()]
    )
    rows = rows.withColumn("_base", F.when(F.size("_at") > 0, base))

    posted = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(t).alias("t"), F.lit(i).alias("p")) for w, t, i in postings])
    starts = F.flatten(F.transform("_at", lambda x: F.transform(
        F.filter(posted, lambda p: p["w"] == x["w"]), lambda p: F.struct(p["t"].alias("t"), (x["i"] - p["p"]).alias("s")))))
    rows = rows.withColumn("_starts", F.when(F.size("_at") > 0, F.array_distinct(starts)))

    def compared(x: Column) -> Column:
        """What a template finds from a start on: its label, the share, whether the phrase is there."""
        out = F.lit(None)
        for t, template in enumerate(index):
            found = sum((F.when(F.get("_w", x["s"] + i) == w, F.lit(weight)).otherwise(F.lit(0.0))
                         for i, (w, weight) in enumerate(zip(template.words, template.weights, strict=True))), F.lit(0.0))
            phrase_at = x["s"] + template.phrase_at
            there = F.when(phrase_at >= 0, stands(template.phrase, F.greatest(phrase_at, F.lit(0)))).otherwise(F.lit(False))
            one = F.struct(F.lit(template.label).alias("label"), found.alias("share"), there.alias("there"))
            out = F.when(x["t"] == t, one).otherwise(out)
        return out

    rows = rows.withColumn("_found", F.when(F.size("_starts") > 0, F.transform("_starts", compared)))
    rows = rows.withColumn("_starts_base", F.expr("flatten(transform(_base, x -> x.at))"))
    none = F.array().cast("array<string>")
    base_labels = F.coalesce(F.expr("transform(filter(_base, x -> size(x.at) > 0), x -> x.label)"), none)
    own = F.coalesce(F.expr(f"transform(filter(_found, x -> x.there AND x.share >= {ACCEPTED}D - 1e-9D), x -> x.label)"), none)
    best = F.coalesce(F.expr("array_max(transform(_found, x -> x.share))"), F.lit(0.0))
    n_base = F.when(F.col("_starts_base").isNull(), 0).otherwise(F.size("_starts_base"))
    return rows.select(
        "doc_id",
        "n_words",
        n_base.cast("bigint").alias("n_base"),
        F.array_min("_starts_base").cast("bigint").alias("first_word"),
        F.array_max("_starts_base").cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, own))), ",").alias("labels"),
        F.when(n_base > 0, F.lit(1.0)).otherwise(F.least(best, F.lit(1.0))).alias("score"),
    )
