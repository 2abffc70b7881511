"""License scan: exact set-similarity join of text blocks with license templates.

Words are maximal runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` in the text with
A-Z lower-cased.  A text block is a window of ``block`` words that starts at every
multiple of ``block / 2``: whatever is at most ``block / 2`` words long lies whole
in one.  A block matches a template when it holds at least ``threshold`` of the
template's distinct words.

The join is exact.  A first pass counts the templates' words over all documents;
each template's words are ordered from the rarest on.  A match must hold one of
the first |T| - need + 1 of them (prefix filter), must have ``need`` distinct words
(length filter), and its first matching word at place i of the template leaves at
most |T| - i (positional filter); what remains is counted exactly.  Templates are
a bounded parameter, so that they travel with the tasks and no text is shuffled.

Besides, ``PHRASES`` are found word by word, wherever their words stand
consecutively.

Defined cases: a null text counts as empty; a text without words has no block and
score 0; places may come from several phrases and are all kept; repeated rows are
scanned each; an empty table gives an empty table; other columns are not read.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ALNUM_WORDS, text_of

# The phrases of the contract with their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Notices from public licenses with the label of each.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license "
                 "is distributed on an as is basis without warranties"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
]
THRESHOLD, BLOCK = 0.9, 64
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = rb"[^0-9a-z\x80-\xff]+"


def words_of(text: str) -> list[bytes]:
    return _WORDS.findall(text.encode("utf-8", "surrogatepass").lower())


def word_counts(docs: DataFrame, vocabulary: set[bytes], text_col: str = "text") -> dict[bytes, int]:
    """How often each word of the (bounded) vocabulary stands in all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                own = Counter(words_of(t))
                for w in vocabulary & own.keys():
                    counts[w] += own[w]
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()),
                                          pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    parts = docs.select(text_of(docs, text_col).alias("t")).mapInArrow(run, "word string, n long")
    return {r["word"].encode(): r["n"] for r in parts.groupBy("word").agg(F.sum("n").alias("n")).collect()}


class Templates:
    """Templates ordered by global word frequency, with their prefix index."""

    def __init__(self, templates: list[tuple[str, str]], counts: dict[bytes, int], threshold: float, block: int):
        self.block, self.stride = block, block // 2
        self.labels, self.sets, self.need, self.place = [], [], [], []
        self.prefix: dict[bytes, list[int]] = {}
        for i, (label, text) in enumerate(templates):
            words = words_of(text)
            if len(words) > self.stride:
                raise ValueError(f"a template has {len(words)} words; blocks of {block} hold at most {self.stride}")
            order = sorted(set(words), key=lambda w: (counts.get(w, 0), w))
            need = max(1, -int(-threshold * len(order) // 1))
            self.labels.append(label)
            self.sets.append(frozenset(order))
            self.need.append(need)
            self.place.append({w: k for k, w in enumerate(order)})
            for w in order[:len(order) - need + 1]:
                self.prefix.setdefault(w, []).append(i)

    def matches(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(template, block, overlap) of every block that meets the threshold."""
        at: dict[bytes, list[int]] = {}
        rare = self.prefix.keys()
        for k, w in enumerate(words):
            if w in rare:
                at.setdefault(w, []).append(k)
        pairs = {(i, b) for w, places in at.items() for i in self.prefix[w] for k in places
                 for b in ((k // self.stride - 1, k // self.stride) if k >= self.stride else (0,))}
        blocks: dict[int, set] = {}
        out = []
        for i, b in sorted(pairs):
            if b not in blocks:
                blocks[b] = set(words[b * self.stride:b * self.stride + self.block])
            own, need = blocks[b], self.need[i]
            if len(own) < need:  # length filter
                continue
            places = sorted(self.place[i][w] for w in own & self.sets[i])
            if len(self.sets[i]) - places[0] < need or len(places) < need:  # positional filter, then the count
                continue
            out.append((i, b, len(places)))
        return out


def _phrase_patterns(phrases: dict[str, str]) -> list[tuple[str, bytes, re.Pattern, int]]:
    out = []
    for phrase, label in phrases.items():
        words = words_of(phrase)
        rarest = max(words, key=len)
        out.append((label, rarest, re.compile(_GAP.join(map(re.escape, words)) + rb"(?![0-9a-z\x80-\xff])"), len(words)))
    return out


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
         threshold: float = THRESHOLD, block: int = BLOCK, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """id, n_words, places [(label, word)] of phrases, blocks [(label, word, containment)] of templates."""
    vocabulary = {w for _, t in templates for w in words_of(t)}
    counts = word_counts(docs, vocabulary, text_col)
    index = Templates(templates, counts, threshold, block)
    patterns = _phrase_patterns(phrases)
    rows = docs.select(docs[id_col].alias(id_col), text_of(docs, text_col).alias("__t"))
    kind = dict(rows.dtypes)[id_col]
    place = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
    found = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("containment", pa.float64())]))

    def one(text: str):
        raw = text.encode("utf-8", "surrogatepass").lower()
        flat = np.frombuffer(raw, np.uint8)
        word = ALNUM_WORDS[flat] > 0
        first = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]])) if len(flat) else np.zeros(0, np.int64)
        places, blocks = [], []
        for label, rarest, pattern, _ in patterns:
            if rarest not in raw:
                continue
            for m in pattern.finditer(raw):
                if m.start() and word[m.start() - 1]:
                    continue
                places.append({"label": label, "word": int(np.searchsorted(first, m.start()))})
        if any(w in raw for w in index.prefix):
            for i, b, n in index.matches(_WORDS.findall(raw)):
                blocks.append({"label": index.labels[i], "word": b * index.stride,
                               "containment": n / len(index.sets[i])})
        return len(first), places, blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [one(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], place),
                 pa.array([g[2] for g in got], found)], names=["id", "n_words", "places", "blocks"])

    out = rows.mapInArrow(run, f"id {kind}, n_words long, places array<struct<label:string,word:bigint>>, "
                               "blocks array<struct<label:string,word:bigint,containment:double>>")
    return out.withColumnRenamed("id", id_col)


def summary(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: base places, labels and the best containment (1 for a phrase)."""
    label = lambda c: F.transform(c, lambda x: x["label"])
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    word = F.transform("places", lambda x: x["word"])
    best = F.array_max(F.transform("blocks", lambda x: x["containment"]))
    return scanned.select(
        id_col, "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(word).alias("first_word"), F.array_max(word).alias("last_word"),
        joined(label("places")).alias("base_labels"),
        joined(F.concat(label("places"), label("blocks"))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"))
