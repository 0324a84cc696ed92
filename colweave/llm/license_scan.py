"""Licence texts found through a positional index of their rarest words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colweave.llm.text import LOWER, flat, slices, span_hash, word_spans

WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True

#: Fixed by contract: phrase and its label.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


@dataclass(frozen=True)
class Template:
    """A licence passage; ``phrases`` must stand in it word by word."""

    label: str
    text: str
    phrases: tuple[str, ...]


TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        ("you may not use this file except in compliance with the license",),
    ),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
        ("permission is hereby granted free of charge", "to any person obtaining a copy"),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        ("redistribution and use in source and binary forms", "following conditions are met"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        ("for any purpose with or without fee is hereby granted",),
    ),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template("gpl-2.0", "licensed under the GNU General Public License, version 2", ("gnu general public license version 2",)),
    Template("lgpl", "GNU Lesser General Public License", ("lesser general public license",)),
    Template("agpl", "GNU Affero General Public License", ("affero general public license",)),
    Template("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-nd", "Licensed under CC BY-ND 4.0", ("cc by nd",)),
    Template("cc0", "CC0 1.0 Universal Public Domain Dedication", ("cc0 1 0",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)


@dataclass(frozen=True)
class Params:
    """``anchors`` highest-IDF words stand for a template; a place counts if anchors of at least
    ``coverage`` of their IDF agree on where the template starts, give or take ``slack`` words."""

    anchors: int = 8
    coverage: float = 0.6
    slack: int = 2
    templates: tuple[Template, ...] = TEMPLATES
    base: tuple[tuple[str, str], ...] = field(default=BASE)


def _words(text: str) -> list[bytes]:
    low = LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = word_spans(low, np.array([0, len(low)]), WORD)
    return [low[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]


@dataclass(frozen=True)
class _Vocabulary:
    """Numbers for the words that any template or phrase holds; every other word is -1."""

    hashes: np.ndarray
    numbers: np.ndarray
    number_of: dict[bytes, int]

    @staticmethod
    def of(texts: Iterable[str]) -> _Vocabulary:
        words = sorted({w for t in texts for w in _words(t)})
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        hashes = span_hash(data, np.concatenate([[0], ends[:-1]]), ends)
        order = np.argsort(hashes)
        return _Vocabulary(hashes[order], order, {w: i for i, w in enumerate(words)})

    def read(self, text: str) -> np.ndarray:
        return np.array([self.number_of[w] for w in _words(text)], np.int64)

    def number(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers of all texts, first word per text)"""
        data, offsets = flat(column)
        low = LOWER[data]
        starts, ends, first = word_spans(low, offsets, WORD)
        hashes = span_hash(low, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], -1), first


def _places(ids: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Starts of the phrase in a run of word numbers."""
    if len(ids) < len(phrase):
        return np.zeros(0, np.int64)
    span = len(ids) - len(phrase) + 1
    at = np.flatnonzero(ids[:span] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[ids[at + k] == phrase[k]]
    return at


def document_frequency(docs: DataFrame, vocabulary: _Vocabulary) -> tuple[int, dict[int, int]]:
    """(documents, documents that hold each licence word), over whole texts of all documents."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(vocabulary.hashes)
        held, n = np.zeros(size, np.int64), 0
        for part in slices(batches, "text"):
            ids, first = vocabulary.number(part.column("text"))
            doc = np.repeat(np.arange(part.num_rows), np.diff(first))
            known = ids >= 0
            held += np.bincount(np.unique(doc[known] * size + ids[known]) % size, minlength=size)
            n += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(size)], pa.int32()), pa.array([n, *held], pa.int64())], names=["word", "n"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r.word: r.n for r in rows}
    return found.pop(-1, 0), found


def scan(docs: DataFrame, params: Params | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches) for every row of
    documents (doc_id, text).

    Words are runs of a-z, 0-9 and non-ASCII after lower-casing A-Z; a null text is
    empty and has no words. ``n_base`` counts all places of the base phrases,
    ``first_word`` and ``last_word`` are the smallest and largest of their starts
    (null without any). ``matches`` lists (label, start, words, coverage) of the templates
    found; ``labels`` joins their labels with the base ones. ``score`` is the best
    coverage, 1 with a base phrase, 0 without anything. Repeated rows stay and other
    columns are not read.

    IDF comes from all documents (one count per licence word and task). The
    index holds the anchors of a fixed template list, so it is bounded and goes to
    every task; nothing is shuffled in the scan.
    """
    p = params or Params()
    vocabulary = _Vocabulary.of([t for t, _ in p.base] + [x for t in p.templates for x in (t.text, *t.phrases)])
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    n, held = document_frequency(docs, vocabulary)
    idf = np.log((n + 1) / (np.array([held.get(i, 0) for i in range(len(vocabulary.hashes))]) + 1)) + 1e-6

    postings: dict[int, list[tuple[int, int]]] = {}
    weight: dict[tuple[int, int], float] = {}
    length, total = [], np.zeros(len(p.templates))
    for k, template in enumerate(p.templates):
        words = vocabulary.read(template.text)
        length.append(len(words))
        # Ties go to the earlier word.
        for at in np.argsort(-idf[words], kind="stable")[: p.anchors]:
            postings.setdefault(int(words[at]), []).append((k, int(at)))
            weight[k, int(at)] = idf[words[at]]
            total[k] += idf[words[at]]
    pairs = [(w, k, at) for w in sorted(postings) for k, at in postings[w]]
    post_template = np.array([x[1] for x in pairs], np.int64)
    post_at = np.array([x[2] for x in pairs], np.int64)
    post_weight = np.array([weight[x[1:]] for x in pairs])
    begin = np.searchsorted([x[0] for x in pairs], np.arange(len(vocabulary.hashes) + 1))
    phrases = [[vocabulary.read(x) for x in t.phrases] for t in p.templates]
    base = [(vocabulary.read(text), label) for text, label in p.base]

    def templates_in(ids: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(text, template, start, coverage) of every verified place."""
        many = np.where(ids >= 0, begin[ids + 1] - begin[ids], 0)
        hit = np.flatnonzero(many)
        if not len(hit):
            return []
        word = np.repeat(hit, many[hit])
        step = np.arange(len(word)) - np.repeat(np.cumsum(many[hit]) - many[hit], many[hit])
        post = begin[ids[word]] + step
        doc = np.searchsorted(first, word, "right") - 1
        start, template = word - post_at[post], post_template[post]
        order = np.lexsort((start, template, doc))
        doc, start, template, post = doc[order], start[order], template[order], post[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (template[1:] != template[:-1]) | (start[1:] - start[:-1] > p.slack)
        group = np.cumsum(new) - 1
        # Each anchor counts once for a place.
        once = np.unique(group * len(post_at) + post)
        covered = np.bincount(once // len(post_at), post_weight[once % len(post_at)]) / total[template[new]]
        out = []
        for g in np.flatnonzero(covered >= p.coverage):
            row = np.flatnonzero(new)[g]
            k, d = int(template[row]), int(doc[row])
            lo = max(int(first[d]), int(start[row]) - p.slack)
            hi = min(int(first[d + 1]), int(start[group == g].max()) + length[k] + p.slack)
            if all(len(_places(ids[lo:hi], phrase)) for phrase in phrases[k]):
                out.append((d, k, int(start[row]) - int(first[d]), float(min(1.0, covered[g]))))
        return out

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            ids, first = vocabulary.number(part.column("text"))
            rows = part.num_rows
            count, low, high = np.zeros(rows, np.int64), [None] * rows, [None] * rows
            own: list[set[str]] = [set() for _ in range(rows)]
            matches: list[list] = [[] for _ in range(rows)]
            for phrase, label in base:
                at = _places(ids, phrase)
                doc = np.searchsorted(first, at, "right") - 1
                inside = at + len(phrase) <= first[doc + 1]
                for d, place in zip(doc[inside].tolist(), (at - first[doc])[inside].tolist(), strict=True):
                    count[d] += 1
                    low[d] = place if low[d] is None else min(low[d], place)
                    high[d] = place if high[d] is None else max(high[d], place)
                    own[d].add(label)
            for d, k, start, coverage in templates_in(ids, first):
                matches[d].append({"label": p.templates[k].label, "start": max(0, start), "words": length[k], "coverage": coverage})
            labels = [own[d] | {m["label"] for m in matches[d]} for d in range(rows)]
            score = [1.0 if own[d] else max((m["coverage"] for m in matches[d]), default=0.0) for d in range(rows)]
            kind = pa.struct([("label", pa.string()), ("start", pa.int64()), ("words", pa.int32()), ("coverage", pa.float64())])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(np.diff(first), pa.int64()), pa.array(count, pa.int64()),
                    pa.array(low, pa.int64()), pa.array(high, pa.int64()),
                    pa.array([",".join(sorted(x)) for x in own], pa.string()),
                    pa.array([",".join(sorted(x)) for x in labels], pa.string()),
                    pa.array(score, pa.float64()), pa.array(matches, pa.list_(kind)),
                ],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"],
            )

    return docs.mapInArrow(
        look,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, matches array<struct<label string, start long, words int, coverage double>>",
    )
