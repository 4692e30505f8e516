"""License scan: places of license phrases, and an exact set-similarity join of text blocks with license templates.

A template is the set of its words. A block is a window of twice a template's words, and windows overlap by half, so that
any passage as long as the template lies within one. A block meets a template when it holds at least the threshold's
share of the template's words.

The join is exact and looks at few blocks. Words are put in one global order, rarest first, by their counts over all
texts. A block that holds t of a template's n words must hold one of the first n - t + 1 (prefix filter); it must have t
words (length filter); and if the first of the template's words that it holds is the k-th, it can hold n - k + 1 at most
(positional filter). Only blocks that pass are counted out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from geosync.llm.staging import documents, tidy
from geosync.llm.textbytes import LOWER, Hashes, Slice, text_slices

#: Characters of words: digits, letters, and all beyond ASCII.
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: Fixed phrases and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: Label and words of each template; public license notices and their usual short forms.
TEMPLATES = (
    ("apache-2.0-notice", "licensed under the apache license version 2 0"),
    ("apache-2.0-header", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("mit-notice", "released under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd-grant", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("gpl-notice", "this work is licensed under the gnu general public license version 3"),
    ("gpl-header", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl-header", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl-header", "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("mpl-header", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc-notice", "licensed under cc by nc 4 0"),
    ("cc-by-sa-notice", "licensed under cc by sa 4 0"),
    ("cc-by-header", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0-notice", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense-notice", "this is free and unencumbered software released into the public domain"),
)
THRESHOLD = 0.85
RESULT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def word_hashes(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every word, A to Z lower-cased."""
    data = LOWER[part.data]
    starts, ends, text = part.runs(WORD[data])
    return Hashes(data).of(starts, ends), text


def hashed(words: str) -> np.ndarray:
    data = np.frombuffer(words.encode(), np.uint8)
    return word_hashes(Slice(0, 1, data, np.array([0, len(data)])))[0]


class Templates:
    """Hashed templates with their words in the global order."""

    def __init__(self, templates: tuple[tuple[str, str], ...], counts: dict[int, int], threshold: float):
        self.labels = [label for label, _ in templates]
        self.sizes, self.needed, self.orders, self.windows = [], [], [], []
        for _, words in templates:
            own = hashed(words)
            order = sorted({int(h) for h in own}, key=lambda h: (counts.get(h, 0), h))
            self.orders.append(np.array(order, np.uint64))
            self.sizes.append(len(order))
            self.needed.append(max(1, math.ceil(round(threshold * len(order), 9))))
            self.windows.append(len(own))
        self.prefixes = [order[: n - t + 1] for order, n, t in zip(self.orders, self.sizes, self.needed)]
        self.rare = np.unique(np.concatenate(self.prefixes)) if self.prefixes else np.zeros(0, np.uint64)


def member(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which words are in a sorted table."""
    if not len(table):
        return np.zeros(len(words), bool)
    at = np.searchsorted(table, words)
    return table[np.minimum(at, len(table) - 1)] == words


def join(words: np.ndarray, text: np.ndarray, n: int, templates: Templates) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Template, and per block that meets it: the block's text and its containment."""
    starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))])
    rare = np.flatnonzero(member(words, templates.rare))
    for k, (order, size, needed, half) in enumerate(zip(templates.orders, templates.sizes, templates.needed, templates.windows)):
        hits = rare[member(words[rare], np.sort(templates.prefixes[k]))]
        if not len(hits):
            continue
        owner = text[hits]
        block = (hits - starts[owner]) // half  # blocks are (j, j + 1) halves; a word lies in those from j - 1 and j
        pairs = np.unique(np.concatenate([np.stack([owner, block]), np.stack([owner, np.maximum(block - 1, 0)])], axis=1), axis=1)
        owner = pairs[0]
        lo = starts[owner] + pairs[1] * half
        hi = np.minimum(lo + 2 * half, starts[owner + 1])
        long = hi - lo >= needed
        owner, lo, hi = owner[long], lo[long], hi[long]
        at = lo[:, None] + np.arange(2 * half)
        inside = at < hi[:, None]
        block_words = words[np.minimum(at, len(words) - 1)]
        found = np.zeros(len(lo), np.int64)
        alive = np.arange(len(lo))
        for place, word in enumerate(order):
            # what is found and what may yet come must reach the threshold
            alive = alive[found[alive] + size - place >= needed]
            if not len(alive):
                break
            found[alive] += ((block_words[alive] == word) & inside[alive]).any(axis=1)
        met = found >= needed
        if met.any():
            yield k, owner[met], found[met] / size


def phrase_places(words: np.ndarray, text: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where a phrase's words stand consecutively in one text."""
    at = np.flatnonzero(words == phrase[0])
    at = at[at + len(phrase) <= len(words)]
    for k in range(1, len(phrase)):
        at = at[(words[at + k] == phrase[k]) & (text[at + k] == text[at])]
    return at


def template_counts(docs: DataFrame, text_column: str, templates: tuple[tuple[str, str], ...]) -> dict[int, int]:
    """How often each word of the templates stands in all texts; as many rows as the templates have words."""
    table = np.unique(np.concatenate([hashed(words) for _, words in templates])) if templates else np.zeros(0, np.uint64)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(table), np.int64)
        for batch in batches:
            for part in text_slices(batch.column(0)):
                words, _ = word_hashes(part)
                total += np.bincount(np.searchsorted(table, words[member(words, table)]), minlength=len(table))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(table))), pa.array(total)], names=["k", "n"])

    rows = docs.select(docs[text_column].cast("string")).mapInArrow(tidy(count), "k long, n long").groupBy("k").sum("n").collect()
    return {int(table[k]): n for k, n in rows}


def scan(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES,
    phrases: tuple[tuple[str, str], ...] = PHRASES, threshold: float = THRESHOLD,
) -> DataFrame:
    """Per document its words, phrase places and labels. ``score``: 1 with a phrase, else the best containment met, else 0.

    A null or empty text has no words and no labels (empty strings, null places). Repeated rows each give a row; other
    columns are not read. Two passes over the texts, without a shuffle but for the templates' word counts.
    """
    known = Templates(templates, template_counts(docs, text_column, templates), threshold)
    searched = [(hashed(words), label) for words, label in phrases]
    names = [x.split()[0] for x in RESULT.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in names[1:]]
            for part in text_slices(batch.column(1)):
                words, text = word_hashes(part)
                n = len(part)
                starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))])
                base: list[set[str]] = [set() for _ in range(n)]
                extra: list[set[str]] = [set() for _ in range(n)]
                score = np.zeros(n)
                places = []
                for phrase, label in searched:
                    at = phrase_places(words, text, phrase)
                    places.append(at)
                    for owner in np.unique(text[at]).tolist():
                        base[owner].add(label)
                        score[owner] = 1.0
                for k, owners, shares in join(words, text, n, known):
                    np.maximum.at(score, owners, shares)
                    for owner in np.unique(owners).tolist():
                        extra[owner].add(known.labels[k])
                at = np.sort(np.concatenate(places)) if places else np.zeros(0, np.int64)
                count = np.bincount(text[at], minlength=n)
                ends = np.cumsum(count)
                first = [int(at[e - c] - starts[i]) if c else None for i, (e, c) in enumerate(zip(ends, count))]
                last = [int(at[e - 1] - starts[i]) if c else None for i, (e, c) in enumerate(zip(ends, count))]
                values = (
                    np.diff(starts).tolist(), count.tolist(), first, last, [",".join(sorted(x)) for x in base],
                    [",".join(sorted(x | y)) for x, y in zip(base, extra)], score.tolist(),
                )
                for column, value in zip(columns, values):
                    column.extend(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))], names=names)

    return docs.select(docs[id_column].cast("long"), docs[text_column].cast("string")).mapInArrow(tidy(run), RESULT)


def op7_license_similarity_join(spark: SparkSession, folder: str) -> DataFrame:
    return scan(documents(spark, folder))
