"""License scans by an exact set-similarity join of text blocks with license templates (operator 6).

Blocks are the lines of a text, and its paragraphs of several lines. A block's and a template's set hold their distinct word pairs, in
the order of how often the pairs occur in the whole corpus, rarest first. A block meets a template if it holds at least
`CONTAINED` of its pairs. Then they share one of the template's first |T| - ceil(c |T|) + 1 pairs (prefix filter), the block has at least
ceil(c |T|) pairs (length filter), and the template's pairs from the shared one on must suffice (positional filter).

Notices of sibling licenses differ in a few words, fewer than the threshold lets go. Where another label's template lacks so few of a template's pairs that
its own text could meet it, a block must hold all of those pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lampyris.llm.words import NOT_ALNUM, Texts, mix, pieces, utf8

CONTAINED = 0.8

#: Words that must stand one after the other, and their label.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Public license notices and their label.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
)

_NEXT = np.uint64(0xD6E8FEB86659FD93)


def _words(texts: list[str]) -> Texts:
    return Texts(*utf8(pa.array(texts)), NOT_ALNUM)


def _pairs(hashes: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring words; the last place has none and is left out."""
    return mix(hashes[:-1] * _NEXT + hashes[1:])


def _own_words(text: str) -> np.ndarray:
    return _words([text]).hash


def _template_pairs(templates: tuple) -> list[np.ndarray]:
    return [np.unique(_pairs(_own_words(t))) for _, t in templates]


def pair_frequencies(docs: DataFrame, templates: tuple = TEMPLATES) -> dict[int, int]:
    """How often each word pair of the templates occurs in all texts; as many numbers as the templates have pairs."""
    wanted = np.unique(np.concatenate(_template_pairs(templates)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(wanted), np.int64)
        for batch in pieces(batches, "text"):
            words = Texts(*utf8(batch.column("text")), NOT_ALNUM)
            if len(words.hash) > 1:
                found = _pairs(words.hash)
                at = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)
                seen += np.bincount(at[wanted[at] == found], minlength=len(wanted))
        yield pa.record_batch({"pair": pa.array(wanted.view(np.int64)), "n": pa.array(seen)})

    rows = docs.select("text").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    return {int(np.int64(r.pair).view(np.uint64)): r.n for r in rows}


def telling_pairs(templates: tuple, contained: float = CONTAINED) -> list[set[int]]:
    """For each template, the pairs that tell it apart from every template of another label whose text could meet it."""
    sets = [set(pairs.tolist()) for pairs in _template_pairs(templates)]
    out: list[set[int]] = [set() for _ in sets]
    for t, own in enumerate(sets):
        for u, other in enumerate(sets):
            if templates[t][0] != templates[u][0] and len(own & other) >= contained * len(own):
                out[t] |= own - other
    return out


class Scanner:
    """Templates in corpus order, with what the filters need."""

    def __init__(self, frequencies: dict[int, int], templates: tuple, contained: float):
        self.labels = [label for label, _ in templates]
        self.sets, self.need, self.index = [], [], {}
        self.telling = telling_pairs(templates, contained)
        for t, pairs in enumerate(_template_pairs(templates)):
            ordered = sorted(pairs.tolist(), key=lambda p: (frequencies.get(p, 0), p))
            need = -int(-len(ordered) * contained // 1)
            self.sets.append(ordered)
            self.need.append(need)
            for place, pair in enumerate(ordered[: len(ordered) - need + 1]):
                self.index.setdefault(pair, []).append((t, place))
        self.prefix = np.array(sorted(self.index), np.uint64)

    def matches(self, block: set[int]) -> dict[int, float]:
        """Templates that the block holds, and how much of each."""
        found, refused = {}, set()
        for pair in block & self.index.keys():
            for t, place in self.index[pair]:
                if t in found or t in refused or len(block) < self.need[t] or len(self.sets[t]) - place < self.need[t]:
                    continue
                share = len(block.intersection(self.sets[t]))
                if share >= self.need[t] and self.telling[t] <= block:
                    found[t] = share / len(self.sets[t])
                else:
                    refused.add(t)
        return found


def _blocks(text: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For the words of one text: number of their line, and of their paragraph (lines between blank ones)."""
    breaks = np.flatnonzero(text == 10)
    line = np.searchsorted(breaks, starts)
    blank = np.concatenate(([False], np.diff(breaks) == 1)) if len(breaks) else np.zeros(0, bool)
    return [line, np.searchsorted(breaks[blank], starts)]


def license_scan(docs: DataFrame, templates: tuple = TEMPLATES, contained: float = CONTAINED) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks of every document.

    n_base counts the places of the base phrases, first_word and last_word are their smallest and largest start (else null).
    labels also holds those of templates that a block meets; score is the largest share of a template found, 1 with a base
    phrase, else 0; a block that lacks a pair which tells a template from its siblings does not meet it; n_blocks counts blocks that meet a template. Null and empty texts have no words. Equal rows are
    scanned alike; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    frequencies = pair_frequencies(docs, templates)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(frequencies, templates, contained)
        phrases = [(_own_words(p), label) for p, label in PHRASES]
        for batch in pieces(batches, "text"):
            data, bounds = utf8(batch.column("text"))
            words = Texts(data, bounds, NOT_ALNUM)
            n, count = len(bounds) - 1, np.diff(words.first)
            owner = np.repeat(np.arange(n), count)
            n_base, first, last = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            base: list[set] = [set() for _ in range(n)]
            for phrase, label in phrases:
                k = len(phrase)
                at = np.flatnonzero(words.hash[: max(0, len(words.hash) - k + 1)] == phrase[0])
                for j in range(1, k):
                    at = at[words.hash[at + j] == phrase[j]]
                at = at[owner[at] == owner[at + k - 1]] if len(at) else at
                place = at - words.first[owner[at]]
                np.add.at(n_base, owner[at], 1)
                np.minimum.at(first, owner[at], place)
                np.maximum.at(last, owner[at], place)
                for i in np.unique(owner[at]):
                    base[i].add(label)
            score = np.array([1.0 if b else 0.0 for b in base])
            labels, n_blocks = [set(b) for b in base], np.zeros(n, np.int64)
            if len(words.hash) > 1:
                pairs = _pairs(words.hash)
                at = np.minimum(np.searchsorted(scanner.prefix, pairs), len(scanner.prefix) - 1)
                hits = np.flatnonzero((scanner.prefix[at] == pairs) & (owner[:-1] == owner[1:]))
                for i in np.unique(owner[hits]):
                    a, b = words.first[i], words.first[i + 1]
                    text = data[bounds[i] : bounds[i + 1]]
                    line, paragraph = _blocks(text, words.start[a:b] - bounds[i])
                    for k, block in enumerate((line, paragraph)):
                        for no in np.unique(block[hits[owner[hits] == i] - a]):
                            lo, hi = np.searchsorted(block, [no, no + 1])
                            if k and line[lo] == line[hi - 1]:
                                continue
                            met = scanner.matches(set(pairs[a + lo : a + hi - 1].tolist()))
                            n_blocks[i] += bool(met)
                            labels[i].update(scanner.labels[t] for t in met)
                            score[i] = max([score[i], *met.values()])
            none = n_base == 0
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_words": pa.array(count, pa.int64()), "n_base": pa.array(n_base),
                "first_word": pa.array(first, pa.int64(), mask=none), "last_word": pa.array(last, pa.int64(), mask=none),
                "base_labels": pa.array([",".join(sorted(b)) for b in base]), "labels": pa.array([",".join(sorted(x)) for x in labels]),
                "score": pa.array(score), "n_blocks": pa.array(n_blocks),
            })

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_blocks long"
    return docs.mapInArrow(scan, schema)
