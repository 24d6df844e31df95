"""License phrases and license notices in texts.

Phrases are found as consecutive words. Notices are found by an exact set-similarity join of
text blocks with templates: a block matches a template if it contains at least CONTAINED of the
template's distinct words. A block is one line of any length, or a run of up to LINES lines, none
without a word, that together have at most twice as many words as the template: notices are
mostly wrapped. Of runs within each other that contain as much of a template, only the shortest count.

Method. Words of templates are ordered by how many blocks of the whole corpus have them, rarest
first. A block that contains enough of a template's words has one of its first
``size - needed + 1`` in that order (prefix filter), has at least ``needed`` distinct words
(length filter), and from the first word they share on, both must have enough words left in the
order (positional filter). What passes is compared exactly, so nothing is missed. The templates
are a fixed small table that every task holds; texts are never shuffled.

All matches are returned. A match is the best for its lines unless another one that shares a line
explains it: the other template has all words that this one shares with its block, and more of it is
there, or as much of it and it is the wider one. So a notice of one license does not count as its neighbour in wording.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeloom.llm import words as W
from treeloom.llm.tables import slices

CONTAINED = 0.8
#: Most lines of a wrapped notice.
LINES = 5

#: Phrases and the labels they give.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Usual notices of licenses and first sentences of their texts.
TEMPLATES = (
    ("mit-notice", "Released under the MIT License."),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
     "and associated documentation files"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "You may not use this file except in compliance with the License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "Lesser General Public License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
     "is hereby granted"),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("all-rights-reserved", "Copyright. All rights reserved."),
)

MATCHES = "array<struct<label:string,line:bigint,last_line:bigint,containment:double,best:boolean>>"
FOUND = (
    f"n_words long, n_base long, first_word long, last_word long, base_labels array<string>, matches {MATCHES}"
)


def words_of(text: str) -> list[str]:
    words = W.split(pa.array([text]), W.NOT_ALNUM, lower=True)
    return [words.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends, strict=True)]


def _hash_of(words: list[str]) -> np.ndarray:
    return W.split(pa.array(words, pa.string()), W.NOT_ALNUM, lower=True).hashes()


def needed(size: int) -> int:
    """Fewest words of a template that reach CONTAINED."""
    return next(n for n in range(size + 1) if n / size >= CONTAINED)


@dataclass
class Templates:
    """Token sets as ranks in the corpus order, and the vocabulary that gives the ranks."""

    labels: list[str]
    sets: list[list[int]]  # ascending ranks, so rarest first
    lengths: list[int]  # words, repeats included
    prefix: dict[int, list[int]]  # templates by the ranks in their prefix
    hashes: np.ndarray  # sorted
    ranks: np.ndarray  # of each hash
    phrases: list[tuple[np.ndarray, str]]

    @classmethod
    def build(cls, templates, counts: dict[int, int]) -> Templates:
        """``counts``: blocks that have a word, by the word's hash as a signed long."""
        texts = [words_of(text) for _, text in templates]
        tokens = [sorted(set(words)) for words in texts]
        vocabulary = sorted({w for t in tokens for w in t})
        hashes = _hash_of(vocabulary)
        often = [counts.get(int(h), 0) for h in hashes.view(np.int64)]
        order = sorted(range(len(vocabulary)), key=lambda i: (often[i], vocabulary[i]))
        rank = {vocabulary[i]: r for r, i in enumerate(order)}
        sets = [sorted(rank[w] for w in t) for t in tokens]
        prefix: dict[int, list[int]] = {}
        for t, own in enumerate(sets):
            for r in own[: len(own) - needed(len(own)) + 1]:
                prefix.setdefault(r, []).append(t)
        by_hash = np.argsort(hashes)
        return cls(
            [label for label, _ in templates], sets, [len(words) for words in texts], prefix, hashes[by_hash],
            np.array([rank[vocabulary[i]] for i in by_hash], np.int64),
            [(_hash_of(phrase.split()), label) for phrase, label in PHRASES.items()],
        )

    def rank_of(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of each word, -1 for words of no template."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.ranks[at], -1)

    def contained(self, own: list[int], size: int) -> list[tuple[int, frozenset[int]]]:
        """Templates that a block of at most ``size`` distinct words matches, with the ranks they share.

        own: ascending ranks of the block's words.
        """
        found = []
        have = set(own)
        for t in sorted({t for r in own for t in self.prefix.get(r, ())}):
            template = self.sets[t]
            need = needed(len(template))
            if size < need:
                continue
            i = next(i for i, r in enumerate(template) if r in have)
            j = own.index(template[i])
            if min(len(template) - i, len(own) - j) < need:
                continue
            both = frozenset(have.intersection(template))
            if len(both) >= need:
                found.append((t, both))
        return found

    def match_lines(self, lines: dict[int, tuple[int, frozenset[int]]], hits: list[int]) -> list[dict]:
        """Matches of a text. lines: words and ranks of the lines around ``hits``, which have a word of a prefix."""
        least = min((needed(len(s)) for s in self.sets), default=0)
        found = []  # template, first and last line, ranks shared
        done: set[tuple[int, int]] = set()
        for hit in hits:
            for first in range(max(hit - LINES + 1, 0), hit + 1):
                for last in range(hit, first + LINES):
                    run = [lines.get(k, (0, frozenset())) for k in range(first, last + 1)]
                    if (first, last) in done or (len(run) > 1 and not all(n for n, _ in run)):
                        continue
                    done.add((first, last))
                    have = frozenset().union(*(ranks for _, ranks in run))
                    if len(have) < least:
                        continue
                    # Without its first or its last line a run of several contains less of the template.
                    inner = [frozenset().union(*(r for _, r in part)) for part in (run[1:], run[:-1])]
                    size = sum(n for n, _ in run)
                    for t, both in self.contained(sorted(have), size):
                        short = size <= 2 * self.lengths[t] and not any(both <= part for part in inner)
                        if first == last or short:
                            found.append((t, first, last, both))
        at: dict[int, list[int]] = {}
        for m, (_, first, last, _) in enumerate(found):
            for line in range(first, last + 1):
                at.setdefault(line, []).append(m)
        out = []
        for t, first, last, both in found:
            others = {m for line in range(first, last + 1) for m in at[line]}
            best = not any(self._explains(found[m], t, both) for m in others)
            share = len(both) / len(self.sets[t])
            out.append({"label": self.labels[t], "line": first, "last_line": last, "containment": share, "best": best})
        return out

    def _explains(self, other: tuple, t: int, both: frozenset[int]) -> bool:
        o, _, _, theirs = other
        if not both.issubset(self.sets[o]):
            return False
        more = len(theirs) / len(self.sets[o]) - len(both) / len(self.sets[t])
        return more > 0 or (more == 0 and set(self.sets[t]) < set(self.sets[o]))

    def scan(self, texts: pa.Array) -> list[dict]:
        words = W.split(texts, W.NOT_ALNUM, lower=True)
        hashes, text = words.hashes(), words.text_of()
        out = [
            {"n_words": int(n), "n_base": 0, "first_word": None, "last_word": None, "base_labels": [], "matches": []}
            for n in words.counts
        ]
        for phrase, label in self.phrases:
            starts = words.window_starts(len(phrase))
            for k, h in enumerate(phrase):
                starts = starts[hashes[starts + k] == h]
            for row, at in zip(text[starts].tolist(), (starts - words.first[text[starts]]).tolist(), strict=True):
                r = out[row]
                r["n_base"] += 1
                r["first_word"] = at if r["first_word"] is None else min(at, r["first_word"])
                r["last_word"] = at if r["last_word"] is None else max(at, r["last_word"])
                if label not in r["base_labels"]:
                    r["base_labels"] = sorted([*r["base_labels"], label])
        for row, lines, hits in self._lines(words, hashes, text):
            out[row]["matches"] = self.match_lines(lines, hits)
        return out

    def _lines(self, words: W.Words, hashes: np.ndarray, text: np.ndarray):
        """``(text, lines, hits)`` of the texts that hold a word of some prefix, as ``match_lines`` takes them."""
        rank = self.rank_of(hashes)
        hit = np.flatnonzero(np.isin(rank, np.array(list(self.prefix), np.int64)))
        if not len(hit):
            return
        ends = np.flatnonzero(words.data == 0x0A)
        line = np.searchsorted(ends, words.starts)
        for row in np.unique(text[hit]).tolist():
            low, high = np.searchsorted(text, [row, row + 1])
            first_line = int(np.searchsorted(ends, words.offsets[row]))
            own = line[low:high] - first_line
            hits = np.unique(line[hit[np.searchsorted(hit, low) : np.searchsorted(hit, high)]] - first_line)
            near = np.unique((hits[:, None] + np.arange(1 - LINES, LINES)).ravel())
            starts, stops = np.searchsorted(own, near), np.searchsorted(own, near, "right")
            lines = {}
            for number, a, b in zip(near.tolist(), starts.tolist(), stops.tolist(), strict=True):
                ranks = rank[low + a : low + b]
                lines[number] = (b - a, frozenset(ranks[ranks >= 0].tolist()))
            yield row, lines, hits.tolist()


def _count_blocks(hashes: np.ndarray):
    """How many lines have each of the given words (sorted hashes)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(hashes), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                words = W.split(part.column("text"), W.NOT_ALNUM, lower=True)
                own = words.hashes()
                at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                of = np.flatnonzero(hashes[at] == own)
                line = np.searchsorted(np.flatnonzero(words.data == 0x0A), words.starts[of]) + words.text_of()[of]
                pairs = np.unique(line * len(hashes) + at[of])
                total += np.bincount(pairs % len(hashes), minlength=len(hashes))
        yield pa.record_batch([pa.array(hashes.view(np.int64)), pa.array(total)], names=["word", "n"])

    return count


def fit(docs: DataFrame, text_col: str = "text", templates=TEMPLATES) -> Templates:
    """Templates with their words in the order of all blocks of ``docs``."""
    hashes = np.unique(_hash_of(sorted({w for _, text in templates for w in words_of(text)})))
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    counts = texts.mapInArrow(_count_blocks(hashes), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return Templates.build(templates, {r["word"]: r["n"] for r in counts.collect()})


def with_licenses(docs: DataFrame, templates: Templates, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct of phrases and notices.

    n_words; n_base, first_word, last_word: number, smallest and largest start of the phrases'
    places (in words from 0, null without any); base_labels: their labels; matches: each block
    (its first and last line, from 0) that contains a template, with the template's label, and whether
    it is the best for its lines. Null and empty texts have no words. Every row comes back with all its columns.
    """
    shared = docs.sparkSession.sparkContext.broadcast(templates)

    @F.arrow_udf(FOUND)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        match = pa.struct(
            [("label", pa.string()), ("line", pa.int64()), ("last_line", pa.int64()), ("containment", pa.float64()),
             ("best", pa.bool_())]
        )
        kind = pa.struct(
            [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
             ("base_labels", pa.list_(pa.string())), ("matches", pa.list_(match))]
        )
        for texts in batches:
            out = []
            for part in slices(pa.record_batch([texts], names=["text"]), "text"):
                out += shared.value.scan(part.column(0))
            yield pa.array(out, kind)

    return docs.withColumn(name, scan(F.col(f"`{text_col}`").cast("string")))
