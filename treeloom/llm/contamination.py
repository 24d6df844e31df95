"""Benchmark passages inside documents.

A document leaks an item if one of its windows with as many words as the item has a weighted
shingle similarity of SIMILAR or more to it: the sum of the smaller counts over the sum of the
larger counts of their shingles of five words (an item of fewer words is one shingle).

Method. A window of an item's size gets a 64-bit SimHash over its shingles. Item fingerprints
are cut into BLOCKS blocks, and each block is indexed under every value up to
RADIUS // BLOCKS bits away, so whatever lies within the radius meets in some block. What meets
and is within RADIUS bits is compared exactly. At a similarity of 0.8 two fingerprints differ
by 9.7 bits on average with a deviation of 2.9, so a radius of 20 misses less than one pair in
a thousand, and far fewer above.

Only windows that share a shingle with an item of their size are fingerprinted; all others have
a similarity of zero. The items are the query set: they are taken in blocks of about ITEM_WORDS
words, each block a broadcast of that size, however many items there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeloom.llm import words as W
from treeloom.llm.tables import slices

SHINGLE = 5
SIMILAR = 0.8
RADIUS = 20
BLOCKS = 7
ITEM_WORDS = 1_000_000
#: Places of one text that are searched together; bounds memory only.
AT_ONCE = 4_000

_CUTS = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
LEAKS = "array<struct<item_id:bigint,similarity:double,first_word:bigint,n_words:bigint,distance:int>>"
_ROW = pa.struct(
    [("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64()),
     ("n_words", pa.int64()), ("distance", pa.int32())]
)


def split(texts: pa.Array) -> W.Words:
    """Runs of ASCII letters and digits and all other characters beyond ASCII, A-Z lower-cased."""
    return W.split(texts, W.NOT_ALNUM, lower=True)


def fingerprints(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """SimHash of each run ``hashes[start:end]``: the bits set in over half of it."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    ones = sums[ends] - sums[starts]
    return np.packbits(2 * ones > (ends - starts)[:, None], axis=1, bitorder="little").view("<u8")[:, 0]


def _near_values(value: int, width: int) -> list[int]:
    """All values of a block up to RADIUS // BLOCKS bits away."""
    return [
        value ^ sum(1 << b for b in turned)
        for n in range(RADIUS // BLOCKS + 1)
        for turned in combinations(range(width), n)
    ]


@dataclass
class Items:
    """An index of benchmark items: shingles, sizes, and fingerprints by size and block."""

    ids: np.ndarray
    sizes: np.ndarray  # words
    shingles: list[np.ndarray]
    prints: np.ndarray
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # by shingle size: sieve, hashes, items
    block_keys: np.ndarray
    block_items: np.ndarray

    @classmethod
    def build(cls, ids: list[int], texts: list[str]) -> Items:
        words = split(pa.array(texts, pa.string()))
        keep = np.flatnonzero(words.counts > 0)
        sizes = words.counts[keep]
        shingles, prints, seeds = [], [], {}
        for row, size in zip(keep, sizes, strict=True):
            k = min(SHINGLE, int(size))
            starts = words.first[row] + np.arange(size - k + 1)
            shingles.append(words.windows(starts, k))
            prints.append(fingerprints(shingles[-1], np.array([0]), np.array([len(starts)]))[0])
        for k in sorted({min(SHINGLE, int(n)) for n in sizes}):
            own = [i for i, n in enumerate(sizes) if min(SHINGLE, int(n)) == k]
            pairs = sorted({(int(h), i) for i in own for h in shingles[i]})
            hashes = np.array([h for h, _ in pairs], np.uint64)
            sieve = np.zeros(1 << 22, bool)
            sieve[(hashes & np.uint64(len(sieve) - 1)).astype(np.int64)] = True
            seeds[k] = (sieve, hashes, np.array([i for _, i in pairs], np.int64))
        keys = [
            (cls._key(int(sizes[i]), b, near), i)
            for i, fp in enumerate(prints)
            for b, (low, high) in enumerate(zip(_CUTS, _CUTS[1:], strict=False))
            for near in _near_values(int(fp) >> low & ((1 << (high - low)) - 1), high - low)
        ]
        keys.sort()
        return cls(
            np.array(ids, np.int64)[keep], sizes, shingles, np.array(prints, np.uint64), seeds,
            np.array([k for k, _ in keys], np.int64), np.array([i for _, i in keys], np.int64),
        )

    @staticmethod
    def _key(size: int, block: int, value):
        return (size * BLOCKS + block) * 1024 + value

    def within(self, size: int, prints: np.ndarray) -> list[tuple[int, int, int]]:
        """``(window, item, distance)`` for all items of this size within the radius."""
        found = set()
        for b, (low, high) in enumerate(zip(_CUTS, _CUTS[1:], strict=False)):
            values = (prints >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
            keys = self._key(size, b, values.astype(np.int64))
            left = np.searchsorted(self.block_keys, keys, "left")
            right = np.searchsorted(self.block_keys, keys, "right")
            n = right - left
            at = np.repeat(np.arange(len(keys)), n)
            items = self.block_items[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(left, n)]
            apart = np.bitwise_count(prints[at] ^ self.prints[items])
            near = apart <= RADIUS
            found |= set(zip(at[near].tolist(), items[near].tolist(), apart[near].tolist(), strict=True))
        return sorted(found)

    def _hits(self, words: W.Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words at which a shingle of an item starts: ``(text, word, item)``, sorted by text and item."""
        sieve, hashes, items = self.seeds[k]
        starts = words.window_starts(k)
        found = words.windows(starts, k)
        maybe = sieve[(found & np.uint64(len(sieve) - 1)).astype(np.int64)]
        starts, found = starts[maybe], found[maybe]
        left, right = np.searchsorted(hashes, found, "left"), np.searchsorted(hashes, found, "right")
        n = right - left
        item = items[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(left, n)]
        at = np.repeat(starts, n)
        text = np.searchsorted(words.first, at, "right") - 1
        order = np.lexsort((at, item, text))
        return text[order], at[order], item[order]

    def leaks(self, texts: pa.Array) -> list[list[dict]]:
        """For each text, the items it leaks, each with its most similar window (the first such)."""
        words = split(texts)
        best: list[dict[int, tuple]] = [{} for _ in range(len(texts))]
        for k in self.seeds:
            text, at, item = self._hits(words, k)
            size = self.sizes[item]
            cut = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (size[1:] != size[:-1])))[: len(text)]
            # Items of one size are searched together, so a window meets all of them.
            groups: dict[tuple[int, int], list[np.ndarray]] = {}
            for low, high in zip(cut, np.append(cut[1:], len(text)), strict=False):
                groups.setdefault((int(text[low]), int(size[low])), []).append(at[low:high])
            for (row, n), seeds in groups.items():
                seeds = np.unique(np.concatenate(seeds))
                for part in range(0, len(seeds), AT_ONCE):
                    self._search(words, row, n, k, seeds[part : part + AT_ONCE], best[row])
        return [
            [
                {"item_id": int(self.ids[i]), "similarity": -less, "first_word": start, "n_words": n, "distance": d}
                for i, (less, start, n, d) in sorted(found.items())
            ]
            for found in best
        ]

    def _search(self, words: W.Words, row: int, size: int, k: int, seeds: np.ndarray, best: dict) -> None:
        """Compare the windows of ``size`` words (or the whole shorter text) around the seeds."""
        first, last = int(words.first[row]), int(words.first[row + 1])
        length = min(size, last - first)
        reach = np.arange(length - k + 1)
        starts = np.unique((seeds[:, None] - reach).ravel())
        starts = starts[(starts >= first) & (starts <= last - length)]
        # Shingles of the stretch of text that the windows cover, gaps left out.
        need = np.unique((starts[:, None] + reach).ravel())
        hashes = words.windows(need, k)
        left = np.searchsorted(need, starts)
        prints = fingerprints(hashes, left, left + len(reach))
        for window, item, distance in self.within(size, prints):
            similarity = _similarity(hashes[left[window] : left[window] + len(reach)], self.shingles[item])
            if similarity >= SIMILAR:
                found = (-similarity, int(starts[window]) - first, length, distance)
                best[item] = min(best.get(item, found), found)


def _similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the smaller over the sum of the larger counts."""
    _, which = np.unique(np.concatenate([a, b]), return_inverse=True)
    n = which.max() + 1
    x, y = np.bincount(which[: len(a)], minlength=n), np.bincount(which[len(a) :], minlength=n)
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


def _leaks_of(items: Items, spark) -> Column:
    shared = spark.sparkContext.broadcast(items)

    @F.arrow_udf(LEAKS)
    def leaks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = []
            for part in slices(pa.record_batch([texts], names=["text"]), "text"):
                found += shared.value.leaks(part.column(0))
            yield pa.array(found, pa.list_(_ROW))

    return leaks


def with_leaks(
    docs: DataFrame, benchmark: DataFrame, name: str, text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``docs`` with an array of the items each text leaks, in order of the items.

    Null and empty texts leak nothing, and null or wordless items are found nowhere. A repeated
    item counts once; different texts under one item id are items of their own. Rows come out as
    they came in, with all their columns, and nothing is shuffled.
    """
    items = benchmark.select(
        F.col(f"`{item_col}`").cast("long").alias("id"), F.col(f"`{item_text_col}`").cast("string").alias("text")
    ).filter("id is not null and text is not null").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // (6 * ITEM_WORDS))
    found = [F.array().cast(LEAKS)]
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
        rows = sorted((r["id"], r["text"]) for r in rows.collect())
        index = Items.build([i for i, _ in rows], [t for _, t in rows])
        found.append(_leaks_of(index, docs.sparkSession)(F.col(f"`{text_col}`").cast("string")))
    return docs.withColumn(name, F.array_sort(F.concat(*found)))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document and item that it leaks."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = with_leaks(rows, benchmark, "leaks")
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that leak no item, with all their columns."""
    name = "_leaks"
    while name in docs.columns:
        name += "_"
    return with_leaks(docs, benchmark, name, text_col).filter(F.size(name) == 0).drop(name)
