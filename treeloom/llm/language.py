"""Language identification with Bloom filters that answer for all languages at once.

Method. The character n-grams typical of each language go into one bit-sliced Bloom filter: a
slot holds a bit for each language, so the AND of an n-gram's slots is the mask of all
languages that contain it. A text gets, for each language, the number of its n-grams whose
mask has that bit, less the number that false positives explain. The largest decides.

Only what the filter is built from is a bounded sample: SAMPLE texts of each language, those
with the smallest hash of their id, and of these the GRAMS most frequent n-grams. Every text
is judged whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from treeloom.llm.tables import slices
from treeloom.llm.words import mix

SAMPLE = 1000
GRAMS = 40_000
SIZES = (2, 3, 4)
SLOTS = 1 << 21
HASHES = 2
#: A language contains an n-gram if it is at least so often there as in the language that has it
#: most, and in so many sampled texts; foreign passages inside texts stay out this way.
SHARE = 0.05
LEAST = 2

#: A text of which the best language contains less than this is in none of them.
COVERAGE = 0.25

NONE = "und"
BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size, the hash of every n-gram and the row it is in, in order of rows. Case is
    ignored; what is no letter ends a word, and an n-gram may have a word's end as its first or
    last character but not inside."""
    points = [np.frombuffer((" " + (t or "").lower()).encode("utf-32-le", "replace"), np.uint32) for t in texts]
    sizes = [len(p) for p in points]
    flat = np.concatenate([*points, np.zeros(1, np.uint32)])
    letter = _letters()[flat]
    row = np.repeat(np.arange(len(texts) + 1, dtype=np.int32), [*sizes, 1])
    keep = letter | np.append(letter[1:], False)  # one separator before each word
    keep[np.cumsum([0, *sizes])] = True
    flat = np.where(letter, flat, 0)[keep].astype(np.uint64)
    letter, row = letter[keep], row[keep]
    for n in SIZES:
        size = max(0, len(flat) - n + 1)
        code = np.full(size, n, np.uint64)
        inside = letter[1 : size + 1] | letter[:size] if n == 2 else np.ones(size, bool)
        for j in range(n):
            code *= np.uint64(0x100000001B3)
            code += flat[j : j + size]
            if 0 < j < n - 1:
                inside &= letter[j : j + size]
        yield mix(code[inside]), row[:size][inside]


@dataclass
class Filter:
    """``slots[w]`` has the bits of languages 64 w to 64 w + 63."""

    languages: list[str]
    slots: np.ndarray
    wrong: np.ndarray  # false positive rate of each language

    @classmethod
    def build(cls, found: dict[str, np.ndarray], slots: int = SLOTS) -> Filter:
        languages = list(found)
        words = max(1, -(-len(languages) // 64))
        table = np.zeros((words, slots), np.uint64)
        fill = np.zeros(len(languages))
        for i, codes in enumerate(found.values()):
            for at in cls._places(codes, slots):
                np.bitwise_or.at(table[i // 64], at, np.uint64(1 << (i % 64)))
            fill[i] = ((table[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()
        if len(languages) <= 8:
            table = table.astype(np.uint8)
        return cls(languages, table, fill**HASHES)

    @staticmethod
    def _places(codes: np.ndarray, slots: int) -> list[np.ndarray]:
        step = (codes >> np.uint64(32)) | np.uint64(1)
        return [((codes + np.uint64(i) * step) & np.uint64(slots - 1)).astype(np.int64) for i in range(HASHES)]

    def masks(self, codes: np.ndarray) -> np.ndarray:
        places = self._places(codes, self.slots.shape[1])
        out = self.slots[:, places[0]]
        for at in places[1:]:
            out = out & self.slots[:, at]
        return out

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of each text, and for each language how many it contains, corrected."""
        n = np.zeros(len(texts), np.int64)
        hits = np.zeros((len(texts), len(self.languages)))
        for codes, rows in grams(texts):
            masks = self.masks(codes)
            n += np.bincount(rows, minlength=len(texts))[: len(texts)]
            for w in range(0, len(self.languages), 8):  # eight languages at a time, by the values of their bits
                byte = (masks[w // 64] >> masks.dtype.type(w % 64)).astype(np.uint8)
                seen = np.bincount(rows.astype(np.int64) * 256 + byte, minlength=len(texts) * 256)
                seen = seen[: len(texts) * 256].reshape(-1, 256)
                hits[:, w : w + 8] += seen @ BITS[:, : len(self.languages) - w]
        return n, np.maximum(0, (hits - n[:, None] * self.wrong) / (1 - self.wrong))


def _sampled_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = list(grams(part.column("text").to_pylist()))
            codes, rows = (np.concatenate(x) for x in zip(*found, strict=True))
            langs = part.column("lang").dictionary_encode()
            which = langs.indices.to_numpy()[rows]
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                own = which == i
                order = np.lexsort((rows[own], codes[own]))
                c, r = codes[own][order].view(np.int64), rows[own][order]
                new = np.append(True, (c[1:] != c[:-1]) | (r[1:] != r[:-1]))[: len(c)]
                code, texts = np.unique(c[new], return_counts=True)
                yield pa.record_batch(
                    [pa.array([lang] * len(code), pa.string()), pa.array(code), pa.array(texts)],
                    names=["lang", "code", "texts"],
                )


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample: int = SAMPLE, most: int = GRAMS,
) -> Filter:
    """A filter learned from the rows whose language and text are not null.

    What reaches the driver is bounded by ``most`` n-grams for each language. Without any such
    row the filter knows no language.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").cast("string").alias("id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    ).filter("lang is not null and text is not null")
    order = F.xxhash64("id")
    # The smallest hashes of each language are found on ids alone; texts follow by the bound.
    ranked = rows.select("lang", order.alias("at")).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy("at"))
    )
    bounds = ranked.filter(f"rank <= {sample}").groupBy("lang").agg(F.max("at").alias("bound"))
    bounds = {r["lang"]: r["bound"] for r in bounds.collect()}
    if not bounds:
        return Filter.build({})
    bound = F.element_at(F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair]), F.col("lang"))
    counted = rows.filter(order <= bound).select("lang", "text").mapInArrow(
        _sampled_grams, "lang string, code long, texts long"
    ).groupBy("lang", "code").agg(F.sum("texts").alias("texts"))
    # Rates are compared over the texts that were sampled of each language.
    sizes = rows.filter(order <= bound).groupBy("lang").agg(F.count("*").alias("size"))
    rates = counted.join(F.broadcast(sizes), "lang").withColumn("rate", F.col("texts") / F.col("size"))
    best = F.max("rate").over(Window.partitionBy("code"))
    typical = rates.withColumn("best", best).filter((F.col("rate") >= SHARE * F.col("best")) & (F.col("texts") >= LEAST))
    by_use = Window.partitionBy("lang").orderBy(F.desc("texts"), "code")
    typical = typical.withColumn("rank", F.row_number().over(by_use)).filter(f"rank <= {most}")
    found = typical.select("lang", "code").toArrow().to_pandas().groupby("lang")["code"]
    found = {lang: codes.to_numpy().view(np.uint64) for lang, codes in found}
    return Filter.build({lang: found.get(lang, np.zeros(0, np.uint64)) for lang in sorted(bounds)})


def with_language(docs: DataFrame, model: Filter, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct ``lang, score, coverage``.

    lang is the learned language with the most n-grams of the text (the first in order of name
    on ties), ``und`` for a null text, one without a letter, or if no language was learned.
    score is that language's part of all languages' counts, coverage the part of the text's
    n-grams that it contains; both are 0 where nothing was found.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double, coverage double")
    def identify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for texts in batches:
            lang, score, coverage = [], [], []
            for part in slices(pa.record_batch([texts], names=["text"]), "text", 1 << 17):
                n, found = model.counts(part.column(0).to_pylist())
                if not model.languages:
                    n, found = n * 0, np.zeros((len(n), 1))
                best, top, total = found.argmax(axis=1), found.max(axis=1), found.sum(axis=1)
                lang += [model.languages[b] if k else NONE for b, k in zip(best, n, strict=True)]
                score += np.divide(top, total, out=np.zeros(len(n)), where=total > 0).tolist()
                coverage += np.divide(top, n, out=np.zeros(len(n)), where=n > 0).tolist()
            yield pa.StructArray.from_arrays(
                [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(coverage, pa.float64())],
                names=["lang", "score", "coverage"],
            )

    return docs.withColumn(name, identify(F.col(f"`{text_col}`").cast("string")))


def keep_known(docs: DataFrame, model: Filter, text_col: str = "text", least: float = COVERAGE) -> DataFrame:
    """Rows of ``docs`` whose language is known and contains at least ``least`` of their n-grams."""
    name = "_language"
    while name in docs.columns:
        name += "_"
    found = with_language(docs, model, name, text_col)
    return found.filter((F.col(f"{name}.lang") != NONE) & (F.col(f"{name}.coverage") >= least)).drop(name)
