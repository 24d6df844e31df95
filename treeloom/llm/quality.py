"""Quality scores by the votes of the most similar labelled documents.

Method. A text becomes counts of its words (hashed) and of their shapes: which kinds of
characters a word has, and whether it repeats the word before it. Both parts are weighted by how
rare a feature is and scaled to length one. A singular value decomposition of the labelled
sample gives DIMENSIONS latent directions; texts and sample are compared in them. The sample's
vectors are a broadcast of fixed size. For every document the cosines with all of them are
computed exactly, a block of documents at a time, and the labels of the NEIGHBOURS nearest are
averaged with their similarities as weights.

Only the sample is bounded: SAMPLE documents of each label, those with the smallest hash of
their id. Every document is scored from its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from treeloom.llm import words as W
from treeloom.llm.tables import slices

SAMPLE = 1000
WORDS = 1 << 12
SHAPES = 512
DIMENSIONS = 64
NEIGHBOURS = 25
#: Similarities are raised to this before they weigh a vote.
SHARPNESS = 8
#: Documents that are compared at once.
BLOCK = 256

#: Kinds of bytes that make up a word's shape.
_KIND = np.full(256, 64, np.uint8)
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("a") : ord("z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 4
_KIND[[ord(c) for c in "#*$%&|<>"]] = 8
_KIND[[ord(c) for c in "!?"]] = 16
_KIND[[ord(c) for c in ".,;:"]] = 32
_KIND[128:] = 2


def features(texts: pa.Array) -> np.ndarray:
    """Counts of word features, then of shape features, one row for each text."""
    words = W.split(texts, lower=False)
    n, width = len(texts), WORDS + SHAPES
    if not len(words):
        return np.zeros((n, width), np.float32)
    text = words.text_of()
    lowered = W.split(texts, W.WHITE, lower=True).hashes()
    edges = np.stack([words.starts, np.minimum(words.ends, len(words.data) - 1)], axis=1).ravel()
    shape = np.bitwise_or.reduceat(_KIND[words.data], edges)[::2].astype(np.int64)
    single = words.starts == len(words.data) - 1  # reduceat over an empty range at the very end
    shape[single] = _KIND[words.data[words.starts[single]]]
    again = np.append(False, (lowered[1:] == lowered[:-1]) & (text[1:] == text[:-1]))
    column = np.append((lowered % np.uint64(WORDS)).astype(np.int64), WORDS + shape + 256 * again)
    counts = np.bincount(np.tile(text, 2) * width + column, minlength=n * width)
    return counts.reshape(n, width).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


@dataclass
class Voters:
    """Labelled vectors in latent directions."""

    rarity: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @classmethod
    def build(cls, counts: np.ndarray, labels: np.ndarray) -> Voters:
        rarity = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)
        rows = cls._weighted(counts, rarity)
        # The right singular vectors, from the smaller matrix of products between documents.
        values, left = np.linalg.eigh(rows @ rows.T)
        keep = np.argsort(values)[::-1][:DIMENSIONS]
        keep = keep[values[keep] > 1e-6 * max(1.0, float(values.max(initial=0)))]
        directions = (rows.T @ left[:, keep]) / np.sqrt(values[keep])
        return cls(rarity, directions.astype(np.float32), _unit(rows @ directions).astype(np.float32), labels)

    @staticmethod
    def _weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
        words = _unit(np.log1p(counts[:, :WORDS]) * rarity[:WORDS])
        shapes = _unit(np.sqrt(counts[:, WORDS:]) * rarity[WORDS:])
        return np.concatenate([words, shapes], axis=1)

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The weighted vote for each text; the sample's mean label where nothing is similar."""
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        out = np.full(len(texts), float(self.labels.mean()))
        for at in range(0, len(texts), BLOCK):
            counts = features(texts.slice(at, BLOCK))
            cosine = _unit(self._weighted(counts, self.rarity) @ self.directions) @ self.vectors.T
            k = min(NEIGHBOURS, cosine.shape[1])
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** SHARPNESS
            total = weight.sum(axis=1)
            votes = (weight * self.labels[near]).sum(axis=1)
            some = total > 0
            out[at : at + BLOCK][some] = votes[some] / total[some]
        return np.clip(out, 0, 1)


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample: int = SAMPLE,
) -> Voters:
    """Voters from the labelled documents; an id with several labels gets their mean.

    Rows without an id or a label teach nothing. What reaches the driver is ``sample`` documents
    of each label, as counts of features that occur in them.
    """
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("label"))
    known = known.filter("id is not null and label is not null").groupBy("id").agg(F.avg("label").alias("label"))
    by_hash = Window.partitionBy(F.round("label")).orderBy(F.xxhash64("id"), "id")
    chosen = known.withColumn("rank", F.row_number().over(by_hash)).filter(f"rank <= {sample}").select("id", "label")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    texts = texts.filter("text is not null").join(F.broadcast(chosen), "id")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for at in range(0, part.num_rows, BLOCK):
                    rows = part.slice(at, BLOCK)
                    counts = features(rows.column("text"))
                    places = [np.flatnonzero(c) for c in counts]
                    yield pa.record_batch(
                        [rows.column("id").cast(pa.string()), rows.column("label"), pa.array(places, pa.list_(pa.int64())),
                         pa.array([c[p] for c, p in zip(counts, places, strict=True)], pa.list_(pa.float32()))],
                        names=["id", "label", "places", "counts"],
                    )

    rows = texts.mapInArrow(counted, "id string, label double, places array<long>, counts array<float>")
    # Repeated rows of one id add nothing.
    rows = rows.dropDuplicates(["id"]).toArrow().combine_chunks().sort_by("id")
    counts = np.zeros((rows.num_rows, WORDS + SHAPES), np.float32)
    places, found = (rows.column(c).combine_chunks() for c in ("places", "counts"))
    counts[
        np.repeat(np.arange(rows.num_rows), places.value_lengths().to_numpy()), places.flatten().to_numpy()
    ] = found.flatten().to_numpy()
    labels_ = rows.column("label").to_numpy()
    if not rows.num_rows:
        return Voters(np.zeros(WORDS + SHAPES, np.float32), np.zeros((WORDS + SHAPES, 0), np.float32), counts[:, :0], labels_)
    return Voters.build(counts, labels_)


def with_score(docs: DataFrame, voters: Voters, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with a score from 0 to 1; every row and column comes back as it is.

    Null and empty texts resemble nothing and get the mean label of the sample; without any
    labelled document every score is 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(voters)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [np.zeros(0)]
            for part in slices(pa.record_batch([texts], names=["text"]), "text"):
                found.append(shared.value.scores(part.column(0)))
            yield pa.array(np.concatenate(found))

    return docs.withColumn(name, score(F.col(f"`{text_col}`").cast("string")))
