"""Hard negatives: rows of another label that score almost as high as a positive.

A row's score for an anchor is the inner product of their vectors in whole steps. An anchor's positives
are its best rows of the same label; a negative is a row of another label whose score lies between
two shares of a positive's.

Method. An R-tree packed by Sort-Tile-Recursive: a range partition by the widest coordinate cuts the
vectors into slabs, a task tiles its slab by further coordinates into leaves of LEAF neighbours, and
each leaf has the smallest box around its vectors. From a box every coordinate gives an interval of
its product with the anchor's, so their sums bound all scores in it. For each anchor leaves wait in
a queue, the highest bound first; a leaf is opened unless its interval lies outside the score
window or strictly below the last score kept so far, and the queue ends at the first bound below.

Anchors are a set of queries against all rows. They are taken in blocks of ANCHORS, each of which
one job holds against the whole tree, so neither the driver nor a task holds more than one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from treeloom.session import stage

SCALE = 256
EVERY = 50
POSITIVES = 5
NEGATIVES = 3
#: Shares of a positive's score, in hundredths, between which a negative's lies.
LOW, HIGH = 50, 95
#: Vectors of a leaf, and coordinates that a slab is tiled by.
LEAF, TILED = 64, 3
#: Rows of a slab and bytes of its vectors, on average.
SLAB, SLAB_BYTES = 1 << 16, 32 << 20
#: Bytes of vectors in a row of the tree, and of those that are searched at once.
PAGE_BYTES, FOREST_BYTES = 2 << 20, 16 << 20
#: Anchors of a block and bytes of their vectors, on average.
ANCHORS, ANCHOR_BYTES = 1 << 14, 16 << 20
#: Places in all queues at once: queries times leaves.
QUEUES = 1 << 22

_MOST = np.iinfo(np.int64).max
_NONE = -_MOST
_TREE = "size int, ids binary, labels binary, vectors binary, ends binary, low binary, high binary"


def prepared(embeddings: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``id, label, vector``: rows that take part, in whole steps of ``1 / scale``, one for each id."""
    rows = embeddings.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    rows = rows.select("id", "label", F.transform("vector", lambda x: F.floor(x * scale)).alias("vector"))
    return rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.*")


def _tiles(vectors: np.ndarray, rows: np.ndarray, by: list[int]) -> list[np.ndarray]:
    """Rows of each leaf: sorted by a coordinate, cut evenly, and each cut tiled by the next ones."""
    leaves = -(-len(rows) // LEAF)
    if leaves <= 1:
        return [rows]
    if not by:
        return np.array_split(rows, leaves)
    rows = rows[np.argsort(vectors[rows, by[0]], kind="stable")]
    cuts = int(np.ceil(leaves ** (1 / len(by))))
    return [leaf for part in np.array_split(rows, cuts) for leaf in _tiles(vectors, part, by[1:])]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages of leaves of one slab, vectors of each length by themselves."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    slab = pa.Table.from_batches(held).combine_chunks()
    sizes = pc.list_value_length(slab["vector"]).to_numpy()
    for size in np.unique(sizes):
        own = slab.filter(pa.array(sizes == size))
        vectors = own["vector"].combine_chunks().flatten().to_numpy().reshape(len(own), size)
        ids, labels = own["id"].to_numpy(), own["label"].to_numpy()
        widest = np.argsort(-vectors.astype(float).var(axis=0), kind="stable")[:TILED].tolist()
        leaves = _tiles(vectors, np.arange(len(own)), widest)
        step = max(1, PAGE_BYTES // (8 * LEAF * max(1, int(size))))
        for at in range(0, len(leaves), step):
            page = leaves[at : at + step]
            rows = np.concatenate(page)
            parts = [
                ids[rows], labels[rows], vectors[rows], np.cumsum([len(leaf) for leaf in page]),
                np.array([vectors[leaf].min(axis=0) for leaf in page]), np.array([vectors[leaf].max(axis=0) for leaf in page]),
            ]
            columns = [pa.array([x.astype("<i8").tobytes()], pa.binary()) for x in parts]
            yield pa.record_batch(
                [pa.array([size], pa.int32()), *columns], names=["size", "ids", "labels", "vectors", "ends", "low", "high"]
            )


def tree(rows: DataFrame) -> DataFrame:
    """The packed pages of ``id, label, vector``."""
    spread = rows.select(F.posexplode("vector").alias("at", "x")).groupBy("at").agg(F.var_pop("x").alias("v"))
    widest = spread.orderBy(F.desc("v"), "at").first()
    n, total = rows.agg(F.count("*"), F.sum(8 * F.size("vector"))).first()
    slabs = max(
        int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // SLAB), -(-(total or 0) // SLAB_BYTES)
    )
    first = F.get("vector", F.lit(widest["at"] if widest else 0))
    return rows.repartitionByRange(slabs, first, "id").mapInArrow(_pack, _TREE)


@dataclass
class Forest:
    """Leaves of several pages with vectors of one length."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    ends: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _forests(batches: Iterator[pa.RecordBatch], limit: int = FOREST_BYTES) -> Iterator[Forest]:
    def grown(pages: list[dict]) -> Forest:
        def of(name: str) -> list[np.ndarray]:
            return [np.frombuffer(p[name], "<i8") for p in pages]

        ids, ends, size = of("ids"), of("ends"), pages[0]["size"]
        before = np.cumsum([0, *map(len, ids)])
        n, leaves = before[-1], sum(map(len, ends))
        shaped = [np.concatenate(of(x)).reshape(k, size) for x, k in (("vectors", n), ("low", leaves), ("high", leaves))]
        return Forest(
            np.concatenate(ids), np.concatenate(of("labels")), shaped[0],
            np.concatenate([e + b for e, b in zip(ends, before, strict=False)]), *shaped[1:],
        )

    held: dict[int, list[dict]] = {}
    for batch in batches:
        for page in batch.to_pylist():
            pages = held.setdefault(page["size"], [])
            pages.append(page)
            if sum(len(p["vectors"]) for p in pages) >= limit:
                yield grown(held.pop(page["size"]))
    for pages in held.values():
        yield grown(pages)


def _exact(a: np.ndarray, b: np.ndarray) -> type:
    """The type in which sums of products of two tables' rows are exact: doubles, or whole numbers of any size."""
    most = max(1, a.shape[1]) * float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0))
    return float if most < 1 << 53 else object


def _whole(scores: np.ndarray) -> np.ndarray:
    return np.clip(scores, _NONE + 1, _MOST).astype(np.int64) if scores.dtype == object else scores.astype(np.int64)


@dataclass
class Queries:
    """Queries of anchors: ``row`` is the anchor's place in ``vectors``, ``low`` and ``high`` the window of scores."""

    vectors: np.ndarray
    anchors: np.ndarray
    labels: np.ndarray
    row: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def __len__(self) -> int:
        return len(self.row)


class Best:
    """The ``k`` best rows of each query so far, higher scores first, ties by the smaller id."""

    def __init__(self, n: int, k: int):
        self.scores = np.full((n, k), _NONE, np.int64)
        self.ids = np.zeros((n, k), np.int64)

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        k = self.scores.shape[1]
        scores = np.hstack([self.scores[at], scores])
        ids = np.hstack([self.ids[at], ids])
        order = np.lexsort((ids, -scores), axis=1)[:, :k]
        self.scores[at] = np.take_along_axis(scores, order, 1)
        self.ids[at] = np.take_along_axis(ids, order, 1)


def _search(forest: Forest, queries: Queries, at: np.ndarray, best: Best, same: bool) -> None:
    """Best-first search of the queries ``at``: in each turn every one opens its next leaf."""
    anchors, place = np.unique(queries.row[at], return_inverse=True)
    own = queries.vectors[anchors]
    kind = _exact(own, forest.vectors)
    own, vectors, box_low, box_high = (x.astype(kind) for x in (own, forest.vectors, forest.low, forest.high))
    up, down = np.maximum(own, 0), np.minimum(own, 0)
    upper = _whole(up @ box_high.T + down @ box_low.T)[place]
    lower = _whole(up @ box_low.T + down @ box_high.T)[place]
    order = np.argsort(-upper, axis=1, kind="stable")
    starts = np.append(0, forest.ends[:-1])
    low, high = queries.low[at], queries.high[at]
    waiting = np.arange(len(at))
    for turn in range(order.shape[1]):
        leaf = order[waiting, turn]
        least = np.maximum(best.scores[at[waiting], -1], low[waiting])
        on = upper[waiting, leaf] >= least
        waiting, leaf, least = waiting[on], leaf[on], least[on]
        if not len(waiting):
            return
        met = lower[waiting, leaf] <= high[waiting]
        opened, leaf, least = waiting[met], leaf[met], least[met]
        by = np.argsort(leaf, kind="stable")
        opened, leaf, least = opened[by], leaf[by], least[by]
        scores, ids = np.full((len(opened), LEAF), _NONE, np.int64), np.zeros((len(opened), LEAF), np.int64)
        for one, a, n in zip(*np.unique(leaf, return_index=True, return_counts=True), strict=True):
            rows, q = slice(starts[one], forest.ends[one]), opened[a : a + n]
            wanted, back = np.unique(place[q], return_inverse=True)
            found = _whole(own[wanted] @ vectors[rows].T)[back]
            fit = (forest.labels[rows] == queries.labels[at[q], None]) == same
            if same:
                fit &= forest.ids[rows] != queries.anchors[at[q], None]
            fit &= (found >= least[a : a + n, None]) & (found <= high[q, None])
            scores[a : a + n, : found.shape[1]] = np.where(fit, found, _NONE)
            ids[a : a + n, : found.shape[1]] = forest.ids[rows]
        some = (scores > _NONE).any(axis=1)
        best.add(at[opened[some]], scores[some], ids[some])


def _chunks(queries: Queries | np.ndarray | tuple, forest: Forest) -> Iterator[np.ndarray]:
    """Places of the queries that search a forest together, those of one anchor next to each other."""
    step = max(1, QUEUES // max(1, len(forest.ends)))
    for at in range(0, len(queries), step):
        yield np.arange(at, min(at + step, len(queries)))


def _searched(pages: DataFrame, queries: dict[int, Queries], k: int, same: bool) -> DataFrame:
    """``size, query, id, score``: the ``k`` best rows that each task finds for each query."""
    shared = pages.sparkSession.sparkContext.broadcast(queries)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {size: Best(len(q), k) for size, q in shared.value.items()}
        for forest in _forests(batches):
            size = forest.vectors.shape[1]
            for chunk in _chunks(shared.value.get(size, ()), forest):
                _search(forest, shared.value[size], chunk, best[size], same)
        for size, own in best.items():
            query, rank = np.nonzero(own.scores > _NONE)
            yield pa.record_batch(
                [pa.array(np.full(len(query), size, np.int32)), pa.array(query), pa.array(own.ids[query, rank]), pa.array(own.scores[query, rank])],
                names=["size", "query", "id", "score"],
            )

    found = pages.mapInArrow(search, "size int, query long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("size", "query").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _anchors(pages: DataFrame, every: int) -> DataFrame:
    """``id, label, size, vector, floor``: anchors, and the last positive score that their own page proves."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for forest in _forests(batches, 1):
            at = np.flatnonzero(forest.ids % every == 0)
            own = forest.vectors[at]
            queries = Queries(own, forest.ids[at], forest.labels[at], np.arange(len(at)), np.full(len(at), _NONE + 1), np.full(len(at), _MOST))
            best = Best(len(at), POSITIVES)
            for chunk in _chunks(at, forest):
                _search(forest, queries, chunk, best, True)
            yield pa.record_batch(
                [pa.array(forest.ids[at]), pa.array(forest.labels[at]), pa.array(np.full(len(at), own.shape[1], np.int32)),
                 pa.array([v.tobytes() for v in own], pa.binary()), pa.array(np.maximum(best.scores[:, -1], _NONE + 1))],
                names=["id", "label", "size", "vector", "floor"],
            )

    return pages.mapInArrow(find, "id long, label long, size int, vector binary, floor long")


def _negatives(pages: DataFrame, block: pa.Table) -> DataFrame:
    """The result for one block of anchors."""
    queries = {}
    for size in pc.unique(block["size"]).to_pylist():
        own = block.filter(pc.equal(block["size"], size))
        vectors = np.frombuffer(b"".join(own["vector"].to_pylist()), "<i8").reshape(len(own), size)
        queries[size] = Queries(
            vectors, own["id"].to_numpy(), own["label"].to_numpy(), np.arange(len(own)), own["floor"].to_numpy(), np.full(len(own), _MOST)
        )
    positives = _searched(pages, queries, POSITIVES, True).toArrow()
    windows, asked = {}, []
    for size, all_anchors in queries.items():
        own = positives.filter(pc.equal(positives["size"], size))
        row, score, positive = (own[c].to_numpy() for c in ("query", "score", "id"))
        exact = score.astype(object)  # hundredths of a long may not fit one
        low, high = (x.astype(np.int64) for x in (-(-LOW * exact // 100), HIGH * exact // 100))
        on = low <= high
        row, score, positive, low, high = (x[on] for x in (row, score, positive, low, high))
        windows[size] = Queries(all_anchors.vectors, all_anchors.anchors[row], all_anchors.labels[row], row, low, high)
        asked.append(
            pa.table({"size": np.full(len(row), size, np.int32), "query": np.arange(len(row)), "anchor_id": all_anchors.anchors[row],
                      "positive_id": positive, "positive_score": score})
        )
    spark = pages.sparkSession
    asked = spark.createDataFrame(pa.concat_tables(asked))
    found = _searched(pages, windows, NEGATIVES, False)
    return found.join(asked, ["size", "query"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def mine(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    every: int = EVERY, scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id ``every`` divides; each has its POSITIVES best other rows of its
    label, and each of those the NEGATIVES best rows of other labels whose score is LOW to HIGH
    hundredths of the positive's. Higher scores come first, ties by the smaller id. Components
    become ``floor(scale * x)``, scores are whole and saturate at a long. A row without an id, a
    label or a vector, or with a null or non-finite component, takes no part. Of rows that share an
    id the one with the smallest label and then vector counts, so repeated rows count once. Vectors
    of different lengths never meet. A positive with a negative score has no negatives. Other
    columns are not read; an empty table, or one without anchors, has an empty result.
    """
    rows = stage(prepared(embeddings, id_col, vector_col, label_col, scale), "vectors")
    pages = stage(tree(rows), "tree")
    anchors = stage(_anchors(pages, every), "anchors")
    n, total = anchors.agg(F.count("*"), F.sum(F.octet_length("vector"))).first()
    if not n:
        return embeddings.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    blocks = max(1, -(-n // ANCHORS), -(-total // ANCHOR_BYTES))
    anchors = anchors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    parts = []
    for b in range(blocks):
        block = anchors.filter(F.col("block") == b).drop("block").toArrow()
        if len(block):
            parts.append(stage(_negatives(pages, block), "negatives"))
    return reduce(DataFrame.union, parts)
