"""Groups of words that are spelled almost alike, each with its most frequent form.

Two words are near if one inserted, deleted or replaced code point turns one into the other. The
form of a word is its near word of the largest count, if that count is ``RATIO`` times its own.

Method. An edit changes the count of at most two letters by one each, so the letter counts of near
words are at a squared distance of two at most, and their lengths differ by one at most. Words are
laid out in blocks of one length, and a block meets those of the same and of the next length: the
product of their letter-count matrices gives all squared distances at once, and pairs at two or
less are compared letter by letter. The same bound is used before blocks meet: letters are dealt
into GROUPS groups, blocks hold words with equal counts in each group, and an edit moves one letter
from one group to another or adds one to a group, so a block meets ``1 + 15 + 6`` others at most.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeloom.llm.tables import slices, spread
from treeloom.session import stage

LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2
GROUPS = 6
#: Words of a block, on average, and letters in it.
BLOCK = 2048
LETTERS = 1 << 20
#: Different words that a task counts before it passes them on.
HELD = 500_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_UPPER = bytes(range(0x41, 0x5B))
_LOWERED = bytes.maketrans(_UPPER, _UPPER.lower())
#: Letters by frequency in Latin scripts, dealt to the groups in turn. Any order gives the same pairs.
_DEALT = "etaoinshrdlucmfwypvbgkjqxz" + "".join(map(chr, range(0xC0, 0x100)))


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int = 0) -> DataFrame:
    """``word, n``: the letter runs of all whole texts, A-Z lower-cased, of LEAST_LENGTH and LEAST_COUNT or more.

    With ``drop_every`` a run of a document whose ``crc32("<id>:<run>")`` it divides loses the letter
    at that checksum modulo its length, which plants typing errors; an id that is null reads as
    empty there. Null texts have no words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            words = [w for w in total if len(w) >= LEAST_LENGTH]
            return pa.record_batch([pa.array(words, pa.string()), pa.array([total[w] for w in words], pa.int64())], names=["word", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                for name, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    if not text:
                        continue
                    runs = Counter(_RUN.findall(text.encode().translate(_LOWERED).decode()))
                    if not drop_every:
                        total.update(runs)
                        continue
                    seed = zlib.crc32(f"{name or ''}:".encode())
                    for run, n in runs.items():
                        check = zlib.crc32(run.encode(), seed)
                        if check % drop_every == 0:
                            at = check % len(run)
                            run = run[:at] + run[at + 1 :]
                        total[run] += n
                if len(total) > HELD:
                    yield counted()
                    total.clear()
        yield counted()

    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counts = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= LEAST_COUNT)


def _cell(word: str) -> Column:
    """Length of the word and its letters of each group but the last."""
    groups = ["".join(_DEALT[g::GROUPS]) for g in range(GROUPS)]
    own = [F.length(word) - F.length(F.translate(word, letters, "")) for letters in groups[:-1]]
    return F.array(*own, F.length(word) - sum(own, F.lit(0)))


def _key(cell: list[Column]) -> Column:
    return F.concat_ws(",", *[c.cast("string") for c in cell])


def _blocks(words: DataFrame) -> DataFrame:
    """``key, cell, piece, words, counts``: words in code-point order, of equal length and group counts."""
    own = words.select("word", "n", _cell("word").alias("cell"))
    size = own.groupBy("cell").agg(F.count("*").alias("size"), F.max(F.length("word")).alias("length"))
    pieces = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("size") * F.col("length") / LETTERS))
    own = own.join(size.select("cell", pieces.alias("pieces")), "cell")
    own = own.withColumn("piece", F.pmod(F.xxhash64("word"), "pieces"))
    blocks = own.groupBy("cell", "piece").agg(F.array_sort(F.collect_list(F.struct("word", "n"))).alias("rows"))
    return blocks.select(
        _key([F.col("cell")[i] for i in range(GROUPS)]).alias("key"), "cell", "piece",
        F.col("rows.word").alias("words"), F.col("rows.n").alias("counts"),
    )


def _neighbours() -> Column:
    """Keys of the cells that near words can be in, each pair of cells from one side only."""
    moves = [[0] * GROUPS]
    for i in range(GROUPS):
        moves.append([int(k == i) for k in range(GROUPS)])
        moves += [[int(k == j) - int(k == i) for k in range(GROUPS)] for j in range(i + 1, GROUPS)]
    return F.array(*[_key([F.col("cell")[k] + move[k] for k in range(GROUPS)]) for move in moves])


def _letters(words: list[str]) -> np.ndarray:
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return flat.reshape(len(words), -1)


def _gram(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the letter counts of all words of one block from all of the other."""
    used = np.unique(np.append(a, b))
    exact = np.float32 if b.shape[1] < 1000 else np.float64

    def counts(block: np.ndarray) -> np.ndarray:
        at = np.searchsorted(used, block) + np.arange(len(block))[:, None] * len(used)
        return np.bincount(at.ravel(), minlength=len(block) * len(used)).reshape(len(block), -1).astype(exact)

    x, y = counts(a), counts(b)
    one_x, one_y = np.ones((len(x), 1), exact), np.ones((len(y), 1), exact)
    x = np.hstack([-2 * x, (x * x).sum(1, keepdims=True), one_x])
    y = np.hstack([y, one_y, (y * y).sum(1, keepdims=True)])
    return x @ y.T


def _edited(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows differ by one replaced letter, or by one letter that ``b`` has more."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    front = np.cumprod(a == b[:, :-1], axis=1, dtype=np.int8).sum(1, dtype=np.int64)
    back = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(1, dtype=np.int64)
    return front + back >= a.shape[1]


def near_pairs(a: list[str], b: list[str], same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of near words; words of a list have one length, those of ``b`` none or one more."""
    x, y = _letters(a), _letters(b)
    i, j = np.nonzero(_gram(x, y) < 2.5)
    if same:
        i, j = i[i < j], j[i < j]
    step = max(1, (1 << 22) // y.shape[1])
    near = [_edited(x[i[s : s + step]], y[j[s : s + step]]) for s in range(0, len(i), step)]
    near = np.concatenate([np.zeros(0, bool), *near])
    return i[near], j[near]


def _summed(words: list[str], others: list[str], n: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """A row for each word that has near ones: how many, and the most frequent, the first of equals."""
    order = np.lexsort((j, -n[j], i))
    i, j = i[order], j[order]
    own, first, count = np.unique(i, return_index=True, return_counts=True)
    best = j[first]
    return pa.record_batch(
        [pa.array([words[k] for k in own], pa.string()), pa.array(count.astype(np.int64)), pa.array(-n[best]),
         pa.array([others[k] for k in best], pa.string())],
        names=["word", "n_near", "less", "form"],
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c) for c in ("words", "counts", "others", "other_counts", "same")]
        found = []
        for a, n_a, b, n_b, same in zip(*columns, strict=True):
            a, b = a.as_py(), b.as_py()
            i, j = near_pairs(a, b, same.as_py())
            if len(i):
                found += [_summed(a, b, n_b.values.to_numpy(), i, j), _summed(b, a, n_a.values.to_numpy(), j, i)]
        if found:
            yield from pa.Table.from_batches(found).combine_chunks().to_batches(10_000)


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, form, form_n`` for the words of ``word, n`` that have a near one; form has the largest n."""
    blocks = stage(_blocks(words), "blocks")
    left = blocks.select(
        F.explode(_neighbours()).alias("key"), F.col("key").alias("own"), F.col("piece").alias("own_piece"), "words", "counts"
    )
    right = blocks.select("key", "piece", F.col("words").alias("others"), F.col("counts").alias("other_counts"))
    same_cell = F.col("l.own") == F.col("r.key")
    pairs = left.alias("l").join(
        right.alias("r"),
        [F.col("l.key") == F.col("r.key"), ~same_cell | (F.col("own_piece") <= F.col("piece"))],
    )
    pairs = pairs.select(
        "own", "own_piece", "r.key", "piece", "words", "counts", "others", "other_counts",
        (same_cell & (F.col("own_piece") == F.col("piece"))).alias("same"),
    )
    # Few bytes, much work: a block's pairs are dealt over all tasks.
    pairs = spread(pairs, "own", "own_piece", "key", "piece").drop("own", "own_piece", "key", "piece")
    # A word with many near ones is one row for each pair of blocks.
    found = pairs.mapInArrow(_compare, "word string, n_near long, less long, form string")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "form")).alias("best"))
    return found.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for the words of ``word, form``: where following forms ends.

    Each round doubles the steps taken. Counts at least double from word to form, so a chain has
    fewer steps than the largest count has bits.
    """
    roots = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        onward = stage(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = onward.select("word", "root")
        if onward.filter("moved").isEmpty():
            return roots


def group_variants(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``word, n``, each word once.

    form is the near word of the largest n, the first in code-point order of equal ones, if its n
    is RATIO times the word's or more, else null like form_n; root is where following forms ends,
    the word itself without one; n_near counts near words. An empty table has an empty result. A
    repeated word counts once, with the sum of its n; null words and those without a letter go.
    """
    words = words.filter(F.length("word") > 0).groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = stage(words, "words")
    near = words.join(near_words(words), "word", "left")
    formed = F.col("form_n") >= RATIO * F.col("n")
    near = near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n"),
    )
    near = stage(near, "forms")
    roots = _roots(near.filter("form is not null"))
    return near.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int = 0) -> DataFrame:
    """``group_variants`` of the words of all whole texts (``count_words``).

    Rows without an id or that repeat one count like any other; other columns are not read,
    whatever their names. Null and empty texts, and an empty table, have no words.
    """
    return group_variants(count_words(docs, id_col, text_col, drop_every))
