"""Removal of passages that an earlier document already has.

A window is ``size`` consecutive words. A word goes if a window over it also starts in a
document with a smaller id. Windows are judged on the input.

Method. Positions whose remainder modulo ``PERIOD`` is in ``COVER`` are anchors. COVER is a
perfect difference set, so any two positions reach an anchor of both by the same step of less
than PERIOD; two equal windows of 50 words therefore share a whole anchor of 50 - 31 + 1 = 20
words that starts at the same place in both. Only anchors are hashed and shuffled. Where one
is found in two documents, the windows around it are hashed with 96 bits, and the smallest
id of each decides.

Every task first settles what it holds itself: of an anchor or window that several of its
documents share, it passes on one, so that a passage found in a third of all documents moves
once for each chunk of input and not once for each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from treeloom.llm import words as W
from treeloom.llm.tables import chunks, order_id

SIZE = 50
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR = SIZE - PERIOD + 1

_ANCHORS = pa.schema([("key", pa.int64()), ("did", pa.int64()), ("pos", pa.int32()), ("known", pa.bool_())])
_WINDOWS = pa.schema(
    [("key", pa.int64()), ("key2", pa.int32()), ("did", pa.int64()), ("tid", pa.int32()),
     ("start", pa.int32()), ("n", pa.int32()), ("known", pa.bool_())]
)
_COUNTS = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())]


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Number of the group of each row, for rows sorted by ``keys``."""
    new = np.zeros(len(keys[0]), bool)
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.cumsum(new)


def _shared(group: np.ndarray, did: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by group and id: the smallest id of the group, and whether it has two."""
    first = np.searchsorted(group, np.arange(group[-1] + 1))
    last = np.append(first[1:], len(group)) - 1
    return did[first][group], (did[first] != did[last])[group]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    covered = np.isin(np.arange(PERIOD), COVER)
    for parts in chunks(batches, "text"):
        found = []
        for part in parts:
            words = W.split(part.column("text"))
            starts = words.window_starts(ANCHOR)
            text = words.text_of()[starts]
            pos = starts - words.first[text]
            here = covered[pos % PERIOD]
            starts, text, pos = starts[here], text[here], pos[here]
            did = part.column("did").to_numpy(zero_copy_only=False)[text]
            found.append((words.windows(starts, ANCHOR).view(np.int64), did, pos.astype(np.int32)))
        key, did, pos = (np.concatenate(x) for x in zip(*found, strict=True))
        if not len(key):
            continue
        order = np.lexsort((did, key))
        key, did, pos = key[order], did[order], pos[order]
        least, known = _shared(_groups(key), did)
        # Known ones need no other task; they get a key of their own, and one goes on for others.
        sent = known & (did == least) & np.append(True, key[1:] != key[:-1])
        own = W.mix(did.view(np.uint64) * np.uint64(1 << 21) + pos.astype(np.uint64)).view(np.int64)
        key, did = np.append(np.where(known, own, key), key[sent]), np.append(did, did[sent])
        pos = np.append(pos, np.full(sent.sum(), -1, np.int32))
        known = np.append(known, np.zeros(sent.sum(), bool))
        order = np.lexsort((pos, did))  # equal ids next to each other compress
        yield pa.record_batch([x[order] for x in (key, did, pos, known)], schema=_ANCHORS)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for parts in chunks(batches, "text"):
        found = []
        for part in parts:
            words = W.split(part.column("text"))
            marks = part.column("marks")
            flat = marks.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            text = np.repeat(np.arange(len(marks)), marks.value_lengths().to_numpy(zero_copy_only=False))
            lead = SIZE - ANCHOR
            edge = np.zeros(len(words) + lead + 2, np.int64)
            inside = flat < words.counts[text]  # ids that occur twice bring marks of the other text
            at = words.first[text[inside]] + flat[inside]
            np.add.at(edge, np.maximum(at - lead, words.first[text[inside]]), 1)
            np.add.at(edge, at + 1, -1)
            starts = words.window_starts(SIZE)
            starts = starts[np.cumsum(edge)[starts] > 0]
            text = words.text_of()[starts]
            found.append(
                (words.windows(starts, SIZE).view(np.int64), words.windows(starts, SIZE, 1).astype(np.uint32).view(np.int32),
                 part.column("did").to_numpy(zero_copy_only=False)[text],
                 part.column("tid").to_numpy(zero_copy_only=False)[text],
                 (starts - words.first[text]).astype(np.int32))
            )
        key, key2, did, tid, start = (np.concatenate(x) for x in zip(*found, strict=True))
        if not len(key):
            continue
        order = np.lexsort((did, key2, key))
        key, key2, did, tid, start = (x[order] for x in (key, key2, did, tid, start))
        least, _ = _shared(_groups(key, key2), did)
        known = did > least
        # Rows go out in the order of their texts, which lets equal ids compress. Starts that follow
        # each other are one row where the window is the same, or if they go anyway.
        order = np.lexsort((start, tid, did, known))
        key, key2, did, tid, start, known = (x[order] for x in (key, key2, did, tid, start, known))
        key = np.where(known, W.mix(did.view(np.uint64) * np.uint64(1 << 21) + start.astype(np.uint64)).view(np.int64), key)
        new = np.ones(len(start), bool)
        new[1:] = (known[1:] != known[:-1]) | (did[1:] != did[:-1]) | (tid[1:] != tid[:-1]) | (start[1:] > start[:-1] + 1)
        new[1:] |= ~known[1:] & ((key[1:] != key[:-1]) | (key2[1:] != key2[:-1]))
        head = np.flatnonzero(new)
        n = (start[np.append(head[1:], len(start)) - 1] - start[head] + 1).astype(np.int32)
        yield pa.record_batch([key[head], key2[head], did[head], tid[head], start[head], n, known[head]], schema=_WINDOWS)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for parts in chunks(batches, "text", 4 << 20):
        for part in parts:
            words = W.split(part.column("text"))
            removed = np.zeros(part.num_rows, np.int64)
            kept = part.column("text").to_pylist()
            tids = part.column("tid").to_pylist()
            for row, runs in enumerate(part.column("gone").to_pylist()):
                runs = [r for r in runs or () if r["tid"] == tids[row]]
                if not runs:
                    continue
                first, n = words.first[row], words.counts[row]
                edge = np.zeros(n + 1, np.int64)
                for r in runs:
                    edge[r["start"]] += 1
                    edge[min(n, r["start"] + r["n"] - 1 + SIZE)] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                removed[row] = gone.sum()
                # A kept word goes on up to the next word's start, so layout between kept words stays.
                data = words.data[words.offsets[row] : words.offsets[row + 1]]
                starts = words.starts[first : first + n] - words.offsets[row]
                reach = np.append(starts[1:], len(data))
                lengths = reach - starts
                kept[row] = data[starts[0] :][np.repeat(~gone, lengths)].tobytes().decode("utf-8", "replace")
            yield pa.record_batch(
                [part.column("doc"), pa.array(words.counts.astype(np.int64)), pa.array(removed), pa.array(kept, pa.string())],
                schema=pa.schema([part.schema.field("doc"), *_COUNTS]),
            )


def _repeats(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc`` (the row's columns but the text, as they are), ``n_words, n_removed, kept_text``."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    source = docs.select(
        order_id(id_col).alias("did"), F.hash(F.col(f"`{text_col}`").cast("string")).alias("tid"),
        F.col(f"`{text_col}`").cast("string").alias("text"), F.struct(*others).alias("doc"),
    )
    anchors = source.select("did", "text").mapInArrow(_anchors, "key long, did long, pos int, known boolean")
    same = Window.partitionBy("key")
    marks = (
        anchors.select("*", F.min("did").over(same).alias("least"), F.max("did").over(same).alias("most"))
        .filter("known or (pos >= 0 and least < most)")
        .groupBy("did")
        .agg(F.collect_list("pos").alias("marks"))
    )
    windows = source.join(marks, "did").mapInArrow(
        _windows, "key long, key2 int, did long, tid int, start int, n int, known boolean"
    )
    same = Window.partitionBy("key", "key2")
    gone = (
        windows.select("*", F.min("did").over(same).alias("least"))
        .filter("known or did > least")
        .groupBy("did")
        .agg(F.collect_list(F.struct("tid", "start", "n")).alias("gone"))
    )
    doc = source.schema["doc"].dataType.simpleString()
    return source.join(gone, "did", "left").mapInArrow(
        _cut, f"doc {doc}, n_words long, n_removed long, kept_text string"
    )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for every row of ``docs``.

    Words are runs of bytes other than ASCII white space, unchanged. kept_text has the kept
    words and the white space after each, so equal to the text where nothing goes. Null and
    empty texts have no words and come back as they are. Rows without an id come after all others
    and have no smaller or larger one among themselves; rows that share an id never remove
    from each other. Other columns are not read, whatever their names.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return _repeats(rows, "doc_id", "text").select("doc.doc_id", "n_words", "n_removed", "kept_text")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the kept text in place of the text, without rows that lose every word.

    All other columns come back as they are; texts that lose nothing do so too, null ones as null.
    """
    found = _repeats(docs, id_col, text_col).filter("n_words = 0 or n_removed < n_words")
    columns = [
        F.col("kept_text").alias(c) if c == text_col else F.col(f"doc.`{c}`") for c in docs.columns
    ]
    return found.select(*columns)
