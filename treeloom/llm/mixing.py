"""Interleaving of sources in proportion to target weights.

Documents of a source, in a fixed pseudo-random order, form blocks of ``block`` documents. Time
is counted in blocks, and source s is due w(s) blocks for each: by Pfair scheduling its i-th
block (from 0) may start at floor(i / w) and must end by ceil((i + 1) / w), and of the blocks
that may start, the one that must end first goes next. So at any time each source has less than
one block more or less than its weight says.

Weights are shares of a round of ``round_blocks`` blocks, so the schedule repeats from round to
round while all sources last. When a source runs out, the rounds that follow are scheduled from
what the others put into a round: the weights of those still there, relative to each other.
Every document is placed exactly once.

The schedule of a round is found from one row for each source and is the only thing computed
outside of DataFrames; its size is bounded by MOST_SOURCES and ``round_blocks``. No task ever
holds a source: documents are ranked within BUCKETS hash buckets, after which bucket counts
give the rank within the source.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treeloom.llm.tables import LAST_ID

BLOCK = 64
ROUND_BLOCKS = 1000
BUCKETS = 4096
MOST_SOURCES = 10_000


def shares(weights: dict[str, float], blocks: int) -> dict[str, int]:
    """Whole blocks of a round for each source, in proportion as far as they go, at least one."""
    blocks = max(blocks, len(weights))
    total = sum(weights.values())
    out = {s: max(1, int(blocks * w / total)) for s, w in weights.items()}
    order = sorted(weights, key=lambda s: (out[s] - blocks * weights[s] / total, s))
    for s in order[: max(0, blocks - sum(out.values()))]:
        out[s] += 1
    return out


def earliest_deadline_first(quota: dict[str, int]) -> list[tuple[str, int]]:
    """The order of one round in which each source has its quota of blocks: ``(source, block)``."""
    slots = sum(quota.values())
    release = [[] for _ in range(slots)]
    for s, n in sorted(quota.items()):
        for i in range(n):
            # floor(i / w) and ceil((i + 1) / w) with w = n / slots, in whole numbers. Of equal
            # deadlines the one whose next window overlaps goes first, then the heavier source.
            deadline = -(-(i + 1) * slots // n)
            overlaps = (i + 1) * slots % n != 0
            release[i * slots // n].append((deadline, not overlaps, -n, s, i))
    ready: list[tuple] = []
    order = []
    for slot in range(slots):
        for job in release[slot]:
            heapq.heappush(ready, job)
        if ready:  # weights add up to one, so there always is one
            job = heapq.heappop(ready)
            order.append((job[3], job[4]))
    return order


def rounds(blocks: dict[str, int], share: dict[str, int]) -> list[tuple[int, int, int, dict[str, int]]]:
    """Spans of alike rounds: ``(first round, rounds, first slot, quota)``."""
    cuts = sorted({0} | {x for s, n in blocks.items() for x in (n // share[s], -(-n // share[s]))})
    out, slot = [], 0
    for first, after in zip(cuts, cuts[1:], strict=False):
        quota = {s: min(share[s], n - first * share[s]) for s, n in blocks.items() if n > first * share[s]}
        out.append((first, after - first, slot, quota))
        slot += (after - first) * sum(quota.values())
    return out


def _source(column: str) -> Column:
    """Rows without a source are a source of their own, apart from any name."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{column}`").cast("string")), F.lit(""))


def mix(
    docs: DataFrame,
    targets: dict[str | None, float] | None = None,
    temperature: float = 0.7,
    id_col: str = "doc_id",
    source_col: str = "source",
    block: int = BLOCK,
    round_blocks: int = ROUND_BLOCKS,
) -> DataFrame:
    """``docs`` with ``mix_round``, ``mix_slot`` and ``mix_row``: ordered by (mix_slot, mix_row),
    any prefix has less than one block more or less of a source than its weight in the round.

    ``targets`` are relative weights by source (None for rows without one). Without them, a
    source of n documents weighs n ** temperature. Sources that have no positive target get one
    block in a round. Rows without an id and repeated rows are placed like others; ties in the
    pseudo-random order are broken by the id and are otherwise interchangeable. Columns of the
    input that bear one of the three names are replaced. An empty input comes back empty.
    """
    taken = [c for c in docs.columns if c in ("mix_round", "mix_slot", "mix_row")]
    docs = docs.drop(*taken)
    at = F.xxhash64(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(str(LAST_ID))))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), _source(source_col).alias("source"),
        at.alias("at"), F.pmod(at, F.lit(BUCKETS)).cast("int").alias("bucket"),
    )
    in_bucket = keyed.groupBy("source", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = in_bucket.select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    sizes = in_bucket.groupBy("source").agg(F.sum("n").alias("n"))
    sizes = {r["source"]: r["n"] for r in sizes.limit(MOST_SOURCES + 1).collect()}
    if len(sizes) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: group them before mixing")
    if targets is None:
        weights = {s: n**temperature for s, n in sizes.items()}
    else:
        weights = {("" if s is None else f"={s}"): w for s, w in targets.items()}
        weights = {s: max(0.0, weights.get(s, 0.0)) for s in sizes}
        if not any(weights.values()):
            weights = dict.fromkeys(sizes, 1.0)
    share = shares(weights, round_blocks) if sizes else {}
    blocks = {s: -(-n // block) for s, n in sizes.items()}

    spans, places = [], []
    for kind, (first, n, slot, quota) in enumerate(rounds(blocks, share) if sizes else []):
        spans += [(s, first, n, kind, slot, sum(quota.values())) for s in quota]
        places += [(kind, s, i, slot) for slot, (s, i) in enumerate(earliest_deadline_first(quota))]
    spark = docs.sparkSession
    spans = spark.createDataFrame(
        spans, "source string, first long, rounds long, kind int, base long, slots long"
    )
    places = spark.createDataFrame(places, "kind int, source string, i long, place long")
    # Both tables are bounded by sources and blocks of a round; every round of a span has its row.
    share_of = spark.createDataFrame(list(share.items()), "source string, share long")

    rank = F.row_number().over(Window.partitionBy("source", "bucket").orderBy("at", f"doc.`{id_col}`"))
    ranked = keyed.select("doc", "source", "bucket", rank.alias("rank"))
    ranked = ranked.join(offsets, ["source", "bucket"]).withColumn("rank", F.col("offset") + F.col("rank") - 1)
    ranked = ranked.withColumn("n", F.expr(f"rank div {block}")).withColumn("mix_row", F.expr(f"rank % {block}"))
    ranked = ranked.join(F.broadcast(share_of), "source").select(
        "doc", "source", "mix_row", F.expr("n div share").alias("mix_round"), F.expr("n % share").alias("i")
    )
    ranked = ranked.join(
        F.broadcast(spans.withColumnRenamed("source", "of")),
        F.expr("source = of and mix_round >= first and mix_round < first + rounds"),
    ).join(F.broadcast(places), ["kind", "source", "i"])
    slot = F.expr("base + (mix_round - first) * slots + place")
    return ranked.select("doc.*", "mix_round", slot.alias("mix_slot"), F.col("mix_row").cast("long"))


def in_order(mixed: DataFrame) -> DataFrame:
    """``mixed`` as files that follow each other in the order of the mixture."""
    return mixed.repartitionByRange("mix_slot", "mix_row").sortWithinPartitions("mix_slot", "mix_row")
