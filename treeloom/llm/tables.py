"""Identifiers and shared steps of the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LAST_ID = (1 << 63) - 1
#: Bits of the filter that thins out rows before a shuffle (8 MB at most). Fuller, it thins less.
SIEVE_BITS = 1 << 26


def order_id(column: str) -> Column:
    """The id as a long that is never null: rows without an id come after all others."""
    return F.coalesce(F.col(f"`{column}`").cast("long"), F.lit(LAST_ID))


def public_id(column: str) -> Column:
    """The id that ``order_id`` was made from."""
    return F.when(F.col(column) != LAST_ID, F.col(column))


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` over all shuffle partitions, for rows that are small but soon become many."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *columns)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and total + size > limit:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def chunks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = 32 << 20
) -> Iterator[list[pa.RecordBatch]]:
    """Consecutive slices of a task's rows with about ``limit`` bytes of text together."""
    held, total = [], 0
    for batch in batches:
        for part in slices(batch, column):
            held.append(part)
            total += part.column(column).nbytes
            if total >= limit:
                yield held
                held, total = [], 0
    if held:
        yield held


def sieve(ids: DataFrame, column: str) -> Column | None:
    """A test that is true of every row whose id ``ids`` has, and of few others; None without ids.

    At most SIEVE_BITS bits, set by tasks and put together in the driver.
    """
    at = F.pmod(F.xxhash64(column), F.lit(SIEVE_BITS))
    words = ids.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toArrow()
    if not words.num_rows:
        return None
    bits = np.zeros(SIEVE_BITS // 64, np.int64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy()
    shared = ids.sparkSession.sparkContext.broadcast(bits.view(np.uint64))

    @F.arrow_udf("boolean")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for at in batches:
            at = at.to_numpy(zero_copy_only=False)
            yield pa.array((shared.value[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool))

    return found(at)
