"""Latest-wins tables kept as change folders and snapshots.

A batch adds a folder of changes, so writing costs what the batch holds and not what the table
holds. Now and then the changes are folded into a snapshot, which has the latest row of each key
in buckets (a large table only once the changes are as large as it is): a bucket holds the keys whose hash begins with its bits. A fold rewrites only the
buckets that have changes, and splits those that would hold more than ``BUCKET_ROWS`` rows by
further bits, so tasks and lookups stay of one size while the table grows. The layout of a version
names its buckets and the version each was last written in, and the notes of a version say up to
which batch of each feed it goes. A version counts once its layout is complete, so readers see the
old one or the new one; they read the last version and the batches after it. What a version
replaced is deleted with the next one, when no reader that began before can still need it. Feeds
that want to fold one table at once each try to create the claim of the next version, which one
can; the others go on without.

The driver holds the layout, one small row for each ``BUCKET_ROWS`` rows at most, as it holds the list of files.
A folder that is complete is never written again: a batch that runs again holds the same events.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from treeloom import schemas
from treeloom.session import COMPRESSION, hadoop_path

# Rows of a bucket, but for the scatter of hashes over the parts of a split; a bucket that got more
# is split by the next fold that changes it. A lookup of one key reads one bucket, a fold has one task for it.
BUCKET_ROWS = 1_000_000
# Batches between two snapshots of a stream's table.
FOLD_EVERY = 100
# Bytes of a snapshot above which a fold waits until the changes are as large as the snapshot is.
FOLD_BYTES = 64 << 20
# Milliseconds after which a claim counts as left behind by a driver that was lost.
CLAIM_AGE = 3_600_000
# Feeds of a single batch, named by what follows: their folders go once a snapshot holds them.
RUN = "run-"


class Bucket(NamedTuple):
    """Keys whose hash begins with ``bucket``, a number of ``bits`` bits."""

    bits: int
    bucket: int
    version: int
    rows: int


LAYOUT = "bits INT, bucket BIGINT, version BIGINT, rows BIGINT"
# A table without a snapshot.
WHOLE = [Bucket(0, 0, 0, 0)]


def latest(df: DataFrame, keys: list[str], order: str = "position") -> DataFrame:
    """The whole latest row per key, nulls included.

    The maximum is taken per task before the shuffle, so a key that was sent
    very often arrives as one row per task. Of rows with one order the one with the larger columns
    counts. Rows are compared whole, so what moves holds the order once; maps have no order.
    """
    rest = [c for c in df.columns if c not in (*keys, order)]
    newest = df.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("row"))
    return newest.select(*keys, "row.*").select(*df.columns)


def feed_name(checkpoint: str) -> str:
    """Batch numbers restart with a new checkpoint; this keeps their folders apart."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:12]


def _complete(spark: SparkSession, path: str) -> bool:
    filesystem, marker = hadoop_path(spark, f"{path}/_SUCCESS")
    return filesystem.exists(marker)


def _folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows ``prefix`` in the names of the folders in ``path``."""
    filesystem, parent = hadoop_path(spark, path)
    if not filesystem.exists(parent):
        return []
    names = [status.getPath().getName() for status in filesystem.listStatus(parent)]
    return sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix))


def _changes(spark: SparkSession, path: str, after: dict[str, int]) -> dict[tuple[str, int], str]:
    """Complete change folders by feed and batch, beyond those a snapshot holds."""
    found = {}
    for feed in _folders(spark, path, "feed="):
        for batch in _folders(spark, f"{path}/feed={feed}", "batch="):
            folder = f"{path}/feed={feed}/batch={batch}"
            if int(batch) > after.get(feed, -1) and _complete(spark, folder):
                found[feed, int(batch)] = folder
    return found


def _layout(spark: SparkSession, path: str, version: int) -> list[Bucket]:
    rows = spark.read.schema(LAYOUT).parquet(f"{path}/layout/version={version}").collect()
    return [Bucket(*row) for row in rows]


def _snapshot(spark: SparkSession, path: str) -> tuple[int, dict[str, int], list[Bucket]]:
    """The last complete version, 0 for none, the last batch of each feed in it, and its buckets."""
    versions = [int(v) for v in _folders(spark, f"{path}/layout", "version=")]
    for version in sorted(versions, reverse=True):
        if _complete(spark, f"{path}/layout/version={version}"):
            rows = spark.read.schema("feed STRING, batch BIGINT").parquet(f"{path}/folded/version={version}")
            return version, {r["feed"]: r["batch"] for r in rows.collect()}, _layout(spark, path, version)
    return 0, {}, WHOLE


def write_changes(df: DataFrame, path: str, feed: str, batch_id: int) -> None:
    folder = f"{path}/feed={feed}/batch={batch_id}"
    if not _complete(df.sparkSession, folder):
        df.write.mode("overwrite").option("compression", COMPRESSION).parquet(folder)


def read_batch(spark: SparkSession, path: str, schema: T.StructType, feed: str, batch_id: int) -> DataFrame:
    """The changes that a batch wrote, for its own further steps: folds leave its last folder alone."""
    columns = T.StructType([*schema.fields, schemas.POSITION])
    return spark.read.schema(columns).parquet(f"{path}/feed={feed}/batch={batch_id}")


def _first_bits(value: Column, bits: Column) -> Column:
    # In two steps, as a shift by 64 places is none.
    half = F.shiftrightunsigned(value, 1)
    return F.call_function("shiftrightunsigned", half, F.lit(63) - bits)


def _in_buckets(rows: DataFrame, keys: list[str], buckets: DataFrame) -> DataFrame:
    """``rows`` with the columns of their bucket, and the hash of their key.

    A bucket is found by an equality join on its bits; buckets have few different numbers of bits.
    """
    depths = [r["bits"] for r in buckets.select("bits").distinct().collect()]
    rows = rows.withColumn("hash", F.xxhash64(*keys))
    rows = rows.withColumn("bits", F.explode(F.array(*[F.lit(d) for d in depths])))
    rows = rows.withColumn("bucket", _first_bits(F.col("hash"), F.col("bits")))
    return rows.join(buckets, ["bits", "bucket"])


def _folder(path: str, bucket: Bucket) -> str:
    return f"{path}/snapshots/version={bucket.version}/bits={bucket.bits}/bucket={bucket.bucket}"


def _read(spark: SparkSession, columns: T.StructType, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).option("recursiveFileLookup", "true").parquet(*folders)


def read_changes(
    spark: SparkSession, path: str, schema: T.StructType, where: dict[str, object] | None = None
) -> DataFrame:
    """The last snapshot and all changes after it; a table nobody has written to yet has none.

    ``where`` gives the whole key of the rows that are wanted: then one bucket of the snapshot
    is read.
    """
    columns = T.StructType([*schema.fields, schemas.POSITION])
    _, folded, buckets = _snapshot(spark, path)
    if where:
        wanted = [F.lit(v).cast(columns[k].dataType) for k, v in where.items()]
        whole = spark.range(1).select(F.xxhash64(*wanted)).first()[0] % (1 << 64)
        buckets = [b for b in buckets if whole >> (64 - b.bits) == b.bucket]
    folders = list(_changes(spark, path, folded).values())
    rows = _read(spark, columns, folders + [_folder(path, b) for b in buckets if b.rows])
    for key, value in (where or {}).items():
        rows = rows.filter(F.col(key).eqNullSafe(F.lit(value)))
    return rows


def read_latest(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str]
) -> DataFrame:
    return latest(read_changes(spark, path, schema), keys)


def _claim(spark: SparkSession, path: str, version: int) -> bool:
    """Whether the caller may write the version: only one creates its file, unless that is too old."""
    filesystem, claim = hadoop_path(spark, f"{path}/claims/version-{version}")
    filesystem.mkdirs(claim.getParent())
    if filesystem.exists(claim):
        made = filesystem.getFileStatus(claim).getModificationTime()
        if spark.sparkContext._jvm.java.lang.System.currentTimeMillis() - made < CLAIM_AGE:
            return False
        filesystem.delete(claim, False)
    try:
        return filesystem.createNewFile(claim)
    except Py4JJavaError:  # some stores raise where another was first
        return False


def _further_bits(rows: int, most: int) -> int:
    """Bits by which a bucket of so many rows is split."""
    return next(k for k in range(64) if rows <= most << k)


def fold(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str], bucket_rows: int | None = None
) -> None:
    """Make a new snapshot of the table, and delete what the one before the last replaced.

    A bucket that might outgrow ``bucket_rows`` with the keys of the changes is split first.
    """
    version, folded, buckets = _snapshot(spark, path)
    changes = _changes(spark, path, folded)
    if not changes or not _claim(spark, path, version + 1):
        return
    feeds = set(_folders(spark, path, "feed="))
    now = {feed: batch for feed, batch in folded.items() if feed in feeds or not feed.startswith(RUN)}
    for feed, batch in changes:
        now[feed] = max(batch, now.get(feed, -1))
    notes = spark.createDataFrame(list(now.items()), "feed STRING, batch BIGINT")
    notes.write.mode("overwrite").parquet(f"{path}/folded/version={version + 1}")
    # What other feeds add meanwhile is in later folders than the notes name, and read again on top.
    columns = T.StructType([*schema.fields, schemas.POSITION])
    added = _read(spark, columns, list(changes.values()))
    layout = _rewrite(spark, path, version + 1, added, keys, buckets, bucket_rows or BUCKET_ROWS)
    spark.createDataFrame(layout, LAYOUT).write.mode("overwrite").parquet(f"{path}/layout/version={version + 1}")
    _forget(spark, path, version, folded, {*buckets, *layout})


def _rewrite(
    spark: SparkSession, path: str, version: int, added: DataFrame, keys: list[str], buckets: list[Bucket], most: int
) -> list[Bucket]:
    """Write the buckets that ``added`` changes, and return the layout that has them."""
    names = added.columns
    found = _in_buckets(added.select(*keys), keys, spark.createDataFrame(buckets, LAYOUT))
    found = found.select("bits", "bucket", "hash").distinct().groupBy("bits", "bucket").count()
    more = {(r["bits"], r["bucket"]): r["count"] for r in found.collect()}
    touched = [b for b in buckets if (b.bits, b.bucket) in more]
    if not touched:
        return buckets
    depths = {b: b.bits + _further_bits(b.rows + more[b.bits, b.bucket], most) for b in touched}
    split = spark.createDataFrame([(b.bits, b.bucket, d) for b, d in depths.items()], "bits INT, bucket BIGINT, into INT")
    rows = added.unionByName(_read(spark, added.schema, [_folder(path, b) for b in touched if b.rows]))
    rows = _in_buckets(rows, keys, split).withColumn("bits", F.col("into"))
    rows = rows.withColumn("bucket", _first_bits(F.col("hash"), F.col("bits"))).select(*names, "bits", "bucket")
    # One shuffle: rows that lie by bucket lie by bucket and key too.
    rows = latest(rows.repartition("bits", "bucket"), [*keys, "bits", "bucket"])
    target = f"{path}/snapshots/version={version}"
    rows.write.mode("overwrite").partitionBy("bits", "bucket").option("compression", COMPRESSION).parquet(target)
    written = spark.read.schema(rows.schema).parquet(target).groupBy("bits", "bucket").count()
    sizes = {(r["bits"], r["bucket"]): r["count"] for r in written.collect()}
    layout = [b for b in buckets if (b.bits, b.bucket) not in more]
    for old, bits in depths.items():
        first = old.bucket << (bits - old.bits)
        for bucket in range(first, first + (1 << (bits - old.bits))):
            layout.append(Bucket(bits, bucket, version, sizes.get((bits, bucket), 0)))
    return layout


def _forget(spark: SparkSession, path: str, version: int, folded: dict[str, int], kept: set[Bucket]) -> None:
    """Delete the versions before ``version`` but for the buckets still ``kept``, and the changes that it holds."""
    old = []
    for v in (int(v) for v in _folders(spark, f"{path}/layout", "version=")):
        if v < version:
            if _complete(spark, f"{path}/layout/version={v}"):
                old += [_folder(path, b) for b in _layout(spark, path, v) if b.rows and b not in kept]
            # Last, so that what a lost driver leaves behind is found again.
            old += [f"{path}/folded/version={v}", f"{path}/layout/version={v}"]
    used = {b.version for b in kept}
    old += [
        f"{path}/snapshots/version={v}" for v in _folders(spark, f"{path}/snapshots", "version=")
        if int(v) < version and int(v) not in used
    ]
    for feed, last in folded.items():
        if feed.startswith(RUN):
            old.append(f"{path}/feed={feed}")
            continue
        for batch in _folders(spark, f"{path}/feed={feed}", "batch="):
            if int(batch) <= last:
                old.append(f"{path}/feed={feed}/batch={batch}")
    for folder in old:
        filesystem, found = hadoop_path(spark, folder)
        filesystem.delete(found, True)


def _bytes(spark: SparkSession, folders: list[str]) -> int:
    total = 0
    for folder in folders:
        filesystem, found = hadoop_path(spark, folder)
        try:
            total += filesystem.getContentSummary(found).getLength()
        except Py4JJavaError:  # another feed folded it and deleted it meanwhile
            continue
    return total


def _worth_folding(spark: SparkSession, path: str) -> bool:
    """Whether the changes that wait are as large as the snapshot, or that is small.

    Keys are hashes, so a batch changes nearly all buckets: folding a large table after every batch
    would rewrite it each time, in all the square of its size. So what folds write stays within
    a few times what the batches hold, and readers read at most about twice the snapshot.
    """
    _, folded, buckets = _snapshot(spark, path)
    held = _bytes(spark, [_folder(path, b) for b in buckets if b.rows])
    return held <= FOLD_BYTES or _bytes(spark, list(_changes(spark, path, folded).values())) >= held


def fold_at_times(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str], batch_id: int, every: int
) -> None:
    """Fold after each ``every`` batches of a stream, a large table once it is worth it."""
    if (batch_id + 1) % every == 0 and _worth_folding(spark, path):
        fold(spark, path, schema, keys)


def fold_when_many(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str], every: int
) -> None:
    """Fold once ``every`` batches wait, for tables whose batches have no running number."""
    if len(_changes(spark, path, _snapshot(spark, path)[1])) >= every:
        fold(spark, path, schema, keys)
