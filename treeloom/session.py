"""Session settings and the staging of shared intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Edges and names of a text shuffle to roughly the size of the text.
SHUFFLE_BYTES = 128 << 20
# Ids are hex digits, of which a codec without entropy coding saves nothing.
COMPRESSION = "zstd"
# Rows of a file of a staged table. Positions and kinds shrink to a byte or two a row, so a scan that is
# split by bytes would give a task tens of millions of rows, more than it can sort or group in memory.
# A scan takes each file for 4 MB at least, so no task gets more than 32 of these files.
ROWS_PER_FILE = 50_000

_roots: set[str] = set()
_shipped: set[str] = set()


def build_session(
    app_name: str = "treeloom",
    master: str | None = None,
    conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """A session with the settings the jobs are written for.

    Arrow batches are bounded by bytes, because source texts are large values
    and a Python worker holds one batch at a time. ``input_bytes``, the size of the texts to parse, sets how many partitions shuffles start from;
    adaptive execution joins those that turn out small.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
    )
    if input_bytes:
        partitions = max(200, -(-input_bytes // SHUFFLE_BYTES))
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions)
        )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers of a session that lacks it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="treeloom-package-")) / package.name
    archive = shutil.make_archive(str(target), "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def staging_root(spark: SparkSession) -> str:
    """A folder of this application, below ``spark.checkpoint.dir`` or else the warehouse.

    Both are settings of the session and name storage that all executors share. The
    folder is deleted when the application ends, or before by ``clear_staging``.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    root = f"{shared.rstrip('/')}/treeloom-{spark.sparkContext.applicationId}"
    if root not in _roots:
        filesystem, path = hadoop_path(spark, root)
        filesystem.mkdirs(path)
        filesystem.deleteOnExit(path)
        _roots.add(root)
    return root


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def clear_staging(spark: SparkSession) -> None:
    """Delete all staged tables of the application; what still reads them fails."""
    filesystem, path = hadoop_path(spark, staging_root(spark))
    filesystem.delete(path, True)


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``stage`` for readers that are done within the ``with`` block; the table is deleted after it."""
    path = staging_path(df.sparkSession, label)
    df.write.option("compression", COMPRESSION).parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        filesystem, found = hadoop_path(df.sparkSession, path)
        filesystem.delete(found, True)


def stage(df: DataFrame, label: str, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` once and read it back, in files of ``rows_per_file`` at most if that is set.

    Several branches read the same intermediate result; without this each of
    them would run the Python parse again. The table is columnar, so a later
    branch reads only its own columns, and it survives the loss of executors.
    """
    path = staging_path(df.sparkSession, label)
    df.write.option("compression", COMPRESSION).option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
