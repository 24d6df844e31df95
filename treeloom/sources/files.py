"""Discovery and reading of source trees, and file listings.

Spark's own file sources skip every name that starts with an underscore, which
in a Python tree means each ``__init__.py``. Folders are therefore listed by
tasks, level by level: one row per folder, so a folder that holds most of the
tree delays only its own listing, never that of its subfolders.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from treeloom import schemas
from treeloom.functions import paths
from treeloom.session import stage

_ENTRY = "rel_path STRING, size_bytes BIGINT, is_folder BOOLEAN"
ROWS_PER_FRAME = 10_000
BYTES_PER_FRAME = 64 << 20
BYTES_PER_TASK = 256 << 20


def _open_root(root: str) -> tuple[fs.FileSystem, str]:
    filesystem, base = fs.FileSystem.from_uri(root)
    return filesystem, base.rstrip("/")


def _entries(
    filesystem: fs.FileSystem, base: str, folder: str
) -> Iterator[tuple[str, int | None, bool]]:
    """Path, size and kind of what is in a folder.

    Local folders are read entry by entry, and links to folders are files that
    nobody descends into; other stores have no links.
    """
    path = f"{base}/{folder}".rstrip("/")
    if isinstance(filesystem, fs.LocalFileSystem):
        with os.scandir(path or "/") as found:
            for entry in found:
                is_folder = entry.is_dir(follow_symlinks=False)
                if is_folder or entry.is_file():
                    size = None if is_folder else entry.stat().st_size
                    yield f"{folder}/{entry.name}".lstrip("/"), size, is_folder
        return
    for entry in filesystem.get_file_info(fs.FileSelector(path)):
        yield entry.path[len(base) + 1 :], entry.size, entry.type == fs.FileType.Directory


def _list_folders(root: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, base = _open_root(root)
        for frame in frames:
            for folder in frame["rel_path"]:
                entries = _entries(filesystem, base, folder)
                while rows := list(islice(entries, ROWS_PER_FRAME)):
                    yield pd.DataFrame(
                        rows, columns=["rel_path", "size_bytes", "is_folder"]
                    ).astype({"size_bytes": "Int64"})

    return run


def listing(entries: DataFrame) -> DataFrame:
    """``rel_path, size_bytes`` rows to a listing: paths unified, flags set."""
    path = paths.normalise(F.col("rel_path"))
    return (
        entries.select(path.alias("rel_path"), F.col("size_bytes").cast("long"))
        .filter(~paths.in_version_control(F.col("rel_path")))
        .withColumn("excluded", paths.is_excluded(F.col("rel_path")))
    )


def discover(spark: SparkSession, root: str, suffix: str = ".py") -> DataFrame:
    """Listing of all files under ``root`` whose name ends with ``suffix``.

    ``root`` is a path or URI every executor can reach. Sizes come from the
    listing; no file is opened.
    """
    folders = spark.createDataFrame([("",)], "rel_path STRING")
    levels: list[DataFrame] = []
    while True:
        level = stage(
            folders.repartition(spark.sparkContext.defaultParallelism).mapInPandas(
                _list_folders(root), _ENTRY
            ),
            "listing",
        )
        levels.append(level)
        folders = level.filter("is_folder").select("rel_path")
        folders = folders.filter(~paths.in_version_control(F.col("rel_path")))
        if folders.isEmpty():
            break
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return listing(found.filter(~F.col("is_folder") & F.col("rel_path").endswith(suffix)))


def _read_files(root: str, prefix: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, base = _open_root(root)
        pending: list[tuple] = []
        held = 0
        for frame in frames:
            for rel_path in frame["rel_path"]:
                content, failure = None, None
                try:
                    with filesystem.open_input_stream(f"{base}/{rel_path}") as stream:
                        content = stream.read()
                except OSError as error:
                    failure = str(error)
                pending.append((f"{prefix}/{rel_path}", content, failure))
                held += len(content or b"")
                if held >= BYTES_PER_FRAME or len(pending) >= ROWS_PER_FRAME:
                    yield pd.DataFrame(pending, columns=schemas.SOURCE.names)
                    pending, held = [], 0
        if pending:
            yield pd.DataFrame(pending, columns=schemas.SOURCE.names)

    return run


def read_sources(targets: DataFrame, root: str, repository: str) -> DataFrame:
    """Contents of the listed files under their logical paths.

    Only the short listing rows are shuffled, to spread the reading over tasks of
    a bounded share of the bytes; a file that cannot be read gives a row with the
    reason.
    """
    cores = targets.sparkSession.sparkContext.defaultParallelism
    total = targets.agg(F.sum("size_bytes")).first()[0] or 0
    return (
        targets.select("rel_path")
        .repartition(max(4 * cores, -(-total // BYTES_PER_TASK)))
        .mapInPandas(_read_files(root, repository), schemas.SOURCE)
    )


def sources_from_text(df: DataFrame, path, text, partitions: int | None = None) -> DataFrame:
    """Source rows from a table that already holds the texts.

    The rows are spread over tasks as the scan splits them, or over ``partitions``:
    parsing costs far more than moving the rows of a table with few splits. What moves are the
    columns that ``path`` and ``text`` need; the texts are built where they are parsed.
    """
    rows = df.repartition(partitions) if partitions else df
    return rows.select(
        path.alias("file_path"),
        text.cast("binary").alias("content"),
        F.lit(None).cast("string").alias("read_error"),
    )


def select_targets(
    files: DataFrame, single_file: str | None = None, limit: int | None = None
) -> DataFrame:
    """Files of a run: one named file, or all that are not excluded.

    A named file is taken even if excluded and must exist. ``limit`` keeps the
    first files in path order; None or 0 keeps all.
    """
    if single_file:
        chosen = files.filter(F.col("rel_path") == single_file)
        if chosen.isEmpty():
            raise ValueError(f"no such file in the listing: {single_file}")
        return chosen
    chosen = files.filter(~F.col("excluded"))
    return chosen.orderBy(paths.path_order(F.col("rel_path"))).limit(limit) if limit else chosen


def write_listing(files: DataFrame, path: str) -> None:
    files.write.mode("overwrite").parquet(path)


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LISTING).parquet(path)


#: The first key of a listed file. It cannot stand inside a JSON text, where its quotes are escaped.
_FIRST_KEY = '"rel_path"'
_BEGINS = r'"files"\s*:\s*\[\s*\{\s*$'
_ENDS = r'^\s*:\s*(?:[^"{}\]]|"(?:[^"\\]|\\.)*")*\}\s*\]'


def read_listing_document(spark: SparkSession, path: str) -> DataFrame:
    """Listing from one JSON document with its rows under ``files``.

    A document may be as large as the listing, so it is not parsed as a whole: it is cut at the
    first key of each listed file, which tasks do for their parts of it, and each piece parsed by
    itself. What stands before the array ``files`` and after its end is left out, such as a
    summary with files of its own.
    """
    pieces = spark.read.option("lineSep", _FIRST_KEY).text(path)
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    pieces = pieces.select("value", place.alias("place"))
    begin = pieces.filter(F.col("value").rlike(_BEGINS)).agg(F.min("place")).first()[0]
    if begin is None:
        return spark.createDataFrame([], schemas.LISTING)

    def after(found) -> Column:
        block, row = F.col("place.block"), F.col("place.row")
        return (block > found["block"]) | ((block == found["block"]) & (row > found["row"]))

    pieces = pieces.filter(after(begin))
    end = pieces.filter(F.col("value").rlike(_ENDS)).agg(F.min("place")).first()[0]
    if end is not None:
        pieces = pieces.filter(~after(end))
    whole = F.concat(F.lit("{" + _FIRST_KEY), F.col("value"))
    return pieces.select(F.from_json(whole, schemas.LISTING).alias("file")).select("file.*")
