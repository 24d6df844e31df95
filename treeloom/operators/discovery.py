"""Summaries of a file listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from treeloom.functions import paths
from treeloom.operators.reports import write_report

LARGEST = 5
SHOWN_PER_FLAG = 5


def totals(files: DataFrame) -> DataFrame:
    excluded = F.col("excluded")
    return files.agg(
        F.count(F.lit(1)).alias("total_py_files"),
        F.count_if(~excluded).alias("included_files"),
        F.count_if(excluded).alias("excluded_files"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("long").alias("total_size_bytes"),
    )


def top_dirs(files: DataFrame) -> DataFrame:
    """Files per first path component, most first, ties in path order."""
    return (
        files.groupBy(paths.top_dir(F.col("rel_path")).alias("top_dir"))
        .agg(F.count(F.lit(1)).alias("files"), F.min(paths.path_order(F.col("rel_path"))).alias("first_path"))
        .orderBy(F.desc("files"), "first_path")
        .select("top_dir", "files")
    )


def largest(files: DataFrame, n: int = LARGEST) -> DataFrame:
    return files.orderBy(F.desc("size_bytes"), paths.path_order(F.col("rel_path"))).limit(n)


def first_per_flag(files: DataFrame, n: int = SHOWN_PER_FLAG) -> DataFrame:
    """First files in path order among the included and among the excluded.

    A filter on the rank lets Spark cut each partition to ``n`` rows per flag
    before the shuffle.
    """
    rank = Window.partitionBy("excluded").orderBy(paths.path_order(F.col("rel_path")))
    return (
        files.withColumn("position", F.row_number().over(rank))
        .filter(F.col("position") <= n)
        .withColumn(
            "reason",
            F.when(F.col("excluded"), paths.exclusion_reason(F.col("rel_path"))),
        )
    )


def write_summary(files: DataFrame, path: str) -> None:
    """Totals, folders and largest files as JSON, in a folder each.

    There may be as many first components as files, so the folders stay rows
    and are not gathered into one value.
    """
    write_report(
        {"totals": totals(files), "top_dirs": top_dirs(files), "largest": largest(files)}, path
    )
