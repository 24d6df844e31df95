"""A corpus from raw documents to a training order, stage by stage.

Every stage works on all rows that the one before it kept, and all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from treeloom.llm import contamination, language, mixing, simhash, substrings  # noqa: E402
from treeloom.llm.tables import read  # noqa: E402
from treeloom.session import ship_package, stage  # noqa: E402


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled rows teach; the rest go."""
    ship_package(spark)
    return language.keep_known(docs, language.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: fingerprints of three-word shingles, two bits apart at most."""
    ship_package(spark)
    return simhash.keep_one(docs, shingle=3, radius=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words or more that a smaller id has; what has no word left goes."""
    ship_package(spark)
    return substrings.without_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    ship_package(spark)
    return contamination.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mixture, with their places in it."""
    ship_package(spark)
    return mixing.in_order(mixing.mix(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", known_language),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing", mix_sources),
]

#: Fitted filters and fingerprints have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
