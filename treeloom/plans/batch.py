"""A run: parse the chosen files, log their events, keep the manifest."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from treeloom import schemas
from treeloom.functions import paths
from treeloom.operators import changes, derive, upsert
from treeloom.operators.flatten import flatten
from treeloom.session import ROWS_PER_FILE, stage
from treeloom.sources import eventlog, files


@dataclass(frozen=True)
class Parsed:
    """Results of one parse, all readable several times without parsing again."""

    nodes: DataFrame
    edges: DataFrame
    metadata: DataFrame
    errors: DataFrame

    def events(self, event_time: Column) -> DataFrame:
        parts = {
            "nodes": self.nodes,
            "edges": self.edges,
            "metadata": self.metadata,
            "errors": self.errors,
        }
        return reduce(
            DataFrame.unionByName,
            [eventlog.to_events(df, kind, event_time) for kind, df in parts.items()],
        )


def parse(sources: DataFrame) -> Parsed:
    """Nodes, edges, metadata and errors of source rows.

    The syntax table is written once because five branches read it, and so are the metadata,
    which go to the log, the manifest and the summary. Edges take one pass over the syntax
    table; the log alone needs their ids, so each reader derives them.
    """
    syntax = stage(flatten(sources), "syntax", ROWS_PER_FILE)
    edges = derive.all_edges(syntax)
    return Parsed(
        nodes=derive.ast_nodes(syntax),
        edges=edges,
        metadata=stage(derive.file_metadata(syntax, edges), "metadata"),
        errors=derive.parse_errors(syntax),
    )


def manifest_rows(metadata: DataFrame, repository: str, processed_at: Column) -> DataFrame:
    """Manifest rows of the files that parsed."""
    return metadata.select(
        paths.relative_path(repository, F.col("file_path")).alias("rel_path"),
        "file_hash",
        "num_nodes",
        "num_edges",
        (F.unix_micros(processed_at) / 1_000_000).alias("last_processed"),
    )


def update_manifest(known: DataFrame, processed: DataFrame) -> DataFrame:
    """Known rows, replaced where a file was processed again."""
    return upsert.latest(known.unionByName(processed), ["rel_path"], "last_processed")


def save_manifest(
    processed: DataFrame, path: str, run_id: int, fold_every: int = upsert.FOLD_EVERY
) -> None:
    """Add the rows of a run; saving the same run again changes nothing.

    Each run is a feed of its own, since runs may end in another order than they began. The
    manifest is folded once ``fold_every`` runs wait.
    """
    position = F.array((F.col("last_processed") * 1_000_000).cast("long"))
    upsert.write_changes(processed.withColumn("position", position), path, f"{upsert.RUN}{run_id}", 0)
    upsert.fold_when_many(processed.sparkSession, path, schemas.MANIFEST, ["rel_path"], fold_every)


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    return upsert.read_latest(spark, path, schemas.MANIFEST, ["rel_path"]).drop("position")


def run(
    spark: SparkSession,
    listing: DataFrame,
    root: str,
    repository: str,
    log_path: str,
    manifest_path: str | None = None,
    single_file: str | None = None,
    limit: int | None = None,
    event_time: Column | None = None,
    changed_only: bool = False,
) -> DataFrame:
    """Parse the targets of a listing and log all events; returns the run summary.

    A single file is parsed again whether or not it changed. With ``changed_only`` files are
    read and hashed first, and those that the manifest holds with the same hash are not parsed;
    changed ones are read twice, and no content moves between tasks. The manifest is saved last,
    after all events are logged.
    """
    moment = event_time
    if moment is None:
        # One instant for the whole run, so that all its jobs agree on it.
        now = spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]
        moment = F.timestamp_micros(F.lit(now))
    targets = files.select_targets(listing, single_file, limit)
    if changed_only and not single_file:
        if not manifest_path:
            raise ValueError("changed_only needs a manifest")
        hashes = changes.file_hashes(files.read_sources(targets, root, repository), repository)
        todo = stage(changes.changed(hashes, load_manifest(spark, manifest_path)), "changed")
        targets = targets.join(todo.select("rel_path"), "rel_path", "left_semi")
    parsed = parse(files.read_sources(targets, root, repository))
    eventlog.create_topics(spark, log_path)
    eventlog.append(parsed.events(moment), log_path)
    if manifest_path:
        micros = spark.range(1).select(F.unix_micros(moment)).first()[0]
        save_manifest(manifest_rows(parsed.metadata, repository, moment), manifest_path, micros)
    return derive.run_summary(parsed.metadata, parsed.errors)
