"""Reports on runs, topics and consumers."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from treeloom.functions import envelope, ids, measures, paths


def key_counts(log: DataFrame) -> DataFrame:
    """Events of each key, the partitions they are in and the keys that their texts name.

    Only the keys in texts are counted as distinct rows, since a second such column would repeat every
    row; a topic's partitions are few, so they are a set. A text that names the key of its event, as it
    should, moves as an empty value.
    """
    named = F.get_json_object("value", "$._key")
    in_text = F.when(named == F.col("key"), F.lit(b"")).otherwise(
        F.concat(F.lit(bytes(1)), named.cast("binary"))
    )
    rows = log.select("topic", ids.pack(F.col("key")).alias("key"), "partition", in_text.alias("in_text"))
    counts = rows.groupBy("topic", "key").agg(
        F.count(F.lit(1)).alias("events"),
        F.size(F.collect_set("partition")).cast("long").alias("partitions"),
        F.count_distinct("in_text").alias("keys_in_text"),
    )
    return counts.withColumn("key", ids.unpack(F.col("key")))


def topic_counts(log: DataFrame) -> DataFrame:
    """Messages per topic, topics without any included, and the grand total.

    The four topic names join as a constant table after the count.
    """
    spark = log.sparkSession
    names = spark.createDataFrame(
        [(envelope.TOPIC[k], envelope.TOPIC_PARTITIONS[k]) for k in envelope.TOPIC],
        "topic STRING, partitions INT",
    )
    counted = log.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))
    per_topic = names.join(counted, "topic", "left").select(
        "topic", "partitions", F.coalesce("messages", F.lit(0)).cast("long").alias("messages")
    )
    total = per_topic.agg(
        F.lit("TOTAL").alias("topic"),
        F.sum("partitions").cast("int").alias("partitions"),
        F.sum("messages").alias("messages"),
    )
    return per_topic.unionByName(total)


def log_ends(log: DataFrame) -> DataFrame:
    """Events per partition of one topic, which is the next offset of each."""
    return log.groupBy("partition").agg(F.count(F.lit(1)).alias("log_end"))


def consumer_lag(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """Lag per partition and, in the row without a partition, in total."""
    joined = ends.join(committed, "partition", "left").select(
        "partition",
        F.coalesce("current_offset", F.lit(0)).cast("long").alias("current_offset"),
        F.col("log_end").cast("long"),
    )
    current, end = F.col("current_offset"), F.col("log_end")
    return (
        joined.rollup("partition")
        .agg(F.sum("current_offset").alias("current_offset"), F.sum("log_end").alias("log_end"))
        .select(
            "partition",
            "current_offset",
            "log_end",
            (end - current).alias("lag"),
            measures.percent(current, end).alias("progress"),
        )
    )


def broker_offsets(spark: SparkSession, progress: list, topic: str) -> DataFrame:
    """Committed and last offset per partition of a broker topic.

    Read from the JSON a streaming query reports about its last batch, which has
    one short entry per partition.
    """
    rows = [(s.endOffset, s.latestOffset) for p in progress[-1:] for s in p.sources]
    offsets = "map<string, map<string, bigint>>"
    reported = spark.createDataFrame(rows, "committed STRING, latest STRING").select(
        *[F.from_json(c, offsets)[topic].alias(c) for c in ("committed", "latest")]
    )
    return reported.select(F.explode("latest").alias("partition", "log_end"), "committed").select(
        F.col("partition").cast("int").alias("partition"),
        F.col("committed")[F.col("partition")].alias("current_offset"),
        "log_end",
    )


class ProgressLog(StreamingQueryListener):
    """All batches of the streaming queries that run within ``with ProgressLog(spark) as log``.

    A query itself keeps its last reports only, however many batches it had. Leaving waits for
    the queries that began within and have ended to be reported in full.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.progress = spark, []
        self._open: set[str] = set()
        self._changed = threading.Condition()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        running = {str(q.runId) for q in self.spark.streams.active}
        with self._changed:
            self._changed.wait_for(lambda: self._open <= running, timeout=60)
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._open.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        self.progress.append(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._open.discard(str(event.runId))
            self._changed.notify_all()


def stream_progress(spark: SparkSession, progress: list) -> DataFrame:
    """Batches of a streaming query as rows, from the reports of a ``ProgressLog``."""
    rows = [
        (
            p.batchId,
            s.startOffset,
            s.endOffset,
            s.numInputRows,
            p.sink.numOutputRows,
        )
        for p in progress
        for s in p.sources
    ]
    return spark.createDataFrame(
        rows,
        "batch_id BIGINT, start_offset STRING, end_offset STRING, input_rows BIGINT, output_rows BIGINT",
    )


def batch_table(metadata: DataFrame) -> DataFrame:
    """One display row per file with its size and complexity."""
    return metadata.select(
        "file_path",
        paths.shorten(F.col("file_path"), 64, 61).alias("short_path"),
        "loc",
        "num_functions",
        "num_classes",
        "num_nodes",
        "num_edges",
        measures.complexity(F.col("num_nodes"), F.col("num_edges")).alias("complexity"),
    )


def edge_counts(edges: DataFrame) -> DataFrame:
    """Edges per file and family; resolutions count as calls."""
    family = F.col("edge_type")
    return edges.groupBy("file_path").agg(
        F.count_if(family == "CFG").alias("num_cfg_edges"),
        F.count_if(family == "DFG").alias("num_dfg_edges"),
        F.count_if(family.isin("CALL", "CALL_RESOLVES_TO")).alias("num_call_edges"),
        F.count(F.lit(1)).alias("num_total_edges"),
    )


def run_rates(summary: DataFrame, elapsed_seconds: Column) -> DataFrame:
    """Averages of a run summary; null where nothing was parsed."""
    done = F.col("files_ok")
    return summary.select(
        "*",
        measures.ratio(done, elapsed_seconds, 1).alias("files_per_second"),
        measures.ratio(F.col("total_nodes"), done, 1).alias("nodes_per_file"),
        measures.ratio(F.col("total_edges"), done, 1).alias("edges_per_file"),
        measures.percent(done, done + F.col("files_failed")).alias("parsed_percent"),
    )


def samples(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Per file: its first function, else its first node, and its first edge of a family."""
    order = F.col("ord")
    node = F.struct("node_id", "node_type", "name", "lineno", "col_offset", "end_lineno", "parent_id")
    picked = nodes.groupBy("file_path").agg(
        F.min_by(node, F.struct(F.col("node_type") != "FunctionDef", "unit", order)).alias("node")
    )
    edge = F.struct("edge_id", "source_id", "target_id", "attrs")
    rank = F.struct("unit", order)

    def first(edge_type: str) -> Column:
        return F.min_by(edge, F.when(F.col("edge_type") == edge_type, rank))

    linked = edges.groupBy("file_path").agg(
        first("CFG").alias("cfg_edge"),
        first("DFG").alias("dfg_edge"),
        first("CALL").alias("call_edge"),
    )
    return picked.join(linked, "file_path", "left")


def write_report(parts: dict[str, DataFrame], path: str) -> None:
    """Named results as JSON, a folder each."""
    for name, part in parts.items():
        part.write.mode("overwrite").json(f"{path}/{name}")
