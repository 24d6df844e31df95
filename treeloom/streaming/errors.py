"""Error events to a table of files that failed, closed by a later success of the same file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from treeloom import schemas
from treeloom.functions import envelope
from treeloom.operators import upsert
from treeloom.streaming.documents import with_trigger

KEYS = ["file_path"]


def write_errors(
    raw: DataFrame,
    table: str,
    checkpoint: str,
    continuous: bool = False,
    fold_every: int = upsert.FOLD_EVERY,
) -> StreamingQuery:
    """Keep the last error of each file; events that name no file go to ``<table>/rejects`` as they came."""
    feed = upsert.feed_name(checkpoint)

    def keep(batch: DataFrame, batch_id: int) -> None:
        decoded = envelope.decode(batch, "errors", ("value", "position"))
        named = F.col("file_path").isNotNull()
        upsert.write_changes(decoded.filter(~named).select("value", "position"), f"{table}/rejects", feed, batch_id)
        last = upsert.latest(decoded.filter(named).drop("value"), KEYS)
        upsert.write_changes(last, table, feed, batch_id)
        upsert.fold_at_times(batch.sparkSession, table, schemas.EVENT["errors"], KEYS, batch_id, fold_every)

    writer = raw.writeStream.outputMode("append").foreachBatch(keep).option("checkpointLocation", checkpoint)
    return with_trigger(writer, continuous).start()


def errors(spark: SparkSession, table: str, documents_table: str) -> DataFrame:
    """The last error of each file, with ``closed_time``, when the file was parsed after it; null while open.

    Both tables are read as they stand, whichever stream is ahead. A success at the very time of
    the error does not close it.
    """
    failed = upsert.read_latest(spark, table, schemas.EVENT["errors"], KEYS).drop("position")
    parsed = upsert.read_latest(spark, documents_table, schemas.DOCUMENT, ["_id"])
    parsed = parsed.select(F.col("_id").alias("file_path"), F.col("event_time").alias("parsed_time"))
    later = F.col("parsed_time") > F.col("event_time")
    found = failed.join(parsed, "file_path", "left")
    return found.withColumn("closed_time", F.when(later, F.col("parsed_time"))).drop("parsed_time")


def open_errors(spark: SparkSession, table: str, documents_table: str) -> DataFrame:
    return errors(spark, table, documents_table).filter(F.col("closed_time").isNull()).drop("closed_time")
