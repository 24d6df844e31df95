"""Metadata events to one document per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from treeloom import schemas
from treeloom.functions import envelope
from treeloom.operators import upsert
from treeloom.session import staged

# Fixed value: pause between batches of a long-lived stream.
CONTINUOUS_INTERVAL = "10 seconds"

KEYS = ["_id"]


def with_trigger(writer, continuous: bool):
    """Drain what is there and stop, or keep running in short batches."""
    if continuous:
        return writer.trigger(processingTime=CONTINUOUS_INTERVAL)
    return writer.trigger(availableNow=True)


def stop_when_idle(query: StreamingQuery) -> StreamingQuery:
    """Let a long-lived stream take all input that is there by now, then end it between two batches."""
    query.processAllAvailable()
    query.stop()
    return query


def as_documents(raw: DataFrame) -> DataFrame:
    """Decoded metadata events, keyed by file path."""
    return envelope.decode(raw, "metadata").withColumnRenamed("file_path", "_id")


def write_documents(
    raw: DataFrame,
    table: str,
    checkpoint: str,
    continuous: bool = False,
    rejects: str | None = None,
    fold_every: int = upsert.FOLD_EVERY,
) -> StreamingQuery:
    """Upsert a metadata stream into a table of documents.

    Events that are not JSON have no key. They go to ``rejects`` as they came if
    that is set; otherwise they count as one document without a key. The table is folded
    after each ``fold_every`` batches.
    """
    feed = upsert.feed_name(checkpoint)

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        documents = as_documents(batch)
        if rejects:
            decoded = envelope.decode(batch, "metadata", ("value", "position"))
            with staged(decoded.withColumnRenamed("file_path", "_id"), "batch-metadata") as decoded:
                bad = decoded.filter(F.col("_id").isNull()).select("value", "position")
                upsert.write_changes(bad, rejects, feed, batch_id)
                documents = decoded.filter(F.col("_id").isNotNull()).drop("value")
                upsert.write_changes(upsert.latest(documents, KEYS), table, feed, batch_id)
        else:
            upsert.write_changes(upsert.latest(documents, KEYS), table, feed, batch_id)
        upsert.fold_at_times(batch.sparkSession, table, schemas.DOCUMENT, KEYS, batch_id, fold_every)

    writer = (
        raw.writeStream.outputMode("append")
        .foreachBatch(upsert_batch)
        .option("checkpointLocation", checkpoint)
    )
    return with_trigger(writer, continuous).start()


def write_documents_to_store(
    raw: DataFrame, checkpoint: str, options: dict[str, str], continuous: bool = False
) -> StreamingQuery:
    """The same stream into a document store that upserts by ``_id`` itself.

    Needs the store's Spark package; ``options`` name server and collection.
    """
    writer = (
        as_documents(raw)
        .drop("position")
        .writeStream.format("mongodb")
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return with_trigger(writer, continuous).start()


def documents(spark: SparkSession, table: str) -> DataFrame:
    """The current document of each file."""
    return upsert.read_latest(spark, table, schemas.DOCUMENT, KEYS).drop("position")


def document(spark: SparkSession, table: str, key: str) -> DataFrame:
    """One document, from its folder of the snapshot and the batches after it."""
    changes = upsert.read_changes(spark, table, schemas.DOCUMENT, {"_id": key})
    return upsert.latest(changes, KEYS).drop("position")
