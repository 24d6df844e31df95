"""The event log: keyed JSON events by topic, on files or on a broker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from treeloom import schemas
from treeloom.functions import envelope
from treeloom.session import COMPRESSION


FILES_PER_BATCH = 1_000


def partition(key: Column, partitions: int) -> Column:
    """Partition of a key by the start of its SHA-256, which any reader can work out again."""
    head = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.pmod(head, F.lit(partitions)).cast("int")


def to_events(df: DataFrame, kind: str, event_time: Column) -> DataFrame:
    """Log rows of node, edge, metadata or error rows.

    ``position`` is (time, unit, order within the unit): the order in which the
    events of one key count, for readers that find no broker offset.
    """
    key = F.col(envelope.KEY_FIELD[kind])
    moment = event_time.cast("timestamp")
    order = F.col("ord") if "ord" in df.columns else F.array().cast("array<bigint>")
    unit = F.col("unit") if "unit" in df.columns else F.lit(0).cast("long")
    return df.select(
        F.when(key != "", key).alias("key"),
        envelope.envelope(kind, envelope.iso_time(moment)).alias("value"),
        partition(key, envelope.TOPIC_PARTITIONS[kind]).alias("partition"),
        moment.alias("timestamp"),
        F.concat(F.array(F.unix_micros(moment), unit), order).alias("position"),
        F.lit(envelope.TOPIC[kind]).alias("topic"),
    )


def create_topics(spark: SparkSession, path: str) -> None:
    """Empty folders for the topics a file log does not have yet."""
    schema, _ = _log_columns("nodes")
    for topic in envelope.TOPIC.values():
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/topic={topic}")


def append(events: DataFrame, path: str) -> None:
    """Add events to a file log, one folder per topic.

    The known topics are written one after another: a single write that deals rows to folders
    would sort all of them, texts included, by topic. Events that ``to_events`` made have a fixed
    topic, so each write reads only what it writes. Rows of any other topic follow in a write of their own.
    """
    topics = list(envelope.TOPIC.values())
    for topic in topics:
        rows = events.filter(F.col("topic") == topic).drop("topic")
        rows.write.mode("append").option("compression", COMPRESSION).parquet(f"{path}/topic={topic}")
    others = events.filter(~F.coalesce(F.col("topic").isin(topics), F.lit(False)))
    others.write.mode("append").partitionBy("topic").parquet(path)


def _log_columns(kind: str):
    # The topic is the folder name, and the last field of the schema.
    return schemas.LOG[:-1], F.lit(envelope.TOPIC[kind]).alias("topic")


def read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    schema, topic = _log_columns(kind)
    return spark.read.schema(schema).parquet(f"{path}/topic={envelope.TOPIC[kind]}").select("*", topic)


def read_all(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LOG).parquet(path)


def stream(
    spark: SparkSession, path: str, kind: str, max_files_per_trigger: int = FILES_PER_BATCH
) -> DataFrame:
    """Stream of one topic of a file log, from its start, so many files to a batch."""
    schema, topic = _log_columns(kind)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{path}/topic={envelope.TOPIC[kind]}").select("*", topic)


def ordered_by_offset(rows: DataFrame) -> DataFrame:
    """Broker rows with the ``position`` that orders the events of one key: time, partition, offset.

    A broker keeps the order of a key within its partition, so events of one time are told apart
    by the offset; the time comes first because a key moves when partitions are added.
    """
    position = F.array(F.unix_micros("timestamp"), F.col("partition").cast("long"), F.col("offset").cast("long"))
    return rows.withColumn("position", position)


def stream_broker(spark: SparkSession, servers: str, kind: str, **options: str) -> DataFrame:
    """Stream of one broker topic, from its start; needs Spark's Kafka package."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", envelope.TOPIC[kind])
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )
    return ordered_by_offset(raw)


def append_broker(events: DataFrame, servers: str, **options: str) -> None:
    """Send events to the broker; needs Spark's Kafka package.

    Rows of one key leave one task in log order. A key holds the few events of
    one entity, so hashing by key spreads evenly.
    """
    (
        events.repartition("topic", "key")
        .sortWithinPartitions("position")
        .select("topic", F.col("key").cast("binary"), F.col("value").cast("binary"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .options(**options)
        .save()
    )
