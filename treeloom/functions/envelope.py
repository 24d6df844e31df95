"""The event envelope: payload columns to JSON and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from treeloom import schemas

# Version, event types and topics of the wire format.
SCHEMA_VERSION = "1.0"
EVENT_TYPE = {"nodes": "node", "edges": "edge", "metadata": "metadata", "errors": "error"}
KEY_FIELD = {"nodes": "node_id", "edges": "edge_id", "metadata": "file_path", "errors": "file_path"}
TOPIC = {
    "nodes": "cpg.nodes",
    "edges": "cpg.edges",
    "metadata": "cpg.metadata",
    "errors": "cpg.errors",
}
TOPIC_PARTITIONS = {"nodes": 3, "edges": 3, "metadata": 1, "errors": 1}


def iso_time(moment: Column) -> Column:
    """UTC text with microseconds and offset, from the instant alone: no local time is involved,
    so zones with gaps and repeated hours change nothing."""
    micros = F.unix_micros(moment)
    of_day = F.pmod(micros, F.lit(86_400_000_000))
    day = F.date_from_unix_date(((micros - of_day) / 86_400_000_000).cast("int"))
    second = F.floor(of_day / 1_000_000)
    clock = F.format_string(
        "T%02d:%02d:%02d.%06d+00:00",
        F.floor(second / 3600), F.floor(second / 60) % 60, second % 60, of_day % 1_000_000,
    )
    return F.concat(day.cast("string"), clock)


def envelope(kind: str, event_time: Column) -> Column:
    """Header, then payload, then ``_key``; nulls stay in the text."""
    key = F.col(KEY_FIELD[kind])
    return F.to_json(
        F.struct(
            F.lit(SCHEMA_VERSION).alias("schema_version"),
            event_time.alias("event_time"),
            F.lit(EVENT_TYPE[kind]).alias("event_type"),
            *[F.col(name) for name in schemas.PAYLOAD[kind].names],
            key.alias("_key"),
        ),
        {"ignoreNullFields": "false"},
    )


def decode(raw: DataFrame, kind: str, keep: tuple[str, ...] = ("position",)) -> DataFrame:
    """Fields of the JSON in ``value``; text that is not JSON gives nulls.

    A generator reads each text once: as a mere projection it would move into every filter on the
    fields and be evaluated again there.
    """
    carried = [name for name in keep if name in raw.columns]
    data = F.from_json(F.col("value").cast("string"), schemas.EVENT[kind])
    return raw.select(F.inline(F.array(data)), *carried)
