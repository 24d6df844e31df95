"""Schemas of the tables, events and documents."""

from __future__ import annotations

import re

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "BINARY": T.BinaryType(),
    "BOOLEAN": T.BooleanType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
    "ARRAY<INT>": T.ArrayType(T.IntegerType()),
    "ARRAY<BIGINT>": T.ArrayType(T.LongType()),
    # Last assignments of a name: the scope each counts in, and its place.
    "DEFINITIONS": T.ArrayType(
        T.StructType([T.StructField(n, T.IntegerType()) for n in ("scope", "lineno", "col_offset")])
    ),
    "MAP<STRING,STRING>": T.MapType(T.StringType(), T.StringType()),
}


def _struct(columns: str) -> T.StructType:
    """Schema of ``name TYPE`` pairs; Spark's own DDL reader needs a session."""
    pairs = [column.split() for column in re.split(r",\s+", columns)]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# One row per file that was found.
LISTING = _struct("rel_path STRING, size_bytes BIGINT, excluded BOOLEAN")

# One row per file that was read; exactly one of content and read_error is set.
SOURCE = _struct("file_path STRING, content BINARY, read_error STRING")

# One row per syntax node with a position, one Module row per parsed file that
# carries the file measures, one row with an error per file that failed.
FLAT = _struct(
    """unit BIGINT, file_path STRING, pre INT, depth INT, node_type STRING, name STRING,
    lineno INT, col_offset INT, end_lineno INT,
    parent_line INT, parent_col INT, parent_type STRING,
    encl_line INT, encl_col INT, encl_type STRING,
    callee STRING, found_line INT, found_col INT, found_type STRING, defs DEFINITIONS,
    block_pre INT, block_idx INT,
    next_line INT, next_col INT, next_type STRING,
    file_hash STRING, size_bytes BIGINT, loc BIGINT,
    error_type STRING, error_message STRING"""
)

NODE = _struct(
    """node_id STRING, file_path STRING, node_type STRING, name STRING, lineno INT,
    col_offset INT, end_lineno INT, parent_id STRING"""
)
EDGE = _struct(
    """edge_id STRING, source_id STRING, target_id STRING, edge_type STRING,
    file_path STRING, attrs MAP<STRING,STRING>"""
)
METADATA = _struct(
    """file_path STRING, file_hash STRING, size_bytes BIGINT, loc BIGINT,
    num_functions BIGINT, num_classes BIGINT, num_nodes BIGINT, num_edges BIGINT"""
)
ERROR = _struct("file_path STRING, error_type STRING, error_message STRING")

_HEADER = _struct("schema_version STRING, event_time STRING, event_type STRING")


def _event(payload: T.StructType) -> T.StructType:
    # ``_key`` is on the wire but not in the readers' schemas.
    return T.StructType(_HEADER.fields + payload.fields)


EVENT = {
    "nodes": _event(NODE),
    "edges": _event(EDGE),
    "metadata": _event(METADATA),
    "errors": _event(ERROR),
}
PAYLOAD = {"nodes": NODE, "edges": EDGE, "metadata": METADATA, "errors": ERROR}

# Event log rows. ``position`` orders the events of one key; a broker's offset
# takes its place when the log is a broker topic.
LOG = _struct(
    """key STRING, value STRING, partition INT, timestamp TIMESTAMP,
    position ARRAY<BIGINT>, topic STRING"""
)

# Latest-wins tables the streams write.
DOCUMENT = T.StructType(
    [
        T.StructField("_id" if f.name == "file_path" else f.name, f.dataType)
        for f in EVENT["metadata"].fields
    ]
)
POSITION = T.StructField("position", T.ArrayType(T.LongType()))
VERTEX = _struct(
    """id STRING, file_path STRING, node_type STRING, name STRING, lineno INT, col_offset INT,
    end_lineno INT, parent_id STRING, schema_version STRING, event_time STRING"""
)
RELATIONSHIP = _struct(
    "src STRING, dst STRING, type STRING, edge_id STRING, file_path STRING, event_time STRING"
)
PARENT = _struct("parent_id STRING, node_id STRING")
MENTION = _struct("id STRING")

MANIFEST = _struct(
    """rel_path STRING, file_hash STRING, num_nodes BIGINT, num_edges BIGINT,
    last_processed DOUBLE"""
)
