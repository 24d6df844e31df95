"""Stable identities and content measures, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Identity format.
ID_SEPARATOR = ":"
ID_LENGTH = 16
# What stands before an id that is packed as it is, so that it is longer than a packed one of this package.
PLAIN = bytes(ID_LENGTH // 2 + 1)
NO_POSITION = 0
MODULE = "Module"


def make_id(*parts: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the joined parts.

    ``concat`` gives null for a null part, where ``concat_ws`` would silently
    drop it and produce the id of something else.
    """
    joined: list[Column] = []
    for part in parts:
        if joined:
            joined.append(F.lit(ID_SEPARATOR))
        joined.append(part.cast("string"))
    return F.substring(F.sha2(F.concat(*joined), 256), 1, ID_LENGTH)


def pack(value: Column) -> Column:
    """An id as bytes, half as many as it has digits: shuffles compress without entropy coding.

    Any text may be an id. What is not ``ID_LENGTH`` lower-case hex digits keeps its bytes, behind ``PLAIN``.
    """
    short = F.unhex(value)
    return F.when(
        (F.octet_length(value) == ID_LENGTH) & (F.lower(F.hex(short)) == value), short
    ).otherwise(F.concat(F.lit(PLAIN), value.cast("binary")))


def unpack(packed: Column) -> Column:
    return F.when(F.octet_length(packed) == ID_LENGTH // 2, F.lower(F.hex(packed))).otherwise(
        F.substring(packed, len(PLAIN) + 1, 2**31 - 1).cast("string")
    )


def node_id(file_path: Column, lineno: Column, col_offset: Column, node_type: Column) -> Column:
    zero = F.lit(NO_POSITION)
    return make_id(
        file_path, F.coalesce(lineno, zero), F.coalesce(col_offset, zero), node_type
    )


def module_id(file_path: Column) -> Column:
    return node_id(file_path, F.lit(NO_POSITION), F.lit(NO_POSITION), F.lit(MODULE))


def edge_id(source_id: Column, target_id: Column, edge_type: Column) -> Column:
    return make_id(source_id, target_id, edge_type)


def file_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def size_bytes(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def line_count(text: Column) -> Column:
    """Newlines plus one, so an empty text has one line."""
    newlines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return (newlines + 1).cast("long")


def unix_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")
