"""Parsing of written-out files, with positions in place of ids."""

from __future__ import annotations

import hashlib

from treeloom import schemas
from treeloom.plans import batch


def ident(*parts) -> str:
    return hashlib.sha256(":".join(str(p) for p in parts).encode()).hexdigest()[:16]


def source_rows(spark, texts: dict[str, str | bytes]):
    rows = [
        (path, text.encode() if isinstance(text, str) else text, None)
        for path, text in texts.items()
    ]
    return spark.createDataFrame(rows, schemas.SOURCE)


def parse(spark, texts) -> batch.Parsed:
    return batch.parse(source_rows(spark, texts))


class Program:
    """One parsed text, its edges as pairs of ``Kind@line:column``."""

    def __init__(self, spark, text, path="repo/m.py"):
        self.parsed = parse(spark, {path: text})
        self.nodes = [r.asDict() for r in self.parsed.nodes.orderBy("ord").collect()]
        self.place = {ident(path, 0, 0, "Module"): "Module"}
        for n in self.nodes:
            self.place[n["node_id"]] = f"{n['node_type']}@{n['lineno']}:{n['col_offset']}"
        self._edges = [r.asDict() for r in self.parsed.edges.orderBy("ord").collect()]

    def edges(self, kind, attr=None):
        """Edges of a kind in the order of their events."""
        return [
            (self.place[e["source_id"]], self.place[e["target_id"]])
            + ((e["attrs"][attr],) if attr else ())
            for e in self._edges
            if e["edge_type"] == kind
        ]
