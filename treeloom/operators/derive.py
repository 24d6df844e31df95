"""Nodes, edges and file metadata from the syntax table.

Each row notes the places of the nodes that its edges lead to or come from, so
all edges are made in one pass over the table, without a shuffle. Counts group by
``unit``, one source text each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from treeloom.functions import ids
from treeloom.operators.flatten import FUNCTION_KINDS, MODULE

# Edge types, and the kinds with an edge into each of their blocks.
CFG, DFG, CALL, RESOLVES = "CFG", "DFG", "CALL", "CALL_RESOLVES_TO"
ENTRY_KINDS = (
    "If",
    "For",
    "While",
    "Try",
    "FunctionDef",
    "AsyncFunctionDef",
    "ClassDef",
    "Module",
)

# What makes up an id, next to the file path.
_PLACE = ("lineno", "col_offset", "node_type")

# Columns of the syntax table that the steps read.
_ALWAYS = ("unit", "file_path", *_PLACE)
_PARENT = ("parent_line", "parent_col", "parent_type")
NODE_COLUMNS = (*_ALWAYS, *_PARENT, "pre", "name", "end_lineno")
CFG_COLUMNS = (*_ALWAYS, *_PARENT, "block_pre", "block_idx", "next_line", "next_col", "next_type")
DFG_COLUMNS = (*_ALWAYS, "pre", "depth", "name", "defs")
CALL_COLUMNS = (
    *_ALWAYS, "pre", "callee", "encl_line", "encl_col", "encl_type", "found_line", "found_col", "found_type",
)
EDGE_COLUMNS = tuple(dict.fromkeys((*CFG_COLUMNS, *DFG_COLUMNS, *CALL_COLUMNS)))
METADATA_COLUMNS = (*EDGE_COLUMNS, "file_hash", "size_bytes", "loc")
# Facts without which a row has no edge of a family.
CFG_FACTS, DFG_FACTS, CALL_FACTS = ("block_idx",), ("defs",), ("callee",)
EDGE_FACTS = (*CFG_FACTS, *DFG_FACTS, *CALL_FACTS)


def _node_id() -> Column:
    return ids.node_id(
        F.col("file_path"), F.col("lineno"), F.col("col_offset"), F.col("node_type")
    )


def _parent_id() -> Column:
    """Null for a node right below the module, which has no position."""
    kind = F.col("parent_type")
    return F.when(
        kind.isNotNull(),
        ids.node_id(F.col("file_path"), F.col("parent_line"), F.col("parent_col"), kind),
    )


def _ord(*keys: Column | int) -> Column:
    """Sort key that gives the order of events within a unit."""
    return F.array(*[(k if isinstance(k, Column) else F.lit(k)).cast("long") for k in keys])


def _place(prefix: str) -> tuple[Column, Column, Column]:
    return tuple(F.col(f"{prefix}_{c}") for c in ("line", "col", "type"))


def _link(
    where: Column, edge_type: str, source: tuple, target: tuple, order: tuple, attr: Column | None = None
) -> tuple[Column, Column]:
    """What an edge of a row consists of but for its ids, and which rows have such an edge."""
    ends = [c.alias(f"{end}{i}") for end, place in (("s", source), ("t", target)) for i, c in enumerate(place)]
    keys = [(k if isinstance(k, Column) else F.lit(k)).cast("int").alias(f"o{i}") for i, k in enumerate(order)]
    value = F.lit(None).cast("string") if attr is None else attr
    return where, F.struct(F.lit(edge_type).alias("edge_type"), *ends, *keys, value.alias("attr"))


def _edges(syntax: DataFrame, *links: tuple[Column, Column]) -> DataFrame:
    """All edges of each row in one pass; ids are computed last, so that readers which only count need none."""
    rows = syntax.filter(reduce(Column.__or__, [where for where, _ in links]))
    if len(links) > 1:
        found = F.explode(F.array(*[F.when(where, link) for where, link in links]))
    else:
        found = links[0][1]
    linked = rows.select("unit", "file_path", found.alias("link")).filter(F.col("link").isNotNull())
    linked = linked.select("unit", "file_path", "link.*")
    path, kind, attr = F.col("file_path"), F.col("edge_type"), F.col("attr")
    source, target = [ids.node_id(path, *[F.col(f"{end}{i}") for i in range(3)]) for end in "st"]
    attrs = (
        F.when(kind == CFG, F.expr("map()").cast("map<string,string>"))
        .when(kind == DFG, F.create_map(F.lit("var"), attr))
        .otherwise(F.create_map(F.lit("callee_name"), attr))
    )
    return linked.select(
        ids.edge_id(source, target, kind).alias("edge_id"),
        source.alias("source_id"),
        target.alias("target_id"),
        "edge_type",
        "file_path",
        attrs.alias("attrs"),
        "unit",
        _ord(*[F.col(f"o{i}") for i in range(4)]).alias("ord"),
    )


def ast_nodes(syntax: DataFrame) -> DataFrame:
    """One row per node event. Ids repeat where two nodes of a kind share a start."""
    return syntax.filter(F.col("lineno").isNotNull()).select(
        _node_id().alias("node_id"),
        "file_path",
        "node_type",
        "name",
        "lineno",
        "col_offset",
        "end_lineno",
        _parent_id().alias("parent_id"),
        "unit",
        _ord(F.col("pre")).alias("ord"),
    )


def _here() -> tuple[Column, ...]:
    return tuple(F.col(c) for c in _PLACE)


def _cfg_links() -> list[tuple[Column, Column]]:
    line, col, kind = _place("parent")
    parent = (
        F.coalesce(line, F.lit(ids.NO_POSITION)), F.coalesce(col, F.lit(ids.NO_POSITION)), F.coalesce(kind, F.lit(MODULE)),
    )
    begins = (F.col("block_idx") == 0) & parent[2].isin(*ENTRY_KINDS)
    block, idx = F.col("block_pre"), F.col("block_idx")
    return [
        _link(F.col("next_type").isNotNull(), CFG, _here(), _place("next"), (0, block, 0, idx)),
        _link(F.coalesce(begins, F.lit(False)), CFG, parent, _here(), (0, block, 1, 0)),
    ]


def _dfg_link() -> tuple[Column, Column]:
    """For rows with one definition each."""
    found = F.col("def")
    source = (found["lineno"], found["col_offset"], F.lit("Name"))
    order = (1, found["scope"], F.col("depth"), F.col("pre"))
    return _link(found.isNotNull(), DFG, source, _here(), order, F.col("name"))


def _call_link() -> tuple[Column, Column]:
    is_call = F.col("encl_type").isNotNull()
    return _link(is_call, CALL, _place("encl"), _here(), (2, F.col("pre"), 0, 0), F.col("callee"))


def _resolve_link() -> tuple[Column, Column]:
    order = (2, F.col("pre"), 1, 0)
    return _link(F.col("found_type").isNotNull(), RESOLVES, _here(), _place("found"), order, F.col("callee"))


def cfg_edges(syntax: DataFrame) -> DataFrame:
    """Statement to next statement, and owner to the first statement of a block.

    Each statement carries the place of the next one, so nothing is shuffled.
    """
    return _edges(syntax, *_cfg_links())


def dfg_edges(syntax: DataFrame) -> DataFrame:
    """Last assignment of a name to each read of it, per scope, breadth first.

    A name counts in every scope around it, so nested scopes repeat edges. Each read carries
    the places of its assignments.
    """
    reads = syntax.filter(F.col("defs").isNotNull())
    return _edges(reads.withColumn("def", F.explode("defs")), _dfg_link())


def call_edges(syntax: DataFrame) -> DataFrame:
    """Enclosing function or module to each call."""
    return _edges(syntax, _call_link())


def resolve_edges(syntax: DataFrame) -> DataFrame:
    """Call to the first function, breadth first, with the called name in its file."""
    return _edges(syntax, _resolve_link())


def all_edges(syntax: DataFrame) -> DataFrame:
    """All edge events; repeated edges stay repeated.

    A row is repeated for each of its definitions. Only reads of names have some, and these are
    neither statements nor calls, so no other edge is repeated.
    """
    rows = syntax.filter(reduce(Column.__or__, [F.col(c).isNotNull() for c in ("block_idx", "defs", "encl_type")]))
    rows = rows.withColumn("def", F.explode_outer("defs"))
    return _edges(rows, *_cfg_links(), _dfg_link(), _call_link(), _resolve_link())


def file_metadata(syntax: DataFrame, edges: DataFrame) -> DataFrame:
    """Measures and counts per parsed file.

    Nodes and edges are counted in one aggregation over their union. It sums
    numbers only, so it stays a hash aggregation whose partial results are about
    one row per file and task; the measures join from the one Module row per file.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    kind = F.col("node_type")
    nodes = syntax.filter(F.col("lineno").isNotNull()).select(
        "unit",
        kind.isin(*FUNCTION_KINDS).cast("long").alias("functions"),
        (kind == "ClassDef").cast("long").alias("classes"),
        one.alias("nodes"),
        none.alias("edges"),
    )
    linked = edges.select(
        "unit", none.alias("functions"), none.alias("classes"), none.alias("nodes"), one.alias("edges")
    )
    counts = (
        nodes.unionByName(linked)
        .groupBy("unit")
        .agg(*[F.sum(c).alias(f"num_{c}") for c in ("functions", "classes", "nodes", "edges")])
    )
    files = syntax.filter(kind == MODULE).select(
        "unit", "file_path", "file_hash", "size_bytes", "loc"
    )
    return files.join(counts, "unit", "left").select(
        "file_path",
        "file_hash",
        "size_bytes",
        "loc",
        *[
            F.coalesce(c, none).alias(c)
            for c in ("num_functions", "num_classes", "num_nodes", "num_edges")
        ],
        "unit",
    )


def parse_errors(syntax: DataFrame) -> DataFrame:
    return syntax.filter(F.col("error_type").isNotNull()).select(
        "file_path", "error_type", "error_message", "unit"
    )


def run_summary(metadata: DataFrame, errors: DataFrame) -> DataFrame:
    """Parsed files, failed files, node events and edge events of a run."""
    one = metadata.select(
        F.lit(1).alias("ok"), F.lit(0).alias("failed"), "num_nodes", "num_edges"
    ).unionByName(
        errors.select(F.lit(0).alias("ok"), F.lit(1).alias("failed")), allowMissingColumns=True
    )
    return one.agg(
        F.coalesce(F.sum("ok"), F.lit(0)).cast("long").alias("files_ok"),
        F.coalesce(F.sum("failed"), F.lit(0)).cast("long").alias("files_failed"),
        F.coalesce(F.sum("num_nodes"), F.lit(0)).cast("long").alias("total_nodes"),
        F.coalesce(F.sum("num_edges"), F.lit(0)).cast("long").alias("total_edges"),
    )
