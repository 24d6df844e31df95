"""Property graph from node and edge events.

Vertices and relationships only ever grow or get overwritten; nothing is
deleted when a file changes, so old positions stay in the graph, and
``current_only`` reads it without them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from treeloom import schemas
from treeloom.functions import ids
from treeloom.operators.upsert import latest
from treeloom.session import ROWS_PER_FILE, stage

# Relationship types that edge events may create, and the tree one.
EVENT_RELATIONSHIPS = ("CFG", "DFG", "CALL", "CALL_RESOLVES_TO")
PARENT_OF = "PARENT_OF"


def _packed(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: ids.pack(F.col(c)) for c in columns})


def _unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: ids.unpack(F.col(c)) for c in columns})


def latest_packed(df: DataFrame, keys: list[str], packed: list[str]) -> DataFrame:
    """``upsert.latest`` whose rows move with the ids in the columns ``packed``."""
    return _unpacked(latest(_packed(df, packed), keys), packed)


def vertex_changes(nodes: DataFrame) -> DataFrame:
    """Node events as vertex rows."""
    return nodes.select(
        F.col("node_id").alias("id"),
        *[c for c in schemas.VERTEX.names if c != "id"],
        "position",
    )


def relationship_changes(edges: DataFrame) -> DataFrame:
    """Edge events as relationship rows, of any type: ends count as vertices."""
    return edges.select(
        F.col("source_id").alias("src"),
        F.col("target_id").alias("dst"),
        F.col("edge_type").alias("type"),
        "edge_id",
        "file_path",
        "event_time",
        "position",
    )


def parent_pairs(nodes: DataFrame) -> DataFrame:
    """Distinct parent and child ids over all events, old ones included."""
    pairs = nodes.filter(F.col("parent_id").isNotNull()).select("parent_id", "node_id")
    return _unpacked(_packed(pairs, pairs.columns).distinct(), pairs.columns)


def _named(parents: DataFrame | None, relations: DataFrame | None) -> DataFrame:
    named = []
    if parents is not None:
        named.append(parents.filter(F.col("parent_id").isNotNull()).select(F.col("parent_id").alias("id")))
    if relations is not None:
        named.append(relations.select(F.explode(F.array("src", "dst")).alias("id")))
    return reduce(DataFrame.unionByName, named)


def _distinct_ids(named: DataFrame) -> DataFrame:
    """Distinct packed ids. They are many and repeat, the module's most of all: tasks drop repeats
    in a hash aggregation before the shuffle."""
    return _packed(named, ["id"]).distinct()


def mentions(parents: DataFrame | None = None, relations: DataFrame | None = None) -> DataFrame:
    """Distinct ids that parent pairs or relations name."""
    return _unpacked(_distinct_ids(_named(parents, relations)), ["id"])


def with_stubs(changes: DataFrame, mentioned: DataFrame) -> DataFrame:
    """One row per id, with the latest properties or, for a mere mention, none; ``mentioned`` may repeat ids.

    Both sides lie by id after their aggregations, so the outer join moves nothing again. ``changes``
    may lack properties that the reader does not need: they move with the rows.
    """
    packed = [c for c in ("id", "parent_id") if c in changes.columns]
    newest = latest(_packed(changes, packed), ["id"]).drop("position")
    found = newest.join(_distinct_ids(mentioned), "id", "full")
    return _unpacked(found, packed).select(*[c for c in schemas.VERTEX.names if c in changes.columns])


def vertices(changes: DataFrame, parents: DataFrame, relations: DataFrame) -> DataFrame:
    """Vertices of node changes and of all that ``parents`` and ``relations`` name; both may repeat rows."""
    return with_stubs(changes, _named(parents, relations))


def relationships(parents: DataFrame, relations: DataFrame) -> DataFrame:
    """Tree relationships without properties, and the latest row per typed pair."""
    packed = ["src", "dst", "edge_id"]
    typed = _packed(relations.filter(F.col("type").isin(*EVENT_RELATIONSHIPS)), packed)
    typed = _unpacked(latest(typed, ["src", "dst", "type"]).drop("position"), packed)
    tree = parents.select(
        F.col("parent_id").alias("src"),
        F.col("node_id").alias("dst"),
        F.lit(PARENT_OF).alias("type"),
    )
    return tree.unionByName(typed, allowMissingColumns=True).select(*schemas.RELATIONSHIP.names)


def build_graph(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices and relationships of decoded node and edge events.

    ``nodes`` are read three times, twice for the vertices, and ``edges`` once for each table; stage
    what is dear to read.
    """
    relations = relationship_changes(edges)
    return (
        vertices(vertex_changes(nodes), nodes, relations),
        relationships(parent_pairs(nodes), relations),
    )


def current_only(
    nodes: DataFrame, graph_vertices: DataFrame, relations: DataFrame, documents: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Vertices and relationships of the last version of each file that parsed.

    ``documents`` has the time of that version. An element is live if its last event is of that
    time; tree relationships have none of their own, so they come from the node events ``nodes`` of that
    version. Vertices without properties stay only while something live names them, and so does
    a vertex of an old version, without its properties.
    """
    versions = documents.select(F.col("_id").alias("file_path"), "event_time")
    live = graph_vertices.join(versions, ["file_path", "event_time"], "left_semi").select(*schemas.VERTEX.names)
    typed = relations.filter(F.col("type") != PARENT_OF).join(versions, ["file_path", "event_time"], "left_semi")
    tree = parent_pairs(nodes.join(versions, ["file_path", "event_time"], "left_semi")).select(
        F.col("parent_id").alias("src"), F.col("node_id").alias("dst"), F.lit(PARENT_OF).alias("type")
    )
    linked = tree.unionByName(typed, allowMissingColumns=True).select(*schemas.RELATIONSHIP.names)
    named = _distinct_ids(linked.select(F.explode(F.array("src", "dst")).alias("id")))
    stubs = _unpacked(named.join(_packed(live.select("id"), ["id"]), "id", "left_anti"), ["id"])
    return live.unionByName(stubs, allowMissingColumns=True).select(*schemas.VERTEX.names), linked


def relationship_counts(relations: DataFrame) -> DataFrame:
    """Count per type, and the total in the row without a type."""
    return relations.rollup("type").agg(F.count(F.lit(1)).alias("relationships"))


def type_histogram(graph_vertices: DataFrame, n: int = 10, with_null: bool = False) -> DataFrame:
    rows = graph_vertices if with_null else graph_vertices.filter(F.col("node_type").isNotNull())
    return (
        rows.groupBy("node_type")
        .agg(F.count(F.lit(1)).alias("vertices"))
        .orderBy(F.desc("vertices"), F.asc_nulls_first("node_type"))
        .limit(n)
    )


def graph_totals(graph_vertices: DataFrame) -> DataFrame:
    """Vertices, those without properties, and distinct files."""
    return graph_vertices.agg(
        F.count(F.lit(1)).alias("vertices"),
        F.count_if(F.col("node_type").isNull()).alias("stubs"),
        F.count_distinct("file_path").alias("files"),
    )


def named_definitions(graph_vertices: DataFrame, n: int | None = 8) -> DataFrame:
    found = graph_vertices.filter(
        (F.col("node_type") == "FunctionDef") & F.col("name").isNotNull()
    ).select("name", "file_path", "lineno")
    return found.orderBy("file_path", "lineno", "name").limit(n) if n else found


def paths(
    starts: DataFrame, relations: DataFrame, rel_type: str, min_hops: int = 1, max_hops: int = 1
) -> DataFrame:
    """All paths of ``min_hops`` to ``max_hops`` relationships from ``starts.id``.

    A path may meet a vertex again but uses no relationship twice. ``nodes`` and
    ``rels`` hold the vertex ids and the relationships' ends along the path. Each
    hop is one join on the vertex reached so far, and is written down so that the
    next hop does not repeat the ones before it; so are the relationships of the type. Ids are
    packed on the way, and the relationships of a path follow from its vertices.
    """
    step = _packed(relations.filter(F.col("type") == rel_type).select("src", "dst"), ["src", "dst"])
    step = step.select(F.col("src").alias("at"), F.col("dst").alias("next"))
    if max_hops > 1:
        step = stage(step, "steps", ROWS_PER_FILE)
    reached = _packed(starts.select(F.col("id").alias("at")), ["at"]).withColumn("nodes", F.array("at"))
    found: list[DataFrame] = []
    for hops in range(1, max_hops + 1):
        used = F.array_contains(_pairs(F.col("nodes")), F.struct(F.col("at").alias("src"), F.col("next").alias("dst")))
        reached = (
            reached.join(step, "at")
            .filter(~used if hops > 1 else F.lit(True))
            .select(F.col("next").alias("at"), F.array_append("nodes", F.col("next")).alias("nodes"))
        )
        if hops < max_hops:
            reached = stage(reached, "paths", ROWS_PER_FILE)
        if hops >= min_hops:
            nodes = F.transform("nodes", ids.unpack)
            whole = reached.select(F.lit(hops).alias("hops"), nodes.alias("nodes"))
            found.append(whole.withColumn("rels", _pairs(F.col("nodes"))))
    return reduce(DataFrame.unionByName, found)


def _pairs(nodes: Column) -> Column:
    """Ends of the relationships between the vertices of a path."""
    length = F.size(nodes) - 1
    return F.zip_with(
        F.slice(nodes, F.lit(1), length), F.slice(nodes, F.lit(2), length),
        lambda src, dst: F.struct(src.alias("src"), dst.alias("dst")),
    )


def paths_from(
    graph_vertices: DataFrame,
    relations: DataFrame,
    where: Column,
    rel_type: str,
    min_hops: int = 1,
    max_hops: int = 1,
    limit: int | None = None,
) -> DataFrame:
    """Paths whose first vertex meets a condition, in path order if limited."""
    result = paths(
        graph_vertices.filter(where).select("id"), relations, rel_type, min_hops, max_hops
    )
    return result.orderBy("hops", "nodes").limit(limit) if limit else result
