"""Registered queries: each operator over whole tables, with its expected SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from treeloom import schemas
from treeloom.functions import envelope, paths
from treeloom.operators import derive, discovery, graph, reports, upsert
from treeloom.operators.flatten import flatten
from treeloom.plans import batch, report
from treeloom.session import ROWS_PER_FILE, stage, staging_path
from treeloom.sources import eventlog, files
from treeloom.streaming import documents as document_stream
from treeloom.streaming import errors as error_stream
from treeloom.streaming import graphs as graph_stream
from workloads import sources
from workloads.sources import table

Query = Callable[[SparkSession, str], DataFrame]

FIRST_RUN = "2024-01-01 00:00:00"
SECOND_RUN = "2024-02-01 00:00:00"

_shared: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, build: Callable[[], object]):
    """Build a staged intermediate table once per session and scale."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _shared:
        _shared[key] = build()
    return _shared[key]


def _instant(text: str) -> Column:
    """A fixed UTC instant, whatever the zone of the session."""
    return F.to_timestamp(F.lit(f"{text}+00:00"))


def _built(spark: SparkSession, sf_dir: str, what: str) -> bool:
    return (spark.sparkContext.applicationId, sf_dir, what) in _shared


def syntax(
    spark: SparkSession, sf_dir: str, name: str, columns: tuple[str, ...] | None = None
) -> DataFrame:
    """Syntax table of a source, with all columns if it is there already or none are named."""
    build, what = getattr(sources, name), f"syntax-{name}"
    if columns and not _built(spark, sf_dir, what):
        what += "".join(f"-{c}" for c in sorted(columns))
    else:
        columns = None
    return _once(
        spark, sf_dir, what, lambda: stage(flatten(build(spark, sf_dir), columns), "syntax", ROWS_PER_FILE)
    )


def _linked(
    spark: SparkSession, sf_dir: str, name: str, columns: tuple[str, ...], facts: tuple[str, ...]
) -> DataFrame:
    """Rows of the syntax table for a single pass, which need not be written down if nothing else did."""
    if _built(spark, sf_dir, f"syntax-{name}"):
        return syntax(spark, sf_dir, name)
    return flatten(getattr(sources, name)(spark, sf_dir), columns, facts)


def edges(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _once(
        spark,
        sf_dir,
        f"edges-{name}",
        lambda: stage(derive.all_edges(syntax(spark, sf_dir, name)), "edges", ROWS_PER_FILE),
    )


def _edges_once(
    spark: SparkSession, sf_dir: str, name: str, columns: tuple[str, ...] | None = None
) -> DataFrame:
    """All edges for a single reader, which need not be written down if nothing else did.

    ``columns`` are named by a reader that has the syntax table written down for itself.
    """
    if _built(spark, sf_dir, f"edges-{name}"):
        return edges(spark, sf_dir, name)
    if columns:
        return derive.all_edges(syntax(spark, sf_dir, name, columns))
    return derive.all_edges(_linked(spark, sf_dir, name, derive.EDGE_COLUMNS, derive.EDGE_FACTS))


def _staged_metadata(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Metadata of a source, written down for queries that read it more than once."""
    tree, linked = syntax(spark, sf_dir, name), _derived_edges(spark, sf_dir, name)
    return _once(
        spark, sf_dir, f"metadata-{name}", lambda: stage(derive.file_metadata(tree, linked), "metadata")
    )


def _derived_edges(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """All edges, derived by each reader from the syntax table unless a query wrote them down.

    They take one pass over the table, and most readers need no ids, so writing them costs more.
    """
    if _built(spark, sf_dir, f"edges-{name}"):
        return edges(spark, sf_dir, name)
    return derive.all_edges(syntax(spark, sf_dir, name))


def parsed(spark: SparkSession, sf_dir: str, name: str) -> batch.Parsed:
    tree, linked = syntax(spark, sf_dir, name), _derived_edges(spark, sf_dir, name)
    if _built(spark, sf_dir, f"metadata-{name}"):
        metadata = _staged_metadata(spark, sf_dir, name)
    else:
        metadata = derive.file_metadata(tree, linked)
    return batch.Parsed(derive.ast_nodes(tree), linked, metadata, derive.parse_errors(tree))


def routines_log(spark: SparkSession, sf_dir: str) -> str:
    """Log of a run over all customers and of a second run over those in debt."""

    def build() -> str:
        path = staging_path(spark, "log")
        first = parsed(spark, sf_dir, "routines").events(_instant(FIRST_RUN))
        second = parsed(spark, sf_dir, "routines_again").events(_instant(SECOND_RUN))
        eventlog.append(first, path)
        eventlog.append(second, path)
        return path

    return _once(spark, sf_dir, "log", build)


def _routines_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Vertices and relationships of the log, not yet computed.

    Node events have three readers and are written down once decoded; edge events have one for
    each of the two tables, and writing all of their ids costs more than decoding them again.
    """

    def build() -> tuple[DataFrame, DataFrame]:
        log = routines_log(spark, sf_dir)
        nodes, linked = [envelope.decode(eventlog.read(spark, log, kind), kind) for kind in ("nodes", "edges")]
        return graph.build_graph(stage(nodes, "nodes", ROWS_PER_FILE), linked)

    return _once(spark, sf_dir, "graph", build)


def routines_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "vertices", lambda: stage(_routines_tables(spark, sf_dir)[0], "vertices", ROWS_PER_FILE)
    )


def routines_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "relations", lambda: stage(_routines_tables(spark, sf_dir)[1], "relations", ROWS_PER_FILE)
    )


def routines_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both tables of the graph, each computed for the first query that reads it."""
    return routines_vertices(spark, sf_dir), routines_relations(spark, sf_dir)


def _walked_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The graph for paths from the vertices of files, unless a query wrote it down before.

    Of the vertices only ids and files are computed. Each of the two tables has one reader, and events
    are decoded by each step that reads them, as writing their ids takes more room.
    """
    if _built(spark, sf_dir, "graph") or _built(spark, sf_dir, "vertices") or _built(spark, sf_dir, "relations"):
        return routines_graph(spark, sf_dir)
    log = routines_log(spark, sf_dir)
    nodes, linked = [envelope.decode(eventlog.read(spark, log, kind), kind) for kind in ("nodes", "edges")]
    relations = graph.relationship_changes(linked)
    changes = nodes.select(F.col("node_id").alias("id"), "file_path", "position")
    return (
        graph.vertices(changes, nodes, relations),
        graph.relationships(graph.parent_pairs(nodes), relations),
    )


def _counted_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The graph for counts by kind, type and file, unless a query wrote it down before.

    Of the vertices, which have two readers, only what these count is written. Relationships have one,
    and of them only the typed pairs are computed: nothing compares or moves their other columns.
    """
    v, r = _routines_tables(spark, sf_dir)
    if _built(spark, sf_dir, "vertices"):
        v = routines_vertices(spark, sf_dir)
    else:
        v = stage(v.select("file_path", "node_type"), "vertices", ROWS_PER_FILE)
    return v, routines_relations(spark, sf_dir) if _built(spark, sf_dir, "relations") else r


# --- discovery --------------------------------------------------------------


def discovery_listing(spark, sf_dir):
    return sources.ledger_listing(spark, sf_dir).withColumn(
        "top_dir", paths.top_dir(F.col("rel_path"))
    )


def discovery_totals(spark, sf_dir):
    return discovery.totals(sources.ledger_listing(spark, sf_dir))


def discovery_top_dirs(spark, sf_dir):
    return discovery.top_dirs(sources.ledger_listing(spark, sf_dir))


def discovery_largest(spark, sf_dir):
    return discovery.largest(sources.ledger_listing(spark, sf_dir))


def discovery_first_per_flag(spark, sf_dir):
    return discovery.first_per_flag(sources.ledger_listing(spark, sf_dir))


def discovery_summary(spark, sf_dir):
    """The three parts of the summary as they were written and read again."""
    path = staging_path(spark, "summary")
    discovery.write_summary(sources.ledger_listing(spark, sf_dir), path)

    def part(name: str, schema: str, item: Column, amount: Column) -> DataFrame:
        rows = spark.read.schema(schema).json(f"{path}/{name}")
        return rows.select(F.lit(name).alias("part"), item.alias("item"), amount.alias("amount"))

    counts = "total_py_files BIGINT, included_files BIGINT, excluded_files BIGINT, total_size_bytes BIGINT"
    return (
        part("top_dirs", "top_dir STRING, files BIGINT", F.col("top_dir"), F.col("files"))
        .unionByName(
            part("largest", "rel_path STRING, size_bytes BIGINT", F.col("rel_path"), F.col("size_bytes"))
        )
        .unionByName(part("totals", counts, F.lit("files"), F.col("total_py_files")))
        .unionByName(part("totals", counts, F.lit("bytes"), F.col("total_size_bytes")))
    )


def exclusion_reasons(spark, sf_dir):
    listing = sources.ledger_listing(spark, sf_dir)
    return listing.select(
        "rel_path",
        "excluded",
        paths.exclusion_reason(F.col("rel_path")).alias("reason"),
        paths.shorten(F.col("rel_path"), 24, 21).alias("short_path"),
    )


def target_files(spark, sf_dir):
    return files.select_targets(sources.ledger_listing(spark, sf_dir), limit=50)


def target_files_all(spark, sf_dir):
    return files.select_targets(sources.ledger_listing(spark, sf_dir))


def single_target(spark, sf_dir):
    """The file that comes last in path order, found by its name alone."""
    listing = sources.ledger_listing(spark, sf_dir)
    last = listing.agg(F.max("rel_path")).first()[0]
    return files.select_targets(listing, single_file=last)


# --- syntax and edges -------------------------------------------------------


def _nodes(spark, sf_dir, name):
    return derive.ast_nodes(syntax(spark, sf_dir, name, derive.NODE_COLUMNS)).select(*schemas.NODE.names)


def _flat_edges(df: DataFrame, attr: str | None = None) -> DataFrame:
    columns = ["edge_id", "source_id", "target_id", "edge_type", "file_path"]
    return df.select(*columns, *([F.col("attrs")[attr].alias(attr)] if attr else []))


def ast_nodes(spark, sf_dir):
    return _nodes(spark, sf_dir, "ledger")


def ast_nodes_nested(spark, sf_dir):
    return _nodes(spark, sf_dir, "routines")


def cfg_edges(spark, sf_dir):
    return _flat_edges(derive.cfg_edges(_linked(spark, sf_dir, "ledger", derive.CFG_COLUMNS, derive.CFG_FACTS)))


def cfg_edges_branches(spark, sf_dir):
    return _flat_edges(derive.cfg_edges(_linked(spark, sf_dir, "branches", derive.CFG_COLUMNS, derive.CFG_FACTS)))


def cfg_edges_nested(spark, sf_dir):
    return _flat_edges(derive.cfg_edges(_linked(spark, sf_dir, "routines", derive.CFG_COLUMNS, derive.CFG_FACTS)))


def dfg_edges(spark, sf_dir):
    return _flat_edges(derive.dfg_edges(_linked(spark, sf_dir, "ledger", derive.DFG_COLUMNS, derive.DFG_FACTS)), "var")


def dfg_edges_branches(spark, sf_dir):
    return _flat_edges(derive.dfg_edges(_linked(spark, sf_dir, "branches", derive.DFG_COLUMNS, derive.DFG_FACTS)), "var")


def dfg_edges_scopes(spark, sf_dir):
    return _flat_edges(derive.dfg_edges(_linked(spark, sf_dir, "routines", derive.DFG_COLUMNS, derive.DFG_FACTS)), "var")


def call_edges(spark, sf_dir):
    return _flat_edges(derive.call_edges(_linked(spark, sf_dir, "routines", derive.CALL_COLUMNS, derive.CALL_FACTS)), "callee_name")


def call_resolves(spark, sf_dir):
    return _flat_edges(derive.resolve_edges(_linked(spark, sf_dir, "routines", derive.CALL_COLUMNS, derive.CALL_FACTS)), "callee_name")


def edge_union(spark, sf_dir):
    return _flat_edges(_edges_once(spark, sf_dir, "routines"))


def edge_counts(spark, sf_dir):
    return reports.edge_counts(_edges_once(spark, sf_dir, "branches"))


# --- files, errors and runs -------------------------------------------------


def _metadata(spark, sf_dir, name):
    """Measures alone, which count edges: neither the ids of these nor the rows are written down for it."""
    columns = derive.METADATA_COLUMNS
    linked = _edges_once(spark, sf_dir, name, columns)
    if _built(spark, sf_dir, f"edges-{name}"):
        tree = syntax(spark, sf_dir, name)
    else:
        tree = syntax(spark, sf_dir, name, columns)
    return derive.file_metadata(tree, linked).drop("unit")


def file_metadata(spark, sf_dir):
    return _metadata(spark, sf_dir, "ledger")


def file_metadata_calls(spark, sf_dir):
    return _metadata(spark, sf_dir, "routines")


def file_metadata_texts(spark, sf_dir):
    return _metadata(spark, sf_dir, "quoted")


def parse_errors(spark, sf_dir):
    """Kinds of errors; the messages are those of the interpreter."""
    return derive.parse_errors(syntax(spark, sf_dir, "prose")).select("file_path", "error_type")


def run_summary(spark, sf_dir):
    good, bad = parsed(spark, sf_dir, "quoted"), parsed(spark, sf_dir, "prose")
    return derive.run_summary(good.metadata, bad.errors)


def run_rates(spark, sf_dir):
    """Rates as if the run had taken one second per hundred files."""
    good = parsed(spark, sf_dir, "ledger")
    summary = derive.run_summary(good.metadata, good.errors)
    return reports.run_rates(summary, F.col("files_ok") / 100)


def batch_table(spark, sf_dir):
    return reports.batch_table(_metadata(spark, sf_dir, "ledger"))


def samples(spark, sf_dir):
    result = parsed(spark, sf_dir, "routines")
    return reports.samples(result.nodes, result.edges).select(
        "file_path",
        F.col("node.node_id").alias("node_id"),
        F.col("node.node_type").alias("node_type"),
        F.col("node.name").alias("name"),
        F.col("cfg_edge.edge_id").alias("cfg_edge_id"),
        F.col("dfg_edge.edge_id").alias("dfg_edge_id"),
        F.col("call_edge.edge_id").alias("call_edge_id"),
    )


def manifest_upsert(spark, sf_dir):
    """Manifest after both runs: customers in debt have the second run's rows."""

    def rows(name: str, moment: str) -> DataFrame:
        return batch.manifest_rows(
            parsed(spark, sf_dir, name).metadata, sources.REPOSITORY, _instant(moment)
        )

    return batch.update_manifest(
        rows("routines", FIRST_RUN), rows("routines_again", SECOND_RUN)
    )


def manifest_saved(spark, sf_dir):
    """The same manifest, saved after each run and once more after the first."""
    path = staging_path(spark, "manifest")
    for run_id, name, moment in (
        (1, "routines", FIRST_RUN),
        (2, "routines_again", SECOND_RUN),
        (1, "routines", FIRST_RUN),
    ):
        rows = batch.manifest_rows(
            parsed(spark, sf_dir, name).metadata, sources.REPOSITORY, _instant(moment)
        )
        batch.save_manifest(rows, path, run_id)
    return batch.load_manifest(spark, path)


# --- events -----------------------------------------------------------------


def _log(spark, sf_dir, kind):
    return eventlog.read(spark, routines_log(spark, sf_dir), kind)


def node_events(spark, sf_dir):
    return envelope.decode(_log(spark, sf_dir, "nodes"), "nodes").drop("position")


def edge_events(spark, sf_dir):
    decoded = envelope.decode(_log(spark, sf_dir, "edges"), "edges").drop("position")
    attrs = F.col("attrs")
    return decoded.select(
        *[c for c in decoded.columns if c != "attrs"],
        F.size(attrs).alias("num_attrs"),
        F.coalesce(attrs["var"], attrs["callee_name"]).alias("attr_value"),
    )


def metadata_events(spark, sf_dir):
    return document_stream.as_documents(_log(spark, sf_dir, "metadata")).drop("position")


def error_events(spark, sf_dir):
    errors = derive.parse_errors(syntax(spark, sf_dir, "prose"))
    events = eventlog.to_events(errors, "errors", _instant(FIRST_RUN))
    decoded = envelope.decode(events, "errors")
    return decoded.select("schema_version", "event_time", "event_type", "file_path", "error_type")


def event_keys(spark, sf_dir):
    """Keys with the number of their events and of the partitions these are in."""
    return reports.key_counts(eventlog.read_all(spark, routines_log(spark, sf_dir)))


def topic_counts(spark, sf_dir):
    return reports.topic_counts(eventlog.read_all(spark, routines_log(spark, sf_dir)))


def consumer_lag(spark, sf_dir):
    """Lag on the node topic, by its partitions, of a consumer that drained the first run only."""
    log = _log(spark, sf_dir, "nodes")
    seen = log.filter(F.col("timestamp") == _instant(FIRST_RUN))
    committed = seen.groupBy("partition").agg(F.count(F.lit(1)).alias("current_offset"))
    return reports.consumer_lag(reports.log_ends(log), committed)


def end_to_end_run(spark, sf_dir):
    """Files written by tasks, then found, read, parsed and logged: the summary, the log and the manifest."""
    root, log, manifest = (staging_path(spark, n) for n in ("tree", "log", "manifest"))
    written = sources.write_tree(sources.routines(spark, sf_dir), root)
    listing = stage(files.discover(spark, root), "listing")
    summary = batch.run(
        spark, listing, root, sources.REPOSITORY, log, manifest, event_time=_instant(FIRST_RUN)
    )
    part = F.lit
    counts = reports.topic_counts(eventlog.read_all(spark, log)).select(
        part("topic").alias("part"), F.col("topic").alias("item"), F.col("messages").alias("amount")
    )
    rows = batch.load_manifest(spark, manifest).select(
        part("file").alias("part"), F.concat_ws(" ", "rel_path", "file_hash").alias("item"), F.col("num_nodes").alias("amount")
    )
    totals = summary.select(
        part("summary").alias("part"),
        F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in summary.columns]), F.array(*summary.columns))).alias("item", "amount"),
    )
    found = written.select(part("written").alias("part"), part("files").alias("item"), F.col("files").alias("amount"))
    return counts.unionByName(rows).unionByName(totals).unionByName(found)


def incremental_run(spark, sf_dir):
    """A full run over the files of all customers, and one over those that changed since, the customers in debt.

    The manifest after both, and how often each file was parsed.
    """
    root, log, manifest = (staging_path(spark, n) for n in ("tree", "log", "manifest"))
    for name, moment in (("routines", FIRST_RUN), ("routines_again", SECOND_RUN)):
        sources.write_tree(getattr(sources, name)(spark, sf_dir), root)
        listing = stage(files.discover(spark, root), "listing")
        batch.run(
            spark, listing, root, sources.REPOSITORY, log, manifest,
            event_time=_instant(moment), changed_only=True,
        )
    parses = eventlog.read(spark, log, "metadata").groupBy("key").agg(F.count(F.lit(1)).alias("parses"))
    parses = parses.select(paths.relative_path(sources.REPOSITORY, F.col("key")).alias("rel_path"), "parses")
    return batch.load_manifest(spark, manifest).join(parses, "rel_path", "left")


def manifest_scan(spark, sf_dir):
    """The listing from one JSON document, behind a summary that lists files as well."""
    path = staging_path(spark, "listing-document")
    listing = sources.ledger_listing(spark, sf_dir)
    entry = F.to_json(F.struct("rel_path", "size_bytes", "excluded"))
    largest = F.concat(F.lit('{"summary": {"largest_files": ['), F.array_join(F.collect_list("entry"), ", "), F.lit(']}, "files": ['))
    head = discovery.largest(listing.withColumn("entry", entry)).select("entry").agg(largest.alias("value"))
    last = listing.agg(F.max("rel_path")).first()[0]
    comma = F.when(F.col("rel_path") == last, "\n").otherwise(",\n")
    rows = listing.select(F.lit(1).alias("part"), "rel_path", F.concat(entry, comma).alias("value"))
    ends = head.select(F.lit(0).alias("part"), F.lit("").alias("rel_path"), "value").unionByName(
        spark.createDataFrame([(2, "", "]}")], "part INT, rel_path STRING, value STRING")
    )
    whole = ends.unionByName(rows).orderBy("part", "rel_path").coalesce(1)
    whole.select("value").write.option("lineSep", " ").text(path)
    return files.read_listing_document(spark, path).withColumn("top_dir", paths.top_dir(F.col("rel_path")))


# --- graph ------------------------------------------------------------------


def vertices(spark, sf_dir):
    return routines_vertices(spark, sf_dir)


def relationships(spark, sf_dir):
    return routines_relations(spark, sf_dir)


def stub_vertices(spark, sf_dir):
    return routines_vertices(spark, sf_dir).filter(F.col("node_type").isNull()).select("id")


def unknown_edge_types(spark, sf_dir):
    """Typed edges from an order's customer to the order, under the order's status.

    Only one status is renamed to a known type; the others must leave ends only.
    """
    orders = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    linked = orders.select(
        F.concat(F.lit("c"), "o_custkey").alias("source_id"),
        F.concat(F.lit("o"), "o_orderkey").alias("target_id"),
        F.when(status == "F", "CALL").otherwise(status).alias("edge_type"),
        F.lit(None).cast("string").alias("edge_id"),
        F.lit(None).cast("string").alias("file_path"),
        F.lit(None).cast("string").alias("event_time"),
        F.array(F.col("o_orderkey")).alias("position"),
    )
    relations = graph.relationship_changes(linked)
    nothing = spark.createDataFrame([], schemas.PARENT)
    no_changes = spark.createDataFrame([], T.StructType([*schemas.VERTEX.fields, schemas.POSITION]))
    ends = graph.vertices(no_changes, nothing, relations)
    kept = graph.relationships(nothing, relations)
    return (
        ends.select(F.lit("vertex").alias("part"), "id", F.lit(None).cast("string").alias("other"))
        .unionByName(
            kept.select(F.col("type").alias("part"), F.col("src").alias("id"), F.col("dst").alias("other"))
        )
    )


def vertex_merge(spark, sf_dir):
    """Orders as vertices overwritten by their line items in ship order.

    The last item decides every property, also where its value is null.
    """
    items = table(spark, sf_dir, "lineitem").filter(F.col("l_orderkey").isNotNull())
    moment = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    changes = items.select(
        F.concat(F.lit("o"), "l_orderkey").alias("id"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"),
        F.nullif(F.col("l_linestatus"), F.lit("O")).alias("status"),
        F.array(moment, F.col("l_linenumber").cast("long"), F.col("l_partkey"), F.col("l_suppkey"),
                F.floor(F.col("l_extendedprice") * 100)).alias("position"),
    )
    return upsert.latest(changes, ["id"]).drop("position")


def relationship_merge(spark, sf_dir):
    """Supplier to part relationships, overwritten by later shipments."""
    moment = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    changes = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), "l_suppkey").alias("src"),
        F.concat(F.lit("p"), "l_partkey").alias("dst"),
        F.lit("CALL").alias("type"),
        F.concat(F.lit("e"), "l_orderkey").alias("edge_id"),
        F.lit(None).cast("string").alias("file_path"),
        F.col("l_linenumber").cast("string").alias("event_time"),
        F.array(moment, F.col("l_orderkey"), F.col("l_linenumber").cast("long"),
                F.floor(F.col("l_extendedprice") * 100)).alias("position"),
    )
    nothing = spark.createDataFrame([], schemas.PARENT)
    return graph.relationships(nothing, changes).drop("file_path")


def _moved(spark, sf_dir):
    """Node events, vertices, relationships and documents after the files of customers in debt moved down by one line.

    Relationships have one reader, which takes no tree relationships of theirs, and are computed for it.
    """

    def build():
        events = parsed(spark, sf_dir, "routines").events(_instant(FIRST_RUN)).unionByName(
            parsed(spark, sf_dir, "routines_moved").events(_instant(SECOND_RUN))
        )

        def of(kind):
            return events.filter(F.col("topic") == envelope.TOPIC[kind])

        decoded = [stage(envelope.decode(of(kind), kind), kind, ROWS_PER_FILE) for kind in ("nodes", "edges")]
        found, relations = graph.build_graph(*decoded)
        documents = upsert.latest(document_stream.as_documents(of("metadata")), document_stream.KEYS)
        return decoded[0], stage(found, "moved", ROWS_PER_FILE), relations, stage(documents, "moved")

    return _once(spark, sf_dir, "moved", build)


def moved_vertices(spark, sf_dir):
    """New positions of moved files are new vertices; those at the old positions stay."""
    return _moved(spark, sf_dir)[1]


def current_vertices(spark, sf_dir):
    """The same graph without what only old versions of files hold."""
    return graph.current_only(*_moved(spark, sf_dir))[0]


def current_relationships(spark, sf_dir):
    return graph.current_only(*_moved(spark, sf_dir))[1]


def relationship_counts(spark, sf_dir):
    return graph.relationship_counts(routines_relations(spark, sf_dir))


def graph_totals(spark, sf_dir):
    return graph.graph_totals(routines_vertices(spark, sf_dir))


def type_histogram(spark, sf_dir):
    return graph.type_histogram(routines_vertices(spark, sf_dir))


def type_histogram_with_null(spark, sf_dir):
    return graph.type_histogram(routines_vertices(spark, sf_dir), n=30, with_null=True)


def node_type_counts(spark, sf_dir):
    """Top kinds of node events, every event counted."""
    events = derive.ast_nodes(syntax(spark, sf_dir, "ledger", derive.NODE_COLUMNS))
    return graph.type_histogram(events).withColumnRenamed("vertices", "events")


def named_definitions(spark, sf_dir):
    return graph.named_definitions(routines_vertices(spark, sf_dir))


def named_definitions_all(spark, sf_dir):
    return graph.named_definitions(routines_vertices(spark, sf_dir), n=None)


def _ends(found: DataFrame) -> DataFrame:
    return found.select(
        "hops",
        F.element_at("nodes", 1).alias("start_id"),
        F.element_at("nodes", -1).alias("end_id"),
        F.array_join("nodes", ">").alias("path"),
    )


def call_paths(spark, sf_dir):
    """One or two calls from every vertex named ``m``."""
    v, r = routines_graph(spark, sf_dir)
    return _ends(graph.paths_from(v, r, F.col("name") == "m", "CALL", 1, 2))


def call_paths_first(spark, sf_dir):
    v, r = routines_graph(spark, sf_dir)
    return _ends(graph.paths_from(v, r, F.col("name") == "m", "CALL", 1, 2, limit=50))


def subtree_paths(spark, sf_dir):
    """One to three tree steps from every vertex of every file."""
    v, r = _walked_graph(spark, sf_dir)
    return _ends(graph.paths_from(v, r, F.col("file_path").isNotNull(), "PARENT_OF", 1, 3))


def subtree_paths_first(spark, sf_dir):
    """One to three tree steps within the file of the first customer."""
    v, r = routines_graph(spark, sf_dir)
    one = F.col("file_path") == f"{sources.REPOSITORY}/routines/0.py"
    return _ends(graph.paths_from(v, r, one, "PARENT_OF", 1, 3, limit=100))


def dataflow_paths(spark, sf_dir):
    v, r = routines_graph(spark, sf_dir)
    return _ends(graph.paths_from(v, r, F.col("file_path").isNotNull(), "DFG"))


def dataflow_paths_first(spark, sf_dir):
    """Data flow within the file of the first customer, the first 30 in path order."""
    v, r = routines_graph(spark, sf_dir)
    one = F.col("file_path").contains("/routines/0.py")
    return _ends(graph.paths_from(v, r, one, "DFG", limit=30))


def region_paths(spark, sf_dir):
    """One to three steps down region, nation, customer and order."""

    def link(name: str, src: Column, dst: Column) -> DataFrame:
        return table(spark, sf_dir, name).select(src.alias("src"), dst.alias("dst"))

    def key(letter: str, column: str) -> Column:
        return F.concat(F.lit(letter), F.col(column).cast("string"))

    relations = reduce(
        DataFrame.unionByName,
        [
            link("nation", key("r", "n_regionkey"), key("n", "n_nationkey")),
            link("customer", key("n", "c_nationkey"), key("c", "c_custkey")),
            link("orders", key("c", "o_custkey"), key("o", "o_orderkey")),
        ],
    ).withColumn("type", F.lit("PARENT_OF"))
    starts = table(spark, sf_dir, "region").select(key("r", "r_regionkey").alias("id"))
    return _ends(graph.paths(starts, relations, "PARENT_OF", 1, 3))


# --- streams ----------------------------------------------------------------


def _drain_documents(spark, log, target, checkpoint):
    stream = eventlog.stream(spark, log, "metadata")
    query = document_stream.write_documents(stream, target, checkpoint)
    query.awaitTermination()
    return query


def _folded_documents(spark, sf_dir):
    """Table of one drained stream over both runs, in small batches, folded on the way."""

    def build():
        target = staging_path(spark, "documents")
        stream = eventlog.stream(spark, routines_log(spark, sf_dir), "metadata", max_files_per_trigger=8)
        document_stream.write_documents(
            stream, target, staging_path(spark, "checkpoint"), fold_every=1
        ).awaitTermination()
        return target

    return _once(spark, sf_dir, "folded-documents", build)


def stream_documents(spark, sf_dir):
    return document_stream.documents(spark, _folded_documents(spark, sf_dir))


def report_dataset(spark, sf_dir):
    """The report on the routines and the ledger's listing, as it was written and read again."""
    _staged_metadata(spark, sf_dir, "routines")
    run = parsed(spark, sf_dir, "routines")
    v, r = _counted_graph(spark, sf_dir)
    parts = report.dataset(
        sources.ledger_listing(spark, sf_dir), run.nodes, run.edges, run.metadata,
        eventlog.read_all(spark, routines_log(spark, sf_dir)), consumer_lag(spark, sf_dir), v, r,
    )
    path = staging_path(spark, "report")
    report.write(parts, path)
    shown = {
        "totals": (F.lit("files"), F.col("total_py_files")),
        "top_dirs": (F.col("top_dir"), F.col("files")),
        "largest": (F.col("rel_path"), F.col("size_bytes")),
        "files": (F.col("file_path"), F.col("num_nodes")),
        "edges_per_file": (F.col("file_path"), F.col("num_total_edges")),
        "samples": (F.col("file_path"), F.col("node.lineno").cast("long")),
        "topics": (F.col("topic"), F.col("messages")),
        "lag": (F.col("partition").cast("string"), F.col("lag")),
        "graph": (F.lit("stubs"), F.col("stubs")),
        "relationships": (F.col("type"), F.col("relationships")),
        "types": (F.col("node_type"), F.col("vertices")),
    }
    return reduce(
        DataFrame.unionByName,
        [
            spark.read.schema(parts[name].schema).json(f"{path}/{name}").select(
                F.lit(name).alias("part"), item.alias("item"), amount.alias("amount")
            )
            for name, (item, amount) in shown.items()
        ],
    )


def continuous_documents(spark, sf_dir):
    """Table of a long-lived stream over both runs that is stopped once it has taken all of them."""
    target = staging_path(spark, "documents")
    stream = eventlog.stream(spark, routines_log(spark, sf_dir), "metadata")
    query = document_stream.write_documents(
        stream, target, staging_path(spark, "checkpoint"), continuous=True
    )
    document_stream.stop_when_idle(query)
    return document_stream.documents(spark, target)


def concurrent_documents(spark, sf_dir):
    """Table that two streams write at once, the second run's and the first's, folding after every batch."""
    target, running = staging_path(spark, "documents"), []
    for name, moment in (("routines_again", SECOND_RUN), ("routines", FIRST_RUN)):
        log = staging_path(spark, "log")
        eventlog.append(parsed(spark, sf_dir, name).events(_instant(moment)), log)
        stream = eventlog.stream(spark, log, "metadata", max_files_per_trigger=2)
        running.append((stream, staging_path(spark, "checkpoint")))
    running = [document_stream.write_documents(s, target, c, fold_every=1) for s, c in running]
    for query in running:
        query.awaitTermination()
    return document_stream.documents(spark, target)


def offset_order(spark, sf_dir):
    """Documents of broker rows that all have one time: the highest offset of a key wins, in whatever batch it comes."""
    rows = table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("file_path"),
        F.sha2("event_type", 256).alias("file_hash"), F.col("event_id").alias("loc"),
        *[F.lit(0).cast("long").alias(c) for c in ("size_bytes", "num_functions", "num_classes", "num_nodes", "num_edges")],
        (F.col("user_id") % 3).cast("int").alias("at"),
    )
    moment = _instant(FIRST_RUN)
    log = staging_path(spark, "broker")
    broker = rows.select(
        F.col("file_path").alias("key"), envelope.envelope("metadata", envelope.iso_time(moment)).alias("value"),
        F.col("at").alias("partition"), F.col("loc").alias("offset"), moment.alias("timestamp"),
    )
    broker.repartition(6, F.col("offset") % 6).write.parquet(log)
    stream = spark.readStream.schema(broker.schema).option("maxFilesPerTrigger", 2).parquet(log)
    target = staging_path(spark, "documents")
    document_stream.write_documents(
        eventlog.ordered_by_offset(stream), target, staging_path(spark, "checkpoint"), fold_every=2
    ).awaitTermination()
    return document_stream.documents(spark, target).select("_id", "file_hash", "loc", "event_time")


def stream_errors(spark, sf_dir):
    """Errors of all prose as files, some of which a second run finds mended."""
    log, table_, target = (staging_path(spark, n) for n in ("log", "errors", "documents"))
    checkpoints = [staging_path(spark, "checkpoint") for _ in range(2)]
    for name, moment in (("prose", FIRST_RUN), ("mended", SECOND_RUN)):
        eventlog.create_topics(spark, log)
        eventlog.append(parsed(spark, sf_dir, name).events(_instant(moment)), log)
        running = [
            error_stream.write_errors(eventlog.stream(spark, log, "errors"), table_, checkpoints[0], fold_every=1),
            document_stream.write_documents(eventlog.stream(spark, log, "metadata"), target, checkpoints[1]),
        ]
        for query in running:
            query.awaitTermination()
    return error_stream.errors(spark, table_, target).select("file_path", "error_type", "event_time", "closed_time")


def _resumed(spark, sf_dir):
    """Two drained streams on one checkpoint, the second after the second run."""

    def build():
        log, target = staging_path(spark, "log"), staging_path(spark, "documents")
        checkpoint = staging_path(spark, "checkpoint")
        progress = []
        for name, moment in (("routines", FIRST_RUN), ("routines_again", SECOND_RUN)):
            eventlog.append(parsed(spark, sf_dir, name).events(_instant(moment)), log)
            with reports.ProgressLog(spark) as reported:
                _drain_documents(spark, log, target, checkpoint)
            progress += [p for p in reported.progress if p.numInputRows]
        return target, progress

    return _once(spark, sf_dir, "resumed", build)


def stream_resume(spark, sf_dir):
    """Batches of the resumed stream: the second reads the new events only."""
    _, progress = _resumed(spark, sf_dir)
    return reports.stream_progress(spark, progress).select("batch_id", "input_rows")


def stream_resumed_documents(spark, sf_dir):
    return document_stream.documents(spark, _resumed(spark, sf_dir)[0])


def replay_counts(spark, sf_dir):
    """Documents and their changed hashes, before and after the second run."""
    target, _ = _resumed(spark, sf_dir)
    changes = upsert.read_changes(spark, target, schemas.DOCUMENT)
    first = changes.filter(F.col("event_time").startswith("2024-01"))
    before = upsert.latest(first, ["_id"]).select("_id", F.col("file_hash").alias("old"), F.col("loc").alias("old_loc"))
    after = document_stream.documents(spark, target)
    return before.join(after, "_id", "full").agg(
        F.count("old").alias("documents_before"),
        F.count("file_hash").alias("documents_after"),
        F.count_if(F.col("old") != F.col("file_hash")).alias("changed"),
        F.sum(F.col("loc") - F.col("old_loc")).alias("lines_added"),
    )


def document_by_id(spark, sf_dir):
    target = _folded_documents(spark, sf_dir)
    return document_stream.document(spark, target, f"{sources.REPOSITORY}/routines/0.py")


def _prose_events(spark, sf_dir, topic):
    """All documents as events of a topic; none of them is JSON."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("key"),
        F.col("text").alias("value"),
        F.lit(0).alias("partition"),
        _instant(SECOND_RUN).alias("timestamp"),
        F.array(F.col("doc_id")).alias("position"),
        F.lit(topic).alias("topic"),
    )


def stream_rejects(spark, sf_dir):
    """Documents of a topic in which all prose stands among the events as well."""
    log, target, rejects = (staging_path(spark, n) for n in ("log", "documents", "rejects"))
    events = parsed(spark, sf_dir, "routines").events(_instant(FIRST_RUN))
    eventlog.append(events.filter(F.col("topic") == envelope.TOPIC["metadata"]), log)
    eventlog.append(_prose_events(spark, sf_dir, envelope.TOPIC["metadata"]), log)
    document_stream.write_documents(
        eventlog.stream(spark, log, "metadata"), target, staging_path(spark, "checkpoint"), rejects=rejects
    ).awaitTermination()
    kept = document_stream.documents(spark, target)
    texts = T.StructType([T.StructField("value", T.StringType())])
    refused = upsert.read_changes(spark, rejects, texts)
    return kept.select(F.lit("document").alias("part"), F.col("_id").alias("item")).unionByName(
        refused.select(F.lit("reject").alias("part"), F.sha2("value", 256).alias("item"))
    )


def _streamed_graph(spark, sf_dir):
    def build():
        log, store = routines_log(spark, sf_dir), staging_path(spark, "graph")
        # The edges run first, so that every vertex begins as a mere mention.
        for kind, write in (("edges", graph_stream.write_edges), ("nodes", graph_stream.write_nodes)):
            stream = eventlog.stream(spark, log, kind, max_files_per_trigger=8)
            write(stream, store, staging_path(spark, "checkpoint")).awaitTermination()
        return graph_stream.read_graph(spark, store)

    return _once(spark, sf_dir, "streamed-graph", build)


def concurrent_vertices(spark, sf_dir):
    """Vertices of a store that a node and an edge stream fill at the same time, in small batches."""
    log, store = routines_log(spark, sf_dir), staging_path(spark, "graph")
    running = [
        write(
            eventlog.stream(spark, log, kind, max_files_per_trigger=8), store,
            staging_path(spark, "checkpoint"), fold_every=1,
        )
        for kind, write in (("edges", graph_stream.write_edges), ("nodes", graph_stream.write_nodes))
    ]
    for query in running:
        query.awaitTermination()
    return graph_stream.read_graph(spark, store)[0]


def stream_graph_rejects(spark, sf_dir):
    """Vertices of topics in which all prose stands among the events, and the prose set aside."""
    log, store = staging_path(spark, "log"), staging_path(spark, "graph")
    events = parsed(spark, sf_dir, "routines").events(_instant(FIRST_RUN))
    for kind, write in (("nodes", graph_stream.write_nodes), ("edges", graph_stream.write_edges)):
        topic = envelope.TOPIC[kind]
        eventlog.append(events.filter(F.col("topic") == topic), log)
        eventlog.append(_prose_events(spark, sf_dir, topic), log)
        write(eventlog.stream(spark, log, kind), store, staging_path(spark, "checkpoint")).awaitTermination()
    found = graph_stream.read_graph(spark, store)[0].select(F.lit("vertex").alias("part"), F.col("id").alias("item"))
    for kind in ("nodes", "edges"):
        refused = graph_stream.read_rejects(spark, store, kind)
        found = found.unionByName(refused.select(F.lit(kind).alias("part"), F.sha2("value", 256).alias("item")))
    return found


def stream_vertices(spark, sf_dir):
    return _streamed_graph(spark, sf_dir)[0]


def stream_relationships(spark, sf_dir):
    return _streamed_graph(spark, sf_dir)[1]


def queries() -> dict[str, Query]:
    """All public functions of this module, by name."""
    names = [
        "discovery_listing", "discovery_totals", "discovery_top_dirs", "discovery_largest",
        "discovery_first_per_flag", "discovery_summary", "exclusion_reasons", "target_files",
        "target_files_all", "single_target",
        "ast_nodes", "ast_nodes_nested", "cfg_edges", "cfg_edges_branches", "cfg_edges_nested",
        "dfg_edges", "dfg_edges_branches", "dfg_edges_scopes", "call_edges", "call_resolves",
        "edge_union", "edge_counts",
        "file_metadata", "file_metadata_calls", "file_metadata_texts", "parse_errors",
        "run_summary", "run_rates", "batch_table", "samples", "manifest_upsert",
        "manifest_saved",
        "node_events", "edge_events", "metadata_events", "error_events", "event_keys",
        "topic_counts", "consumer_lag", "end_to_end_run", "incremental_run", "manifest_scan",
        "report_dataset",
        "vertices", "relationships", "stub_vertices", "unknown_edge_types", "vertex_merge",
        "relationship_merge", "moved_vertices", "current_vertices",
        "current_relationships", "relationship_counts", "graph_totals", "type_histogram",
        "type_histogram_with_null", "node_type_counts", "named_definitions",
        "named_definitions_all", "call_paths", "call_paths_first", "subtree_paths",
        "subtree_paths_first", "dataflow_paths", "dataflow_paths_first", "region_paths",
        "stream_documents", "document_by_id", "stream_rejects", "stream_resume", "stream_resumed_documents", "replay_counts",
        "continuous_documents", "concurrent_documents", "offset_order", "stream_errors",
        "stream_vertices", "stream_relationships", "concurrent_vertices", "stream_graph_rejects",
    ]
    return {name: globals()[name] for name in names}
