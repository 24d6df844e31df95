"""How often a query reads, sorts and moves its rows."""

from pyspark.sql import DataFrameWriter, functions as F

from tests.helpers import source_rows
from treeloom import schemas
from treeloom.functions import envelope
from treeloom.operators import derive, graph, reports
from treeloom.operators.flatten import flatten
from treeloom.plans import batch
from treeloom.session import stage
from treeloom.sources import eventlog
from treeloom.streaming import graphs
from workloads import catalog

TEXTS = {
    "a.py": "x = 1\ndef f(y):\n    def g():\n        return x + y\n    x = g()\n    return x\nf(x)\n(lambda: 0)()\n",
    "b.py": "for i in r:\n    i = i\nelse:\n    s = t(u(i))\n",
    "empty.py": "",
    "broken.py": "def",
    "stray.py": b"\xff",
}


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def forget(monkeypatch):
    monkeypatch.setattr(catalog, "_shared", {})


def test_edges_are_made_in_one_pass(spark):
    plan = executed(derive.all_edges(flatten(source_rows(spark, TEXTS))))
    assert plan.count("MapInArrow") == 1
    assert not any(step in plan for step in ("Exchange", "Join", "Window", "Sort"))


def test_rows_without_edges_are_left_out(spark):
    texts = source_rows(spark, TEXTS)
    whole = flatten(texts)
    for step, columns, facts in (
        (derive.cfg_edges, derive.CFG_COLUMNS, derive.CFG_FACTS),
        (derive.dfg_edges, derive.DFG_COLUMNS, derive.DFG_FACTS),
        (derive.call_edges, derive.CALL_COLUMNS, derive.CALL_FACTS),
        (derive.resolve_edges, derive.CALL_COLUMNS, derive.CALL_FACTS),
        (derive.all_edges, derive.EDGE_COLUMNS, derive.EDGE_FACTS),
    ):
        some = flatten(texts, columns, facts)
        assert some.count() < whole.count()
        assert sorted(map(str, step(some).collect())) == sorted(map(str, step(whole).collect()))
    rows = flatten(texts, ("file_path", "callee", "file_hash"), ("callee",)).collect()
    assert [r["callee"] for r in rows if r["file_path"] == "a.py"] == ["g", "f", None]
    assert [r["file_hash"] is None for r in rows if r["file_path"] == "a.py"] == [False, True, True]


def test_a_read_notes_its_definitions_by_scope(spark):
    reads = flatten(source_rows(spark, {"a.py": TEXTS["a.py"]})).filter(F.col("defs").isNotNull())
    found = {(r["name"], r["lineno"]): [tuple(d) for d in r["defs"]] for r in reads.collect()}
    # Breadth first the assignment in the function comes before both reads.
    assert [d[1:] for d in found["x", 7]] == [(5, 4)]
    assert [d[1:] for d in found["x", 4]] == [(5, 4), (5, 4)]
    assert ("y", 4) not in found


def test_queries_on_edges_write_no_syntax(spark, sf_dir, monkeypatch):
    forget(monkeypatch)
    counts = catalog.edge_counts(spark, sf_dir)
    assert executed(counts).count("MapInArrow") == 1 and "sha2" not in executed(counts)
    alone = [counts] + [q(spark, sf_dir) for q in (catalog.cfg_edges_branches, catalog.dfg_edges_branches)]
    assert not catalog._shared
    catalog.edges(spark, sf_dir, "branches")
    shared = [q(spark, sf_dir) for q in (catalog.edge_counts, catalog.cfg_edges_branches, catalog.dfg_edges_branches)]
    for one, other in zip(alone, shared, strict=True):
        assert sorted(one.collect()) == sorted(other.collect())


def test_counts_of_keys_repeat_no_rows(spark):
    def event(key, text, partition, topic="t"):
        return key, text, partition, topic

    log = spark.createDataFrame(
        [
            event("00000000000000aa", '{"_key": "00000000000000aa"}', 0), event("00000000000000aa", '{"_key": "other"}', 70),
            event("00000000000000aa", '{"_key": ""}', 70), event("00000000000000aa", "prose", 2),
            event("00000000000000aa", '{"_key": "00000000000000aa"}', 1, "u"), event("", '{"_key": ""}', 1),
            event(None, '{"_key": "x"}', 1), event(None, '{"_key": "y"}', 1), event(None, '{"_key": null}', None),
        ],
        "key STRING, value STRING, partition INT, topic STRING",
    )
    counts = reports.key_counts(log)
    found = {(r["topic"], r["key"]): (r["events"], r["partitions"], r["keys_in_text"]) for r in counts.collect()}
    assert found == {
        ("t", "00000000000000aa"): (4, 3, 3), ("u", "00000000000000aa"): (1, 1, 1), ("t", ""): (1, 1, 1), ("t", None): (3, 1, 2),
    }
    assert "Expand" not in executed(counts)
    assert [f.dataType.simpleString() for f in counts.schema] == ["string", "string", "bigint", "bigint", "bigint"]


def test_keys_of_the_log_are_counted_so(spark, sf_dir):
    assert "Expand" not in executed(catalog.event_keys(spark, sf_dir))


def test_a_batch_writes_the_tables_of_the_store_only(spark, tmp_path, monkeypatch):
    log, store, noted = str(tmp_path / "log"), str(tmp_path / "graph"), []
    parsed = batch.parse(source_rows(spark, TEXTS))
    eventlog.append(parsed.events(F.timestamp_micros(F.lit(0))), log)
    for topic in ("cpg.nodes", "cpg.edges"):
        stray = [("k", value, 0, None, [1], topic) for value in ("prose", None)]
        eventlog.append(spark.createDataFrame(stray, schemas.LOG), log)
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, **o: noted.append(path) or write(self, path, **o))
    for kind, run in (("nodes", graphs.write_nodes), ("edges", graphs.write_edges)):
        run(eventlog.stream(spark, log, kind), store, str(tmp_path / kind)).awaitTermination()
        assert {r["value"] for r in graphs.read_rejects(spark, store, kind).collect()} == {"prose", None}
    assert {path.removeprefix(store).split("/feed=")[0] for path in noted} == {
        "/rejects/nodes", "/vertices", "/parents", "/mentions", "/rejects/edges", "/relations",
    }
    expected = graph.build_graph(
        *[envelope.decode(eventlog.read(spark, log, kind), kind).filter(F.col("file_path").isNotNull()) for kind in ("nodes", "edges")]
    )
    for found, wanted in zip(graphs.read_graph(spark, store), expected, strict=True):
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_a_run_writes_no_edges(spark, monkeypatch):
    labels = []
    monkeypatch.setattr(batch, "stage", lambda df, label, rows=0: labels.append(label) or stage(df, label, rows))
    assert batch.parse(source_rows(spark, TEXTS)).edges.count() > 0
    assert labels == ["syntax", "metadata"]


def test_a_filter_on_decoded_events_reads_no_text_again(spark):
    events = spark.createDataFrame([("k", "{}", 0, None, [1], "cpg.nodes")], schemas.LOG)
    decoded = envelope.decode(events, "nodes").filter("node_id is not null and parent_id is not null")
    assert executed(decoded.select("node_id", "parent_id")).count("from_json") == 1


def test_paths_from_files_write_and_move_only_ids(spark, sf_dir, monkeypatch):
    forget(monkeypatch)
    written = {}

    def noted(df, label, rows=0):
        written.setdefault(label, []).append(df.columns)
        return stage(df, label, rows)

    monkeypatch.setattr(catalog, "stage", noted)
    monkeypatch.setattr(graph, "stage", noted)
    alone = catalog.subtree_paths(spark, sf_dir)
    assert not {"nodes", "vertices", "relations"} & set(written)
    assert written["paths"] == [["at", "nodes"]] * 2 and written["steps"] == [["at", "next"]]
    catalog.routines_graph(spark, sf_dir)
    shared = catalog.subtree_paths(spark, sf_dir)
    assert alone.count() > 0 and alone.exceptAll(shared).isEmpty() and shared.exceptAll(alone).isEmpty()


def test_paths_take_any_ids_and_no_relationship_twice(spark):
    links = [("a", "b"), ("b", "a"), ("a", "a"), ("00000000000000aa", "b")]
    relations = spark.createDataFrame([(s, d, "T") for s, d in links], "src STRING, dst STRING, type STRING")
    starts = spark.createDataFrame([("a",), ("00000000000000aa",)], "id STRING")
    found = graph.paths(starts, relations, "T", 1, 4).collect()
    expected = [[s, d] for s, d in links if s != "b"]
    paths = list(expected)
    for _ in range(3):
        paths = [p + [d] for p in paths for s, d in links if s == p[-1] and (s, d) not in list(zip(p, p[1:]))]
        expected += paths
    assert sorted(r["nodes"] for r in found) == sorted(expected)
    for r in found:
        assert [tuple(x) for x in r["rels"]] == list(zip(r["nodes"], r["nodes"][1:])) and len(r["rels"]) == r["hops"]
