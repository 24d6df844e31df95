"""Merging, stubs, paths and reports on small events."""

from pyspark.sql import functions as F, types as T

from tests.helpers import ident, parse
from treeloom import schemas
from treeloom.functions import envelope, ids, measures, paths
from treeloom.operators import graph, reports, upsert
from treeloom.sources import eventlog


def decoded(parsed, moment):
    events = parsed.events(F.to_timestamp(F.lit(moment + "+00:00")))
    pick = lambda kind: envelope.decode(
        events.filter(F.col("topic") == envelope.TOPIC[kind]), kind
    )
    return pick("nodes"), pick("edges")


def test_graph_of_colliding_nodes(spark):
    nodes, edges = decoded(parse(spark, {"r/a.py": "a.b.c\nf()\n"}), "2024-01-01 00:00:00")
    vertices, relations = graph.build_graph(nodes, edges)
    by_id = {r.id: r for r in vertices.collect()}
    shared = ident("r/a.py", 1, 0, "Attribute")
    # The inner attribute came later: its name and its parent, itself, stay.
    assert (by_id[shared].name, by_id[shared].parent_id) == ("b", shared)
    loops = relations.filter("type = 'PARENT_OF' and src = dst").collect()
    assert [r.src for r in loops] == [shared]
    module = by_id[ident("r/a.py", 0, 0, "Module")]
    assert module.node_type is None and module.event_time is None
    assert vertices.filter("node_type is null").count() == 1
    assert set(r.id for r in vertices.collect()) >= {
        e for r in relations.collect() for e in (r.src, r.dst)
    }


def test_later_null_overwrites(spark):
    rows = [("k", "old", [1]), ("k", None, [2]), ("j", "only", [1]), ("k", "older", [0, 9])]
    df = spark.createDataFrame(rows, "id string, name string, position array<bigint>")
    got = {r.id: r.name for r in upsert.latest(df, ["id"]).collect()}
    assert got == {"k": None, "j": "only"}


def test_replay_changes_no_counts(spark):
    texts = {"r/a.py": "def f(x):\n    y = x\n    return f(y)\n", "r/b.py": "z = 1\nprint(z)\n"}
    parsed = parse(spark, texts)
    once = graph.build_graph(*decoded(parsed, "2024-01-01 00:00:00"))
    first, second = decoded(parsed, "2024-01-01 00:00:00"), decoded(parsed, "2024-01-02 00:00:00")
    twice = graph.build_graph(*[a.unionByName(b) for a, b in zip(first, second)])
    for one, two in zip(once, twice):
        drop = lambda df: sorted(map(str, df.drop("event_time").collect()))
        assert drop(one) == drop(two)
    assert {r.event_time[:10] for r in twice[0].filter("node_type is not null").collect()} == {"2024-01-02"}


def test_old_elements_stay(spark):
    before = decoded(parse(spark, {"r/a.py": "x = 1\n"}), "2024-01-01 00:00:00")
    after = decoded(parse(spark, {"r/a.py": "\nx = 1\n"}), "2024-01-02 00:00:00")
    vertices, relations = graph.build_graph(*[a.unionByName(b) for a, b in zip(before, after)])
    assert vertices.count() == 3 + 3 + 1
    assert relations.filter("type = 'CFG'").count() == 2


def test_paths_use_no_relationship_twice(spark):
    rows = [("a", "b", "T"), ("b", "a", "T"), ("a", "a", "T"), ("b", "c", "U")]
    relations = spark.createDataFrame(rows, "src string, dst string, type string")
    starts = spark.createDataFrame([("a",)], "id string")
    found = graph.paths(starts, relations, "T", 1, 4)
    got = sorted("".join(r.nodes) for r in found.collect())
    assert got == sorted(["ab", "aa", "aba", "aab", "abaa", "aaba"])
    assert sorted("".join(r.nodes) for r in graph.paths(starts, relations, "T", 3, 3).collect()) == [
        "aaba",
        "abaa",
    ]


def test_unknown_types_leave_only_ends(spark):
    rows = [("e", "s", "t", "OTHER", "f", {}, "2024", [1])]
    edges = spark.createDataFrame(
        rows,
        "edge_id string, source_id string, target_id string, edge_type string, file_path string,"
        " attrs map<string,string>, event_time string, position array<bigint>",
    )
    fields = [*schemas.EVENT["nodes"].fields, schemas.POSITION]
    nodes = spark.createDataFrame([], T.StructType(fields))
    vertices, relations = graph.build_graph(nodes, edges)
    assert sorted(r.id for r in vertices.collect()) == ["s", "t"]
    assert relations.count() == 0


def test_empty_topics_are_counted(spark):
    log = spark.createDataFrame([], schemas.LOG)
    got = {r.topic: (r.partitions, r.messages) for r in reports.topic_counts(log).collect()}
    assert got == {
        "cpg.nodes": (3, 0),
        "cpg.edges": (3, 0),
        "cpg.metadata": (1, 0),
        "cpg.errors": (1, 0),
        "TOTAL": (8, 0),
    }


def test_published_lag(spark):
    ends = spark.createDataFrame([(0, 153518), (1, 153504), (2, 152677)], "partition int, log_end bigint")
    seen = spark.createDataFrame([(0, 46008), (1, 48858), (2, 49512)], "partition int, current_offset bigint")
    got = {r.partition: r for r in reports.consumer_lag(ends, seen).collect()}
    assert [got[p].lag for p in (0, 1, 2)] == [107510, 104646, 103165]
    assert (got[None].current_offset, got[None].log_end) == (144378, 459699)
    assert got[None].progress == 31.4


def test_broker_offsets(spark):
    class Source:
        endOffset = '{"cpg.nodes":{"0":46008,"1":48858}}'
        latestOffset = '{"cpg.nodes":{"0":153518,"1":153504}}'

    class Progress:
        sources = [Source]

    offsets = reports.broker_offsets(spark, [None, Progress], "cpg.nodes")
    lag = reports.consumer_lag(offsets.select("partition", "log_end"), offsets.drop("log_end"))
    assert {r.partition: r.lag for r in lag.collect()} == {0: 107510, 1: 104646, None: 212156}


def test_first_samples(spark):
    parsed = parse(spark, {"r/a.py": "x = 1\ndef f():\n    return x\nf()\n", "r/b.py": "y\n"})
    got = {r.file_path: r for r in reports.samples(parsed.nodes, parsed.edges).collect()}
    assert (got["r/a.py"].node.node_type, got["r/a.py"].node.name) == ("FunctionDef", "f")
    assert got["r/a.py"].call_edge.attrs == {"callee_name": "f"}
    assert got["r/b.py"].node.node_type == "Expr"
    assert got["r/b.py"].cfg_edge is not None and got["r/b.py"].dfg_edge is None


def test_labels(spark):
    rows = [(10, 39), (10, 40), (150, 50), (500, 100), (0, 0)]
    df = spark.createDataFrame(rows, "n bigint, e bigint")
    got = [r[0] for r in df.select(measures.complexity(F.col("n"), F.col("e"))).collect()]
    assert got == ["very low", "low", "medium", "high", "very low"]
    text = spark.createDataFrame([("x" * 64,), ("y" + "x" * 64,)], "s string")
    short = [r[0] for r in text.select(paths.shorten(F.col("s"), 64, 61)).collect()]
    assert short == ["x" * 64, "..." + "x" * 61]
    zero = spark.range(1).select(measures.ratio(F.lit(1), F.lit(0)), measures.percent(F.lit(1), F.lit(3)))
    assert tuple(zero.first()) == (None, 33.3)


def test_events_of_one_key_share_a_partition(spark):
    parsed = parse(spark, {"r/a.py": "a.b.c\n" * 20})
    events = parsed.events(F.to_timestamp(F.lit("2024-01-01 00:00:00+00:00")))
    keyed = events.groupBy("topic", "key").agg(F.count_distinct("partition").alias("n"))
    assert keyed.agg(F.max("n")).first()[0] == 1
    no_key = eventlog.to_events(
        spark.createDataFrame([("", "io_error", "m")], schemas.ERROR), "errors", F.current_timestamp()
    )
    assert no_key.first().key is None


def test_packed_ids_come_back_whatever_they_are(spark):
    texts = ["0123456789abcdef", "ffffffffffffffff", "0123456789ABCDEF", "0123456789abcde", "0123456789abcdeg", "", "c1", "0", "é" * 8, "x" * 40, None]
    rows = spark.createDataFrame([(t,) for t in texts], "id STRING")
    found = rows.select("id", ids.pack(F.col("id")).alias("p")).select("id", F.octet_length("p").alias("n"), ids.unpack(F.col("p")).alias("back")).collect()
    assert [r["back"] for r in found] == texts
    assert [r["n"] for r in found][:3] == [8, 8, 25]
    assert len({r["n"] == 8 for r in found[2:]}) == 1
