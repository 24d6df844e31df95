"""Streams over a file log: draining, resuming, upserting."""

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from tests.helpers import parse
from treeloom import schemas
from treeloom.operators import graph, upsert
from treeloom.plans.batch import parse as parse_rows
from treeloom.sources import eventlog
from treeloom.streaming import documents, graphs

FIRST = {"r/a.py": "x = 1\n", "r/b.py": "def f():\n    return f()\n", "r/c.py": "(("}


def instant(text):
    return F.to_timestamp(F.lit(text + "+00:00"))


@pytest.fixture()
def log(spark, tmp_path):
    path = str(tmp_path / "log")
    eventlog.append(parse(spark, FIRST).events(instant("2024-01-01 00:00:00")), path)
    return path


def drain(spark, log, tmp_path, **options):
    query = documents.write_documents(
        eventlog.stream(spark, log, "metadata"),
        str(tmp_path / "documents"),
        str(tmp_path / "checkpoint"),
        **options,
    )
    query.awaitTermination()
    return [(p.batchId, p.numInputRows) for p in query.recentProgress if p.numInputRows]


def test_resume_after_a_change(spark, log, tmp_path):
    assert drain(spark, log, tmp_path) == [(0, 2)]
    table = str(tmp_path / "documents")
    before = documents.document(spark, table, "r/a.py").first()

    changed = parse(spark, {"r/a.py": "x = 1\n# more\n"})
    eventlog.append(changed.events(instant("2024-01-02 00:00:00")), log)
    assert drain(spark, log, tmp_path) == [(1, 1)]
    after = documents.document(spark, table, "r/a.py").first()
    assert documents.documents(spark, table).count() == 2
    assert after.file_hash != before.file_hash and after["loc"] == before["loc"] + 1
    assert documents.documents(spark, table).schema.names == schemas.DOCUMENT.names

    # Nothing new: nothing read.
    assert drain(spark, log, tmp_path) == []


def test_batch_that_runs_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([("a", "v1", [1])], "id string, v string, position array<bigint>")
    for _ in range(2):
        upsert.write_changes(one, path, "feed", 0)
    schema = schemas.T.StructType(one.schema.fields[:2])
    assert upsert.read_changes(spark, path, schema).count() == 1
    upsert.write_changes(one.withColumn("v", F.lit("v2")).withColumn("position", F.array(F.lit(2).cast("long"))), path, "feed", 1)
    assert [r.v for r in upsert.read_latest(spark, path, schema, ["id"]).collect()] == ["v2"]
    upsert.fold(spark, path, schema, ["id"])
    assert [r.v for r in upsert.read_changes(spark, path, schema).collect()] == ["v2"]


def test_snapshots_change_nothing_for_readers(spark, tmp_path):
    path, schema = str(tmp_path / "t"), schemas.T.StructType([schemas.T.StructField(n, schemas.T.StringType()) for n in ("id", "v")])
    want, opened = {}, []
    for b in range(9):
        rows = [(f"k{(b * 7 + i) % 20}" if i else None, f"v{b}", [b]) for i in range(5)]
        want |= {k: v for k, v, _ in rows}
        batch = spark.createDataFrame(rows, "id string, v string, position array<bigint>")
        upsert.write_changes(batch, path, f"feed{b % 2}", b)
        opened.append((dict(want), upsert.read_latest(spark, path, schema, ["id"])))
        upsert.fold_at_times(spark, path, schema, ["id"], b, 3)
        assert {r.id: r.v for r in upsert.read_latest(spark, path, schema, ["id"]).collect()} == want
        # A reader that began before the last fold still reads what it saw.
        seen, table = opened[max(0, b - 2)]
        assert {r.id: r.v for r in table.collect()} == seen
    assert len(upsert._changes(spark, path, {})) < 9
    for key in ("k3", "k11", None):
        one = upsert.read_changes(spark, path, schema, {"id": key})
        assert [r.v for r in upsert.latest(one, ["id"]).collect()] == [want[key]]
        assert len(one.inputFiles()) <= 2 * (1 + len(upsert._changes(spark, path, upsert._snapshot(spark, path)[1])))
    # A batch that runs again, also after it was folded, adds nothing.
    before = len(upsert._changes(spark, path, upsert._snapshot(spark, path)[1]))
    upsert.write_changes(batch.withColumn("v", F.lit("other")), path, "feed0", 8)
    assert len(upsert._changes(spark, path, upsert._snapshot(spark, path)[1])) == before
    assert {r.id: r.v for r in upsert.read_latest(spark, path, schema, ["id"]).collect()} == want


def test_streams_fold_as_they_go(spark, log, tmp_path):
    for day in range(2, 7):
        changed = parse(spark, {"r/a.py": "x = 1\n" + "# more\n" * day})
        eventlog.append(changed.events(instant(f"2024-01-0{day} 00:00:00")), log)
        drain(spark, log, tmp_path, fold_every=2)
    table = str(tmp_path / "documents")
    assert upsert._snapshot(spark, table)[0] >= 2
    assert documents.documents(spark, table).count() == 2
    assert documents.document(spark, table, "r/a.py").first()["loc"] == 8


def test_events_that_are_not_json(spark, log, tmp_path):
    bad = spark.createDataFrame(
        [("k", "not json", 0, None, [0], "cpg.metadata")], schemas.LOG
    )
    eventlog.append(bad, log)
    drain(spark, log, tmp_path, rejects=str(tmp_path / "rejects"))
    table = documents.documents(spark, str(tmp_path / "documents"))
    assert sorted(r["_id"] for r in table.collect()) == ["r/a.py", "r/b.py"]
    rejected = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "rejects"))
    assert [r.value for r in rejected.collect()] == ["not json"]


def test_streamed_graph_equals_batch_graph(spark, log, tmp_path):
    store = str(tmp_path / "graph")
    for run in range(2):
        for kind, write in (("edges", graphs.write_edges), ("nodes", graphs.write_nodes)):
            stream = eventlog.stream(spark, log, kind, max_files_per_trigger=1)
            write(stream, store, str(tmp_path / f"checkpoint-{kind}")).awaitTermination()
        if run == 0:
            again = parse(spark, {"r/b.py": FIRST["r/b.py"], "r/d.py": "from r import b\nb.f()\n"})
            eventlog.append(again.events(instant("2024-01-03 00:00:00")), log)
    from treeloom.functions import envelope

    want = graph.build_graph(
        *[envelope.decode(eventlog.read(spark, log, k), k) for k in ("nodes", "edges")]
    )
    for got, expected in zip(graphs.read_graph(spark, store), want):
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_graph_before_the_node_stream(spark, log, tmp_path):
    store = str(tmp_path / "graph")
    stream = eventlog.stream(spark, log, "edges")
    graphs.write_edges(stream, store, str(tmp_path / "checkpoint")).awaitTermination()
    vertices, relations = graphs.read_graph(spark, store)
    assert vertices.filter("node_type is not null").count() == 0
    ends = {i for r in relations.collect() for i in (r.src, r.dst)}
    assert {r.id for r in vertices.collect()} == ends


def test_long_lived_trigger(spark, log, tmp_path):
    query = documents.write_documents(
        eventlog.stream(spark, log, "metadata"),
        str(tmp_path / "documents"),
        str(tmp_path / "checkpoint"),
        continuous=True,
    )
    try:
        query.processAllAvailable()
        assert query.isActive
        assert documents.documents(spark, str(tmp_path / "documents")).count() == 2
    finally:
        query.stop()


def test_broker_needs_its_package(spark, log):
    with pytest.raises(Exception, match="kafka"):
        eventlog.stream_broker(spark, "localhost:1", "metadata")
    with pytest.raises(Exception, match="mongodb"):
        documents.write_documents_to_store(
            eventlog.stream(spark, log, "metadata"), log + "-checkpoint", {}
        )


def test_events_of_a_log_are_not_sorted_by_topic(spark, tmp_path, monkeypatch):
    """Only rows of topics the log does not know go through a write that deals them to folders."""
    dealt, deal = [], DataFrameWriter.partitionBy
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda self, *c: dealt.append(self._df.count()) or deal(self, *c))
    events = parse(spark, {"r/a.py": "x = f(1)\n", "r/b.py": "def f(:\n"}).events(instant("2024-01-01 00:00:00"))
    other = events.limit(1).withColumn("topic", F.lit("other"))
    path = str(tmp_path / "sorted-log")
    eventlog.append(events, path)
    eventlog.append(other, path)
    assert dealt == [0, 1]
    got = eventlog.read_all(spark, path).groupBy("topic").count().collect()
    want = events.unionByName(other).groupBy("topic").count().collect()
    assert sorted(got) == sorted(want) and len(got) == 5
