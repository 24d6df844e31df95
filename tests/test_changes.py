"""Runs that parse what changed, graphs of current versions, errors that close, feeds that share a table."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from tests.helpers import parse, source_rows
from treeloom import schemas
from treeloom.functions import envelope
from treeloom.operators import changes, graph, upsert
from treeloom.plans import batch
from treeloom.session import hadoop_path
from treeloom.sources import eventlog, files
from treeloom.streaming import documents, errors


def instant(text):
    return F.to_timestamp(F.lit(text + "+00:00"))


def run(spark, root, tmp_path, day, **options):
    listing = files.discover(spark, str(root))
    return batch.run(
        spark, listing, str(root), "r", str(tmp_path / "log"), str(tmp_path / "manifest"),
        event_time=instant(f"2024-01-0{day} 00:00:00"), **options,
    ).first()


def test_only_what_changed_is_parsed(spark, tmp_path):
    root = tmp_path / "tree"
    root.mkdir()
    texts = {"a.py": b"x = 1\n", "b.py": b"y = 2\n", "bad.py": b"((", "latin.py": b"\xff"}
    for name, text in texts.items():
        (root / name).write_bytes(text)
    first = run(spark, root, tmp_path, 1, changed_only=True)
    assert (first.files_ok, first.files_failed) == (2, 2)
    (root / "a.py").write_bytes(b"x = 1\r\n")  # the same text with other line ends
    (root / "b.py").write_bytes(b"y = 3\n")
    (root / "new.py").write_bytes(b"")
    second = run(spark, root, tmp_path, 2, changed_only=True)
    assert (second.files_ok, second.files_failed) == (2, 2)  # b and new; what failed is tried again
    saved = {r.rel_path: r.last_processed for r in batch.load_manifest(spark, str(tmp_path / "manifest")).collect()}
    assert saved == {"a.py": 1704067200.0, "b.py": 1704153600.0, "new.py": 1704153600.0}
    assert run(spark, root, tmp_path, 3, single_file="a.py", changed_only=True).files_ok == 1
    with pytest.raises(ValueError):
        batch.run(spark, files.discover(spark, str(root)), str(root), "r", str(tmp_path / "log"), changed_only=True)


def test_hashes_are_those_of_parsing(spark):
    texts = {"r/a.py": "x = 1\r\ny\r", "r/b.py": "", "r/é.py": "é = 1"}
    found = changes.file_hashes(source_rows(spark, texts), "r").collect()
    noted = parse(spark, texts).metadata.collect()
    assert {f"r/{x.rel_path}": x.file_hash for x in found} == {x.file_path: x.file_hash for x in noted}


def test_only_the_last_version_is_current(spark):
    first = parse(spark, {"r/a.py": "def f():\n    pass\nf()\n", "r/b.py": "b = 1\n", "r/c.py": "c = 1\n"})
    second = parse(spark, {"r/a.py": "x = 1\n", "r/c.py": "(("})
    events = first.events(instant("2024-01-01 00:00:00")).unionByName(second.events(instant("2024-01-02 00:00:00")))
    of = {k: envelope.decode(events.filter(F.col("topic") == envelope.TOPIC[k]), k) for k in ("nodes", "edges", "metadata")}
    vertices, relations = graph.build_graph(of["nodes"], of["edges"])
    docs = upsert.latest(of["metadata"].withColumnRenamed("file_path", "_id"), ["_id"])
    now, linked = graph.current_only(of["nodes"], vertices, relations, docs)
    alone = parse(spark, {"r/a.py": "x = 1\n", "r/b.py": "b = 1\n", "r/c.py": "c = 1\n"})
    want_vertices, want_relations = graph.build_graph(
        *[
            envelope.decode(alone.events(instant("2024-01-02 00:00:00")).filter(F.col("topic") == envelope.TOPIC[k]), k)
            for k in ("nodes", "edges")
        ]
    )
    pick = ("id", "file_path", "node_type", "name", "lineno", "parent_id")
    assert sorted(map(repr, now.select(*pick).collect())) == sorted(map(repr, want_vertices.select(*pick).collect()))
    pick = ("src", "dst", "type", "edge_id")
    assert sorted(map(repr, linked.select(*pick).collect())) == sorted(map(repr, want_relations.select(*pick).collect()))
    assert vertices.count() > now.count()


def test_errors_close_and_open_again(spark, tmp_path):
    log, table, target = (str(tmp_path / n) for n in ("log", "errors", "documents"))
    seen = []
    for day, texts in enumerate([{"r/a.py": "((", "r/b.py": "(("}, {"r/a.py": "a = 1"}, {"r/a.py": "))"}], 1):
        eventlog.create_topics(spark, log)
        eventlog.append(parse(spark, texts).events(instant(f"2024-01-0{day} 00:00:00")), log)
        for query in (
            errors.write_errors(eventlog.stream(spark, log, "errors"), table, str(tmp_path / "c1"), fold_every=1),
            documents.write_documents(eventlog.stream(spark, log, "metadata"), target, str(tmp_path / "c2")),
        ):
            query.awaitTermination()
        rows = errors.errors(spark, table, target).collect()
        seen.append({r.file_path: r.closed_time and r.closed_time[:10] for r in rows})
    assert seen == [
        {"r/a.py": None, "r/b.py": None}, {"r/a.py": "2024-01-02", "r/b.py": None}, {"r/a.py": None, "r/b.py": None}
    ]
    assert {r.file_path for r in errors.open_errors(spark, table, target).collect()} == {"r/a.py", "r/b.py"}


def test_events_without_a_file_are_set_aside(spark, tmp_path):
    log = str(tmp_path / "log")
    eventlog.create_topics(spark, log)
    row = [(None, "no json", 0, None, [1, 2], envelope.TOPIC["errors"])]
    eventlog.append(spark.createDataFrame(row, schemas.LOG), log)
    errors.write_errors(eventlog.stream(spark, log, "errors"), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert errors.errors(spark, str(tmp_path / "t"), str(tmp_path / "d")).count() == 0
    assert spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "t/rejects")).first().value == "no json"


KEYED = "k string, v long, position array<bigint>"


def test_feeds_fold_one_table_at_once(spark, tmp_path):
    path, schema = str(tmp_path / "table"), schemas._struct("k STRING, v BIGINT")

    def feed(name):
        for i in range(4):
            rows = [(f"{k}", 10 * i + len(name), [i, len(name)]) for k in range(20)]
            upsert.write_changes(spark.createDataFrame(rows, KEYED), path, name, i)
            upsert.fold_at_times(spark, path, schema, ["k"], i, 1)

    running = [threading.Thread(target=feed, args=(name,)) for name in ("a", "bb")]
    for t in running:
        t.start()
    for t in running:
        t.join()
    rows = upsert.read_latest(spark, path, schema, ["k"]).collect()
    assert len(rows) == 20 and {r.v for r in rows} == {32}


def test_a_claimed_version_is_left_to_its_feed(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "table"), schemas._struct("k STRING, v BIGINT")
    upsert.write_changes(spark.createDataFrame([("x", 1, [1])], KEYED), path, "a", 0)
    assert upsert._claim(spark, path, 1) and not upsert._claim(spark, path, 1)
    upsert.fold(spark, path, schema, ["k"])
    filesystem, snapshots = hadoop_path(spark, f"{path}/snapshots")
    assert not filesystem.exists(snapshots) and upsert.read_latest(spark, path, schema, ["k"]).count() == 1
    monkeypatch.setattr(upsert, "CLAIM_AGE", -1)  # its driver was lost
    upsert.fold(spark, path, schema, ["k"])
    assert filesystem.exists(snapshots) and upsert.read_latest(spark, path, schema, ["k"]).count() == 1


def test_a_long_lived_stream_stops_after_its_input(spark, tmp_path):
    log = str(tmp_path / "log")
    eventlog.append(parse(spark, {"r/a.py": "x = 1\n"}).events(instant("2024-01-01 00:00:00")), log)
    query = documents.write_documents(
        eventlog.stream(spark, log, "metadata"), str(tmp_path / "d"), str(tmp_path / "c"), continuous=True
    )
    assert query.isActive
    documents.stop_when_idle(query)
    assert not query.isActive and query.exception() is None
    assert documents.documents(spark, str(tmp_path / "d")).first()._id == "r/a.py"


def test_offsets_order_events_of_one_time(spark):
    rows = spark.createDataFrame([("k", 0, 9, 1), ("k", 0, 10, 1), ("k", 0, 2, 1), ("m", 1, 5, 2), ("m", 2, 1, 3)],
                                 "key string, partition int, offset long, at long")
    rows = eventlog.ordered_by_offset(rows.withColumn("timestamp", F.timestamp_micros("at")))
    last = {r.key: r.offset for r in upsert.latest(rows, ["key"]).collect()}
    assert last == {"k": 10, "m": 1}


def written(tmp_path, document, **options):
    path = tmp_path / "found.json"
    path.write_text(json.dumps(document, **options))
    return str(path)


@pytest.mark.parametrize("options", [{}, {"indent": 2}, {"separators": (",", ":")}])
def test_listing_documents_are_read_in_parts(spark, tmp_path, options):
    names = ["a.py", "b}]/c.py", 'q"uo\\te.py', "é/ü.py", '"rel_path".py', "x{{y}}.py", "files/[.py"]
    rows = [{"rel_path": f"{i}/{names[i % 7]}", "size_bytes": i, "excluded": i % 3 == 0} for i in range(400)]
    want = {(r["rel_path"], r["size_bytes"], r["excluded"]) for r in rows}
    summary = {"largest_files": rows[:5], "by_top_level_dir": {"files": 3}}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        for document in ({"summary": summary, "files": rows}, {"files": rows, "summary": summary}):
            found = files.read_listing_document(spark, written(tmp_path, document, **options))
            assert {tuple(r) for r in found.collect()} == want and found.count() == len(rows)
            assert found.rdd.getNumPartitions() > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    empty = written(tmp_path, {"summary": summary, "files": []}, **options)
    assert files.read_listing_document(spark, empty).count() == 0
