"""Buckets of snapshots: their size, what a fold rewrites, and what is kept."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import parse
from treeloom import schemas
from treeloom.operators import upsert
from treeloom.plans import batch
from treeloom.session import hadoop_path, staging_root
from treeloom.sources import eventlog
from treeloom.streaming import graphs

SCHEMA = schemas._struct("k STRING, v BIGINT")
SMALL = 40


def add(spark, path, number, low, high, value):
    rows = spark.range(low, high, numPartitions=2).select(
        F.concat(F.lit("k"), "id").alias("k"), F.lit(value).cast("long").alias("v"), F.array(F.lit(number).cast("long")).alias("position")
    )
    upsert.write_changes(rows, path, "feed", number)
    upsert.fold(spark, path, SCHEMA, ["k"], SMALL)


def content(spark, path):
    return {r.k: r.v for r in upsert.read_latest(spark, path, SCHEMA, ["k"]).collect()}


def test_buckets_split_as_the_table_grows(spark, tmp_path):
    path = str(tmp_path / "t")
    for number, high in enumerate((100, 1_000, 2_000)):
        add(spark, path, number, 0, high, number)
        _, _, buckets = upsert._snapshot(spark, path)
        assert sum(b.rows for b in buckets) == high and max(b.rows for b in buckets) <= 2 * SMALL
        # Hashes scatter: a part of a split may get more than its share. The buckets cover all hashes once.
        assert sum(2 ** (64 - b.bits) for b in buckets) == 2**64
    assert content(spark, path) == {f"k{i}": 2 for i in range(2_000)}
    one = upsert.read_changes(spark, path, SCHEMA, {"k": "k1234"})
    assert [r.v for r in one.collect()] == [2] and len(one.inputFiles()) == 1


def test_a_fold_rewrites_only_buckets_with_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    add(spark, path, 0, 0, 500, 0)
    before = upsert._snapshot(spark, path)[2]
    add(spark, path, 1, 7, 8, 1)
    after = upsert._snapshot(spark, path)[2]
    assert len(set(before) - set(after)) == 1 and {b.version for b in set(after) - set(before)} == {2}
    assert len(spark.read.parquet(f"{path}/snapshots/version=2").inputFiles()) == 1
    for number in range(2, 5):
        add(spark, path, number, 7, 8, number)
    # Buckets of the first version live on, and what was replaced is gone but for the last two versions.
    assert content(spark, path) == {f"k{i}": 0 for i in range(500)} | {"k7": 4}
    assert {b.version for b in upsert._snapshot(spark, path)[2]} == {1, 5}
    assert upsert._folders(spark, f"{path}/layout", "version=") == ["4", "5"]
    assert upsert._folders(spark, f"{path}/snapshots", "version=") == ["1", "4", "5"]


def test_buckets_of_different_depth(spark, tmp_path):
    """Changes that fall into one bucket split that one alone."""
    path = str(tmp_path / "t")
    add(spark, path, 0, 0, 120, 0)
    half = spark.range(120, 5_000).select(F.concat(F.lit("k"), "id").alias("k"), "id").filter(F.shiftrightunsigned(F.xxhash64("k"), 60) == 3)
    rows = half.select("k", F.lit(9).cast("long").alias("v"), F.array(F.lit(1).cast("long")).alias("position"))
    upsert.write_changes(rows, path, "feed", 1)
    upsert.fold(spark, path, SCHEMA, ["k"], SMALL)
    buckets = upsert._snapshot(spark, path)[2]
    assert len({b.bits for b in buckets}) > 1 and sum(2 ** (64 - b.bits) for b in buckets) == 2**64
    added = {r.k for r in half.collect()}
    assert content(spark, path) == {f"k{i}": 0 for i in range(120)} | dict.fromkeys(added, 9)
    for key in (min(added), "k5", "missing"):
        got = [r.v for r in upsert.read_changes(spark, path, SCHEMA, {"k": key}).collect()]
        assert got == ([9] if key in added else [0] if key == "k5" else [])
    add(spark, path, 2, 0, 5_000, 2)
    assert set(content(spark, path).values()) == {2} and len(content(spark, path)) == 5_000


def test_empty_changes_fold_to_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    add(spark, path, 0, 0, 0, 0)
    assert content(spark, path) == {} and upsert._snapshot(spark, path)[0] == 1
    add(spark, path, 1, 0, 3, 1)
    assert content(spark, path) == {"k0": 1, "k1": 1, "k2": 1}


@pytest.mark.parametrize("fold_every", [1, 2, 100])
def test_manifest_folds_runs_in_any_order(spark, tmp_path, fold_every):
    path, want = str(tmp_path / "m"), {}
    for run in (5, 3, 9, 3, 1, 7):
        rows = [(f"f{run % 4}.py", f"hash{run}", 1, 1, run / 1_000_000), (f"own{run}.py", "h", 1, 1, run / 1_000_000)]
        batch.save_manifest(spark.createDataFrame(rows, schemas.MANIFEST), path, run, fold_every)
        for name, digest, *_, at in rows:
            if name not in want or want[name][1] <= at:
                want[name] = (digest, at)
        kept = batch.load_manifest(spark, path).collect()
        assert {r.rel_path: (r.file_hash, r.last_processed) for r in kept} == want
    folded = upsert._snapshot(spark, path)[0]
    assert folded == {1: 5, 2: 2, 100: 0}[fold_every]  # the run that is saved again adds nothing
    if fold_every == 1:  # folders of runs that snapshots hold are deleted
        assert len(upsert._folders(spark, path, "feed=")) <= 2


def test_vertices_are_read_without_relations(spark, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    events = parse(spark, {"r/a.py": "def f(x):\n    return g(x)\n", "r/b.py": "y = f(1)\n"})
    eventlog.append(events.events(F.to_timestamp(F.lit("2024-01-01 00:00:00+00:00"))), log)
    for write, kind in ((graphs.write_nodes, "nodes"), (graphs.write_edges, "edges")):
        write(eventlog.stream(spark, log, kind), store, str(tmp_path / kind), fold_every=1).awaitTermination()
    vertices, relations = graphs.read_graph(spark, store)
    ends = {r.id for r in relations.select(F.explode(F.array("src", "dst")).alias("id")).collect()}
    assert ends <= {r.id for r in vertices.collect()}
    assert not [f for f in vertices.inputFiles() if "/relations/" in f or "/parents/" in f]
    filesystem, gone = hadoop_path(spark, f"{store}/relations/snapshots")
    assert filesystem.exists(gone)


def test_a_large_table_folds_once_its_changes_are_as_large(spark, tmp_path, monkeypatch):
    """Batches of one size double the table between folds, so folds do not rewrite it each time."""
    monkeypatch.setattr(upsert, "FOLD_BYTES", 0)
    path, versions = str(tmp_path / "t"), []
    for number in range(8):
        rows = spark.range(200 * number, 200 * (number + 1), numPartitions=1).select(
            F.concat(F.lit("k"), "id").alias("k"), F.lit(number).cast("long").alias("v"), F.array(F.lit(number).cast("long")).alias("position")
        )
        upsert.write_changes(rows, path, "feed", number)
        upsert.fold_at_times(spark, path, SCHEMA, ["k"], number, 1)
        versions.append(upsert._snapshot(spark, path)[0])
        assert content(spark, path) == {f"k{i}": i // 200 for i in range(200 * (number + 1))}
    assert versions[0] == 1 and 2 <= versions[-1] < 6


def test_decoded_batches_are_deleted(spark, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    events = parse(spark, {"r/a.py": "def f(x):\n    return g(x)\n"})
    eventlog.append(events.events(F.to_timestamp(F.lit("2024-01-01 00:00:00+00:00"))), log)
    for write, kind in ((graphs.write_nodes, "nodes"), (graphs.write_edges, "edges")):
        before = set(upsert._folders(spark, staging_root(spark), "batch-"))
        write(eventlog.stream(spark, log, kind), store, str(tmp_path / kind)).awaitTermination()
        assert set(upsert._folders(spark, staging_root(spark), "batch-")) <= before
    assert graphs.read_graph(spark, store)[0].count() > 0
