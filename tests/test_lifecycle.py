"""What must hold around the queries: order, links, zones, worker state, long streams, staging."""

from __future__ import annotations

import gc
import warnings

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from treeloom import session
from treeloom.functions import envelope
from treeloom.operators import derive, discovery, flatten, reports
from treeloom.sources import eventlog, files
from treeloom.streaming import documents
from tests.helpers import source_rows


def test_paths_are_ordered_part_by_part(spark):
    rows = [(p, 1, False) for p in ("a.py", "a-b/z.py", "a/m.py", "a/b/c.py", "B.py")]
    listing = spark.createDataFrame(rows, "rel_path string, size_bytes long, excluded boolean")
    order = ["B.py", "a/b/c.py", "a/m.py", "a-b/z.py", "a.py"]
    for n in (1, 3, 5):
        assert [r.rel_path for r in files.select_targets(listing, limit=n).collect()] == order[:n]
    assert [r.rel_path for r in discovery.largest(listing, 3).collect()] == order[:3]
    assert [r.rel_path for r in discovery.first_per_flag(listing, 2).orderBy("position").collect()] == order[:2]
    assert [r.top_dir for r in discovery.top_dirs(listing).collect()] == ["a", "B.py", "a-b", "a.py"]


def test_links_are_not_followed(spark, tmp_path):
    (tmp_path / "pkg").mkdir()
    for name in ("a.py", "pkg/__init__.py", "pkg/b.py"):
        (tmp_path / name).write_text("x = 1\n")
    (tmp_path / "pkg" / "loop").symlink_to(tmp_path)
    (tmp_path / "gone.py").symlink_to(tmp_path / "nowhere")
    found = files.discover(spark, str(tmp_path)).orderBy("rel_path").collect()
    assert [(r.rel_path, r.size_bytes) for r in found] == [("a.py", 6), ("pkg/__init__.py", 6), ("pkg/b.py", 6)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_event_time_is_the_instant(spark, zone):
    micros = [1710037800000000, 1710037799999999, -1, 0, 951827696000001, 1730610000123456]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(m,) for m in micros], "m long")
        got = rows.select(envelope.iso_time(F.timestamp_micros("m")).alias("t")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.t for r in got] == [
        "2024-03-10T02:30:00.000000+00:00", "2024-03-10T02:29:59.999999+00:00",
        "1969-12-31T23:59:59.999999+00:00", "1970-01-01T00:00:00.000000+00:00",
        "2000-02-29T12:34:56.000001+00:00", "2024-11-03T05:00:00.123456+00:00",
    ]


def test_a_worker_is_left_as_it_was():
    batch = pa.RecordBatch.from_pylist(
        [{n: None for n in flatten._INPUT} | {"unit": i, "file_path": "p", "text": "x = 1\n" * 9} for i in range(4000)]
    )
    before = list(warnings.filters)
    parsing = flatten._flatten_batches(iter([batch, batch]))
    next(parsing)
    assert not gc.isenabled()
    parsing.close()
    assert gc.isenabled() and warnings.filters == before


def test_control_flow_needs_no_shuffle(spark, capsys):
    derive.cfg_edges(flatten.flatten(source_rows(spark, {"a.py": "x = 1\ny = 2\n"}))).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_all_batches_of_a_long_stream_are_reported(spark, tmp_path):
    batches = 104
    events = spark.range(0, batches, 1, batches).select(
        F.lit("k").alias("key"), F.lit("{}").alias("value"), F.lit(0).alias("partition"),
        F.timestamp_micros("id").alias("timestamp"), F.array("id").alias("position"),
        F.lit("cpg.metadata").alias("topic"),
    )
    eventlog.append(events, str(tmp_path / "log"))
    stream = eventlog.stream(spark, str(tmp_path / "log"), "metadata", max_files_per_trigger=1)
    with reports.ProgressLog(spark) as log:
        documents.write_documents(stream, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    seen = reports.stream_progress(spark, [p for p in log.progress if p.numInputRows]).collect()
    assert [r.batch_id for r in seen] == list(range(len(seen))) and sum(r.input_rows for r in seen) == batches
    assert len(seen) > 100


def test_staging_is_in_a_shared_folder_and_can_be_cleared(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert session.staging_root(spark).startswith(f"{shared}/")
    filesystem, root = session.hadoop_path(spark, session.staging_root(spark))
    assert filesystem.exists(root)
    path = session.staging_path(spark, "one")
    spark.range(1).write.parquet(path)
    assert session.hadoop_path(spark, path)[0].exists(session.hadoop_path(spark, path)[1])
