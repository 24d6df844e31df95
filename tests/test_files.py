"""Discovery, reading and runs over real folders."""

import json

import pytest
from pyspark.sql import functions as F

from treeloom import schemas
from treeloom.functions import envelope
from treeloom.operators import discovery
from treeloom.plans import batch
from treeloom.sources import eventlog, files


@pytest.fixture()
def tree(tmp_path):
    root = tmp_path / "checkout"
    for path, text in {
        "setup.py": "from x import setup\nsetup()\n",
        "src/pkg/__init__.py": "x = 1\n",
        "src/pkg/_private/deep/a.py": "def f():\n    return f()\n",
        "src/pkg/latest.py": "y = 2\ny\n",
        "src/pkg/bad.py": "def (\n",
        "src/test_a.py": "t = 1\n",
        "src/b_test.py": "t = 1\n",
        "tests/util.py": "u = 1\n",
        "docs/conf.py": "c = 1\n",
        "docs/readme.md": "no code\n",
        ".git/hooks/hook.py": "h = 1\n",
        "src/test.py": "kept = 1\n",
        "my tests/spaced name.py": "s = 1\n",
    }.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_text(text)
    (root / "src/latin.py").write_bytes(b"\xff\n")
    return root


def test_discovery(spark, tree):
    found = {r.rel_path: (r.size_bytes, r.excluded) for r in files.discover(spark, str(tree)).collect()}
    want = {
        str(p.relative_to(tree)): p.stat().st_size
        for p in tree.rglob("*.py")
        if ".git" not in p.relative_to(tree).parts
    }
    assert {p: size for p, (size, _) in found.items()} == want
    assert {p for p, (_, excluded) in found.items() if excluded} == {
        "setup.py",
        "src/test_a.py",
        "src/b_test.py",
        "tests/util.py",
        "docs/conf.py",
    }


def test_summary(spark, tree, tmp_path):
    discovery.write_summary(files.discover(spark, str(tree)), str(tmp_path / "summary"))
    read = lambda part: spark.read.json(str(tmp_path / "summary" / part)).collect()
    (totals,) = read("totals")
    assert (totals.total_py_files, totals.included_files, totals.excluded_files) == (12, 7, 5)
    assert [(r.top_dir, r.files) for r in read("top_dirs")] == [
        ("src", 8), ("docs", 1), ("my tests", 1), ("setup.py", 1), ("tests", 1)
    ]
    largest = [r.rel_path for r in read("largest")]
    assert largest[:2] == ["setup.py", "src/pkg/_private/deep/a.py"] and len(largest) == 5


def test_targets(spark, tree):
    listing = files.discover(spark, str(tree))
    included = [r.rel_path for r in files.select_targets(listing).orderBy("rel_path").collect()]
    assert len(included) == 7 and "setup.py" not in included
    assert [r.rel_path for r in files.select_targets(listing, limit=2).collect()] == included[:2]
    assert files.select_targets(listing, limit=0).count() == 7
    assert files.select_targets(listing, single_file="setup.py").count() == 1
    with pytest.raises(ValueError):
        files.select_targets(listing, single_file="nowhere.py")


def test_listing_round_trips(spark, tree, tmp_path):
    listing = files.discover(spark, str(tree))
    files.write_listing(listing, str(tmp_path / "listing"))
    again = files.read_listing(spark, str(tmp_path / "listing"))
    assert again.schema == schemas.LISTING
    rows = sorted(map(tuple, listing.collect()))
    assert sorted(map(tuple, again.collect())) == rows
    document = {"summary": {}, "files": [dict(zip(schemas.LISTING.names, r)) for r in rows]}
    (tmp_path / "files.json").write_text(json.dumps(document, indent=2))
    read = files.read_listing_document(spark, str(tmp_path / "files.json"))
    assert sorted(map(tuple, read.collect())) == rows


def test_missing_file_is_an_io_error(spark, tree):
    gone = spark.createDataFrame([("src/gone.py", 1, False)], schemas.LISTING)
    parsed = batch.parse(files.read_sources(gone, str(tree), "repo"))
    error = parsed.errors.first()
    assert (error.file_path, error.error_type) == ("repo/src/gone.py", "io_error")
    assert "gone.py" in error.error_message


def test_run_logs_everything(spark, tree, tmp_path):
    listing = files.discover(spark, str(tree))
    log, manifest = str(tmp_path / "log"), str(tmp_path / "manifest")
    summary = batch.run(spark, listing, str(tree), "repo", log, manifest).first()
    assert (summary.files_ok, summary.files_failed) == (5, 2)
    by_topic = {r.topic: r["count"] for r in eventlog.read_all(spark, log).groupBy("topic").count().collect()}
    assert by_topic["cpg.nodes"] == summary.total_nodes
    assert by_topic["cpg.edges"] == summary.total_edges
    assert (by_topic["cpg.metadata"], by_topic["cpg.errors"]) == (5, 2)
    kept = {r.rel_path: r for r in batch.load_manifest(spark, manifest).collect()}
    assert set(kept) == {
        "src/pkg/__init__.py",
        "src/pkg/_private/deep/a.py",
        "src/pkg/latest.py",
        "src/test.py",
        "my tests/spaced name.py",
    }
    assert kept["src/pkg/__init__.py"].num_nodes == 3

    # A second run over one file, changed meanwhile, replaces its row only.
    (tree / "src/test.py").write_text("kept = 1\nmore = 2\n")
    again = batch.run(spark, listing, str(tree), "repo", log, manifest, single_file="src/test.py").first()
    assert (again.files_ok, again.total_nodes) == (1, 6)
    later = {r.rel_path: r for r in batch.load_manifest(spark, manifest).collect()}
    assert set(later) == set(kept)
    assert later["src/test.py"].num_nodes == 6
    assert later["src/test.py"].last_processed > kept["src/test.py"].last_processed
    assert later["src/pkg/latest.py"] == kept["src/pkg/latest.py"]


def test_messages_on_the_wire(spark, tree, tmp_path):
    listing = files.discover(spark, str(tree))
    log = str(tmp_path / "log")
    batch.run(spark, listing, str(tree), "repo", log, single_file="src/pkg/latest.py")
    node = json.loads(eventlog.read(spark, log, "nodes").orderBy("position").first().value)
    assert list(node) == [
        "schema_version", "event_time", "event_type", "node_id", "file_path", "node_type",
        "name", "lineno", "col_offset", "end_lineno", "parent_id", "_key",
    ]
    assert node["schema_version"] == "1.0" and node["event_type"] == "node"
    assert node["name"] is None and node["parent_id"] is None
    assert node["_key"] == node["node_id"]
    assert len(node["event_time"]) == 32 and node["event_time"].endswith("+00:00")
    edges = [json.loads(r.value) for r in eventlog.read(spark, log, "edges").collect()]
    assert {e["edge_type"]: e["attrs"] for e in edges} == {"CFG": {}, "DFG": {"var": "y"}}
    metadata = json.loads(eventlog.read(spark, log, "metadata").first().value)
    assert metadata["_key"] == metadata["file_path"] == "repo/src/pkg/latest.py"
    assert eventlog.read(spark, log, "errors").count() == 0
    decoded = envelope.decode(eventlog.read(spark, log, "metadata"), "metadata").first()
    assert decoded.num_nodes == metadata["num_nodes"] and "_key" not in decoded.asDict()


def test_rows_spread_before_their_texts_are_built(spark):
    """What moves between tasks are the table's columns, not the longer texts made of them."""
    rows = spark.range(3).withColumn("other", F.lit("not needed"))
    made = files.sources_from_text(rows, F.concat("id", F.lit(".py")), F.repeat(F.lit("x = 1\n"), F.col("id").cast("int")), 2)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Project") and "Repartition" in plan
    assert {r.file_path: bytes(r.content) for r in made.collect()} == {f"{i}.py": b"x = 1\n" * i for i in range(3)}
