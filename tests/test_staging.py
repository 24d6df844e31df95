"""How much of a staged table one task reads, and which tables a query computes."""

from pyspark.sql import functions as F

from tests.helpers import source_rows
from treeloom.plans import batch
from treeloom.session import stage
from workloads import catalog


def rows_of_files(df):
    return [r["n"] for r in df.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]


def test_files_of_a_staged_table_are_bounded(spark):
    rows = stage(spark.range(0, 95, 1, 1), "bounded", 10)
    assert sorted(rows_of_files(rows)) == [5] + [10] * 9
    assert rows_of_files(stage(spark.range(0, 95, 1, 1), "whole")) == [95]


def test_a_run_bounds_the_files_that_its_steps_read(spark, monkeypatch):
    monkeypatch.setattr(batch, "ROWS_PER_FILE", 7)
    text = "x = 1\n" + "x = x + 1\n" * 20
    parsed = batch.parse(source_rows(spark, {f"repo/{i}.py": text for i in range(3)}))
    for df in (parsed.nodes, parsed.edges):
        assert max(rows_of_files(df)) <= 7
    assert parsed.nodes.count() == 3 * (3 + 20 * 5)


def test_a_query_on_vertices_computes_no_relations(spark, sf_dir):
    before = dict(catalog._shared)
    catalog._shared.clear()
    try:
        found = catalog.named_definitions(spark, sf_dir).count()
        held = {what for _, _, what in catalog._shared}
        assert found == 8 and "vertices" in held and "relations" not in held
        assert catalog.relationships(spark, sf_dir).count() > 0
        assert "relations" in {what for _, _, what in catalog._shared}
    finally:
        catalog._shared.update(before)


def test_measures_of_files_write_no_edges(spark, sf_dir):
    before = dict(catalog._shared)
    catalog._shared.clear()
    try:
        alone = catalog.file_metadata_calls(spark, sf_dir)
        plan = alone._jdf.queryExecution().optimizedPlan().toString()
        assert not any(what.startswith("edges-") for _, _, what in catalog._shared) and "sha2" not in plan
        catalog.edges(spark, sf_dir, "routines")
        again = catalog.file_metadata_calls(spark, sf_dir)
        assert sorted(alone.collect()) == sorted(again.collect())
    finally:
        catalog._shared.update(before)


def test_the_report_writes_only_what_it_counts_of_the_graph(spark, sf_dir, monkeypatch):
    before, written = dict(catalog._shared), {}
    catalog._shared.clear()

    def noted(df, label, rows_per_file=0):
        written.setdefault(label, []).append(df.columns)
        return stage(df, label, rows_per_file)

    monkeypatch.setattr(catalog, "stage", noted)
    try:
        alone = catalog.report_dataset(spark, sf_dir).collect()
        assert "relations" not in written and written["vertices"] == [["file_path", "node_type"]]
        assert len(written["metadata"]) == 1
        catalog.routines_graph(spark, sf_dir)
        again = catalog.report_dataset(spark, sf_dir).collect()
        assert sorted(map(str, alone)) == sorted(map(str, again))
    finally:
        catalog._shared.clear()
        catalog._shared.update(before)
