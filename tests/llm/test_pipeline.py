import duckdb
import pytest

import corpus_pipeline
from treeloom.llm import queries


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        docs = spark.createDataFrame(
            step(spark, docs, sf_dir).collect(), docs.schema if i < 4 else None
        )
        if i < 4:
            assert docs.columns == columns
        assert 0.8 * n < docs.count() <= n
    assert docs.columns[:5] == columns and docs.select("mix_slot", "mix_row").distinct().count() == docs.count()
    assert corpus_pipeline.run(spark, sf_dir).count() == docs.count()


def test_empty_and_null_documents(spark, docs_of, sf_dir):
    for rows in ([], [(1, None), (2, ""), (None, "one text"), (3, "one text"), (3, "one text")]):
        docs = docs_of(rows)
        for _, step in corpus_pipeline.STAGES:
            docs = step(spark, docs, sf_dir)
        docs.collect()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    got = queries.QUERIES[name](spark, sf_dir)
    columns = ", ".join(got.columns)
    want = con.sql(f"select {columns} from ({queries.SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
