import numpy as np
from pyspark.sql import functions as F

from treeloom.llm import language, queries


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    got = queries.op5_language_id(spark, sf_dir).join(docs, "doc_id").filter("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_filter_answers_for_all_languages():
    r = np.random.default_rng(0)
    sets = {f"l{i:03}": r.integers(0, 1 << 63, 500).astype(np.uint64) for i in range(70)}
    model = language.Filter.build(sets, 1 << 16)
    for i, codes in enumerate(sets.values()):
        bits = model.masks(codes)[i // 64] >> np.uint64(i % 64) & np.uint64(1)
        assert bits.all()
    other = r.integers(0, 1 << 63, 5000).astype(np.uint64)
    wrong = (model.masks(other)[0] & np.uint64(1)).mean()
    assert abs(wrong - model.wrong[0]) < 0.005


def test_every_text_gets_an_answer(spark, docs_of):
    train = docs_of([(i, "der hund und die katze " * 5) for i in range(5)], "de").union(
        docs_of([(i + 10, "the dog and the cat " * 5) for i in range(5)], "en")
    )
    train = train.union(docs_of([(30, None)], "fr")).union(docs_of([(31, "x")], None))
    model = language.fit(train)
    assert model.languages == ["de", "en"]
    rows = [(1, "The DOG"), (2, "und die"), (3, None), (4, ""), (5, "123 !?"), (6, "и"), (7, "the cat " * 100_000), (7, "the cat"), (None, "hund")]
    docs = docs_of(rows)
    got = language.with_language(docs, model, "n2").select("doc_id", "n2.*").collect()
    got = [(r.doc_id, r.lang) for r in got]
    assert got == [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "de"), (7, "en"), (7, "en"), (None, "de")]
    kept = language.keep_known(docs, model)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.collect()] == [1, 2, 7, 7, None]
    empty = language.fit(docs_of([]))
    assert language.with_language(docs, empty, "l").select("l.lang").distinct().collect()[0][0] == "und"
    assert language.with_language(docs_of([]), model, "l").count() == 0
