import numpy as np
import pyarrow as pa

from treeloom.llm import quality, queries


def test_held_out_accuracy(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    got = queries.op3_quality_classifier(spark, sf_dir).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.9
    assert all(0 <= r.score <= 1 for r in got)


def test_votes_are_those_of_the_exact_neighbours(words):
    texts = [" ".join(words(40, seed=i, vocabulary=60)) for i in range(80)] + ["AB!! CD!!", "", None]
    labels = np.arange(80) % 2 * 1.0
    voters = quality.Voters.build(quality.features(pa.array(texts[:80])), labels)
    got = voters.scores(pa.array(texts))
    rows = voters._weighted(quality.features(pa.array(texts)), voters.rarity) @ voters.directions
    for i, row in enumerate(rows):
        length = np.linalg.norm(row)
        if not length:
            assert got[i] == labels.mean()
            continue
        cosine = voters.vectors @ (row / length)
        best = np.argsort(-cosine)[: quality.NEIGHBOURS]
        weight = np.maximum(cosine[best], 0).astype(float) ** quality.SHARPNESS
        assert abs(got[i] - (weight * labels[best]).sum() / weight.sum()) < 1e-3


def test_shapes_of_words():
    n = quality.WORDS
    counts = quality.features(pa.array(["Ab ab9 ab", "x x", "", "!"]))
    assert counts.shape == (4, n + quality.SHAPES)
    assert counts[0, n + 3] == 1 and counts[0, n + 6] == 1 and counts[0, n + 2] == 1
    assert counts[1, n + 2] == 1 and counts[1, n + 256 + 2] == 1 and not counts[2].any()
    assert counts[3, n + 16] == 1


def test_every_row_gets_a_score(spark, docs_of):
    docs = docs_of([(1, "good text here"), (2, "BAD!! BAD!!"), (3, None), (4, ""), (4, ""), (None, "good"), (5, "a " * 200_000)])
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, 1), (9, 1), (None, 0), (4, None)], "doc_id long, quality int")
    voters = quality.fit(docs, labels)
    assert sorted(voters.labels) == [0, 1]
    got = quality.with_score(docs, voters, "n2")
    assert got.columns == [*docs.columns, "n2"]
    scores = {r.doc_id: r.n2 for r in got.collect()}
    assert scores[1] > 0.9 and scores[2] < 0.1 and scores[3] == scores[4] == 0.5
    none = quality.fit(docs, labels.limit(0))
    assert {r.n2 for r in quality.with_score(docs, none, "n2").collect()} == {0.5}
    assert quality.with_score(docs_of([]), voters, "n2").count() == 0
