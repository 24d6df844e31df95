import math
import random

import pytest

from treeloom.llm import negatives


def brute(rows, every=50):
    best = {}
    for i, vector, label in rows:
        if i is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = (label, [math.floor(256 * x) for x in vector])
        best[i] = min(best.get(i, whole), whole)
    out = []
    for a, (label, q) in best.items():
        if a % every:
            continue
        scores = {i: sum(x * y for x, y in zip(q, v, strict=True)) for i, (_, v) in best.items() if i != a and len(v) == len(q)}
        order = sorted(scores, key=lambda i: (-scores[i], i))
        for p in [i for i in order if best[i][0] == label][:5]:
            fit = [n for n in order if best[n][0] != label and 50 * scores[p] <= 100 * scores[n] <= 95 * scores[p]]
            out += [(a, p, k + 1, n, scores[p], scores[n]) for k, n in enumerate(fit[:3])]
    return sorted(out)


def mined(spark, rows, vector="array<double>"):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], f"vec_id long, embedding {vector}, label int, id string, size int")
    return sorted(map(tuple, negatives.mine(df).collect()))


@pytest.mark.parametrize("leaf, queues, anchors", [(64, 1 << 22, 1 << 14), (4, 40, 3)])
def test_negatives_are_those_of_all_pairs(spark, monkeypatch, leaf, queues, anchors):
    for name, value in (("LEAF", leaf), ("QUEUES", queues), ("ANCHORS", anchors)):
        monkeypatch.setattr(negatives, name, value)
    r = random.Random(leaf)
    centres = [[r.gauss(0, 0.4) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(600):
        k = r.randrange(4)
        rows.append((i, [x + r.gauss(0, 0.1) for x in centres[k]], k if r.random() < 0.8 else r.randrange(4)))
    rows += [(1000 + i, list(rows[50][1]), i % 3) for i in range(40)]  # ties
    rows += [(100, rows[0][1], 1), (700, None, 1), (701, [0.1] * 6, None), (None, [0.1] * 6, 1), (702, [0.1] * 5 + [None], 1)]
    rows += [(750, [float("nan")] + [0.1] * 5, 1), (751, [float("inf")] + [0.1] * 5, 1), (800, [], 1), (850, [], 1), (851, [], 2)]
    rows += [(900, [1.0, 2.0], 1), (901, [1.0, 1.5], 1), (902, [0.9, 1.0], 2), (903, [0.7, 1.3], 2)]
    rows += rows[:20]
    got = mined(spark, rows)
    assert got == brute(rows) and len({x[0] for x in got}) > 8


def test_large_components_are_exact(spark):
    rows = [(i, [1e6 + 9 * i / 256, 3e5 * (i % 7)], i % 2) for i in range(60)]
    assert mined(spark, rows) == brute(rows)


def test_nothing_to_mine(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [0.5], 1), (2, [0.5], 2)]) == []
    assert mined(spark, [(50, [0.5], 1)]) == []
