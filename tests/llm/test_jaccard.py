import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from treeloom.llm import jaccard


def shingles(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    size = min(4, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute(rows):
    """Each row's id, number of shingles and smallest id of its class, by comparing all pairs."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, x in enumerate(sets):
        for b in range(a):
            if x and sets[b] and 100 * len(x & sets[b]) >= 85 * len(x | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted((repr(i), len(sets[k]), repr(least.get(find(k)))) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("group, crowded", [(128, 32), (4, 3)])
def test_classes_are_those_of_all_pairs(docs_of, words, monkeypatch, group, crowded):
    monkeypatch.setattr(jaccard, "GROUP", group)
    monkeypatch.setattr(jaccard, "CROWDED", crowded)
    r = random.Random(group)
    rows = [(i, " ".join(words(r.choice([3, 5, 6, 9, 40, 120]), seed=i))) for i in range(30)]
    for i in range(30, 150):  # a large group around one text, copies of copies, and a passage that many share
        text = (rows[4][1] if i % 3 else r.choice(rows)[1]).split()
        for _ in range(r.choice([0, 0, 1, 1, 2, 5])):
            text[r.randrange(len(text))] = f"new{r.randrange(1000)}"
        rows.append((i, " ".join(text[: r.choice([len(text), len(text), 99])])))
    passage = words(20, seed=99)
    rows += [(i, " ".join(words(90, seed=i) + passage)) for i in range(200, 240)]
    rows += [(300, None), (301, ""), (302, " \t "), (303, "One two"), (304, "one TWO"), (305, "one"), (305, "x y z w")]
    rows += [(None, "one two"), (None, "only here and now"), (None, "only here and now"), (None, None), (305, "x y z w")]
    got = jaccard.similar_documents(docs_of(rows))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((repr(x.doc_id), x.n_shingles, repr(x.component_id)) for x in got.collect()) == brute(rows)


def test_empty(docs_of):
    assert jaccard.similar_documents(docs_of([])).collect() == []
    assert [tuple(x) for x in jaccard.similar_documents(docs_of([(1, None)])).collect()] == [(1, 0, 1)]


@pytest.mark.parametrize("crowded", [False, True])
def test_only_sets_that_may_be_similar_are_joined(spark, crowded):
    """Sets of one token: sizes too far apart, or the token too late in one of them, meet nothing."""
    sizes = [(20 * 2**i, 0) for i in range(6)] + [(5000, 0), (5000, 700), (5100, 0)]
    rows = [(i, n, i, 1, i, 7, at) for i, (n, at) in enumerate(sizes)]
    rows = spark.createDataFrame(rows, "uid long, n int, class long, size long, gid long, key long, at int")
    none = rows.limit(0)
    met = jaccard._met(none, rows) if crowded else jaccard._met(rows, none)
    assert [(x.uid, x.gid, x.fit) for x in met.collect()] == [(6, 8, True)]


def test_tokens_of_no_two_sets_of_like_size_are_left_out(spark):
    """Kept are those of two sets of one class of sizes or adjacent ones, and of no others unless the key is crowded."""
    sizes = {1: [100], 2: [100, 117], 3: [100, 200], 4: [17, 20], 5: [100, 110, 900], 6: [10, 1000, 1100, 9000], 7: [300, 300]}
    rows = [(100 * key + i, n, 0, key) for key, found in sizes.items() for i, n in enumerate(found)]
    kept = jaccard._shared(spark.createDataFrame(rows, "uid long, n int, at int, key long")).collect()
    found = {key: sorted(x.n for x in kept if x.key == key) for key in sizes}
    sure = {2: [100, 117], 4: [17, 20], 5: [100, 110], 6: [1000, 1100], 7: [300, 300]}
    for key, ns in sizes.items():
        assert set(sure.get(key, [])) <= set(found[key]) <= set(ns)
    assert not found[1] and not found[3]
    assert all(x.sets == len(sizes[x.key]) for x in kept)


def test_size_classes_part_no_similar_sizes(spark):
    one = spark.range(1, 4000).select(F.col("id").alias("n")).withColumn("m", F.ceil(F.col("n") * jaccard.ALIKE / 100))
    a, b = jaccard._size_class(F.col("n")), jaccard._size_class(F.col("m"))
    assert one.filter(a.bitwiseAND(b.bitwiseOR(jaccard._beside(b))) == 0).count() == 0


def test_sets_alone_in_their_group_stay_where_they_are(spark):
    rows = [(i, i % 40 if i < 45 else 1000 + i, [i]) for i in range(90)]
    groups, alone = jaccard._grouped(spark.createDataFrame(rows, "uid long, gkey long, tokens array<long>"))
    several = {i for i, gkey, _ in rows if sum(gkey == x for _, x, _ in rows) > 1}
    assert {x.uid for x in groups.collect()} == several
    assert {x.uid for x in alone.collect()} == {i for i, _, _ in rows} - several


def test_large_sets_must_share_more(spark):
    """Two similar sets of any sizes share as many first tokens as are asked of either, if those alone come first."""
    asked = {x.n: x.asked for x in spark.range(1, 3000).select(F.col("id").alias("n"), jaccard._asked(F.col("id")).alias("asked")).collect()}
    n = np.arange(1, 2500)
    first = n - jaccard._least(n) + jaccard._meet(n)
    for a in (1, 2, 3, 4, 5, 7, 19, 20, 90, 200, 333, 1000, 2000):
        for b in range(-(-a * 85 // 100), min(a * 100 // 85, 2499) + 1):
            both = max(-(-85 * (a + b) // 185), 1)
            if both <= min(a, b):
                shared = min(first[a - 1] - (a - both), first[b - 1] - (b - both), both)
                assert asked[a] <= shared and asked[b] <= shared
    assert asked[2000] > jaccard.MEET
