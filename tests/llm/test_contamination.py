import random
from collections import Counter

import pytest

from treeloom.llm import contamination


def words_of(text):
    words = contamination.split(contamination.pa.array([text]))
    return [words.data[a:b].tobytes() for a, b in zip(words.starts, words.ends, strict=True)]


def shingles(words):
    size = min(5, len(words))
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(text, item):
    """Largest similarity of any window of the item's size."""
    words, own = words_of(text or ""), words_of(item or "")
    size = min(len(own), len(words))
    if not size or size < min(5, len(own)):
        return 0
    a = shingles(own)
    return max(
        sum((a & b).values()) / sum((a | b).values())
        for b in (shingles(words[s : s + size]) for s in range(len(words) - size + 1))
    )


def test_finds_what_all_windows_show(spark, docs_of, words, monkeypatch):
    r = random.Random(8)
    items = [(i, " ".join(words(r.randrange(12, 60), seed=i))) for i in range(12)]
    items += [(50, "three small words"), (51, None), (52, ""), (0, items[0][1]), (53, "a b " * 20), (None, "x y z")]
    rows = []
    for i in range(80):
        text = words(r.randrange(80), seed=500 + i)
        part = r.choice(items[:12])[1].split()
        for _ in range(r.choice([0, 0, 1, 1, 2, 5])):
            part[r.randrange(len(part))] = "changed"
        if r.random() < 0.2:
            del part[r.randrange(len(part))]
        text[len(text) // 2 : len(text) // 2] = part
        rows.append((i, r.choice([" ", "\n", ", "]).join(text).upper()))
    rows += [(90, None), (91, ""), (92, "has Three, SMALL words."), (93, "a b " * 4000), (3, rows[3][1]), (None, items[5][1])]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, leaks string")
    docs = docs_of(rows)
    for block in (contamination.ITEM_WORDS, 40):
        monkeypatch.setattr(contamination, "ITEM_WORDS", block)
        got = [(x.doc_id, x.item_id, round(x.similarity, 9)) for x in contamination.leaks(docs, benchmark).collect()]
        want = [
            (d, i, round(s, 9)) for d, text in rows for i, item in dict.fromkeys(items)
            if i is not None and (s := brute(text, item)) >= 0.8
        ]
        assert sorted(got, key=str) == sorted(want, key=str)
    kept = contamination.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns
    dirty = {d for d, _, _ in want}
    assert sorted((x.doc_id for x in kept.collect()), key=str) == sorted((d for d, _ in rows if d not in dirty), key=str)
    assert contamination.leaks(docs, benchmark.limit(0)).count() == 0
    assert contamination.leaks(docs_of([]), benchmark).count() == 0


def test_blocks_meet_everything_within_the_radius():
    r = random.Random(1)
    texts = [" ".join(f"w{r.randrange(999)}" for _ in range(30)) for _ in range(40)]
    items = contamination.Items.build(list(range(40)), texts)
    probes = []
    for fp in items.prints.tolist():
        for n in (0, 7, 19, 20, 21, 30):
            x = fp
            for b in r.sample(range(64), n):
                x ^= 1 << b
            probes.append(x)
    want = {
        (p, i, (x ^ fp).bit_count()) for p, x in enumerate(probes) for i, fp in enumerate(items.prints.tolist())
        if (x ^ fp).bit_count() <= contamination.RADIUS
    }
    assert set(items.within(30, contamination.np.array(probes, contamination.np.uint64))) == want
    assert items.within(29, items.prints) == []


def test_similarity_counts_repeats():
    a, b = contamination.np.array([1, 1, 2, 3]), contamination.np.array([1, 2, 2, 3])
    assert contamination._similarity(a, b) == pytest.approx(3 / 5)
