import random
import zlib
from collections import Counter

from treeloom.llm import spelling


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    out = {}
    for w, n in counts.items():
        by = [v for v in counts if near(w, v)]
        best = min(by, key=lambda v: (-counts[v], v), default=None)
        form = best if by and counts[best] >= 2 * n else None
        out[w] = (form, n, len(by), counts[form] if form else None)

    def root(w):
        return root(out[w][0]) if out[w][0] else w

    return {w: (f, root(w), n, k, m) for w, (f, n, k, m) in out.items()}


def result(df):
    return {x.word: (x.form, x.root, x.n, x.n_near, x.form_n) for x in df.collect()}


def vocabulary(seed):
    r = random.Random(seed)
    words = {"".join(r.choices("abcdeéÿ", k=r.randrange(5, 9))): r.choice([3, 3, 4, 8, 20, 90]) for _ in range(150)}
    for w in list(words):
        for _ in range(3):
            i = r.randrange(len(w))
            words[w[:i] + r.choice(["", w[i] * 2, "x"]) + w[i + 1 :]] = r.choice([3, 6, 7, 40])
    return words


def test_forms_are_those_of_all_pairs(spark, monkeypatch):
    for block, groups in ((2048, 6), (3, 2)):
        monkeypatch.setattr(spelling, "BLOCK", block)
        monkeypatch.setattr(spelling, "GROUPS", groups)
        words = vocabulary(block)
        df = spark.createDataFrame(list(words.items()), "word string, n long")
        assert result(spelling.group_variants(df)) == brute(words)


def test_ties_repeats_and_nulls(spark):
    rows = [("hallo", 2), ("hallo", 1), ("hella", 9), ("halla", 30), ("hullo", 30), (None, 3), ("", 5), ("a" * 5000, 3), ("a" * 4999, 6)]
    want = {"hallo": 3, "hella": 9, "halla": 30, "hullo": 30, "a" * 5000: 3, "a" * 4999: 6}
    got = result(spelling.group_variants(spark.createDataFrame(rows, "word string, n long")))
    assert got == brute(want) and got["hallo"][0] == "halla"
    assert result(spelling.group_variants(spark.createDataFrame([], "word string, n long"))) == {}


def test_words_of_documents(docs_of):
    r = random.Random(1)
    stock = ["Straße", "straße", "Éclair", "éclair", "words", "word's", "abc", "naïve×x", "largely", "LARGELY"]
    rows = [(i, " ".join(r.choices(stock, k=60))) for i in range(40)] + [(None, "largely words " * 9), (3, None), (4, ""), (4, "x-1 2")]
    counts = Counter()
    for i, text in rows:
        for run in spelling._RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 7 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    assert result(spelling.variants(docs_of(rows), drop_every=7)) == brute(counts)
    assert result(spelling.variants(docs_of([]))) == {}
