import random
import re
from collections import Counter

import pytest

from treeloom.llm import outliers


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    found = Counter(tuple(words[i : i + 5]) for i in range(n - 4))
    gone = {k for i in range(n - 4) if found[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(gone)


def test_statistics(docs_of, words):
    r = random.Random(4)
    texts = [None, "", " \n\t", "a b c d e", "a b c d e a b c d e", "x " * 30, "é𝄞 ü\n\né𝄞 ü\n \n#*|<>$%&", "a\x0bb\x0cc d\re"]
    texts += ["\n".join(" ".join(words(r.randrange(9), seed=i, vocabulary=3)) for _ in range(8)) for i in range(40)]
    texts.append(" ".join(words(30_000, vocabulary=12)))
    rows = outliers.statistics(docs_of(list(enumerate(texts)))).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = brute(texts[row.doc_id])
        assert tuple(row[s] for s in outliers.STATISTICS) == want
        assert row.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_quantiles():
    assert outliers._chi_square_quantile(0.95, 4) == pytest.approx(9.487729, abs=1e-5)
    assert outliers._chi_square_quantile(0.5, 2) == pytest.approx(1.386294, abs=1e-5)


def test_outliers_go_and_the_rest_stays(spark, docs_of, words):
    usual = [(i, " ".join(words(80, seed=i))) for i in range(400)]
    odd = [(1000 + i, " ".join(w + "***" for w in words(80, seed=i))) for i in range(60)]
    docs = docs_of(usual + odd).union(docs_of([(2000, usual[0][1]), (2001, odd[0][1])], None, None))
    docs = docs.union(docs_of([(3000, None), (3000, None), (None, usual[1][1])]))
    got = outliers.judge(docs).collect()
    assert len(got) == 465
    kept = {r.doc_id for r in got if r.kept}
    assert {i for i, _ in usual} <= kept and not {i for i, _ in odd} & kept
    assert {2000, None} <= kept and 2001 not in kept  # two documents are judged by all others
    assert all(r.distance is not None for r in got if not r.base_failed)
    assert [r.distance for r in got if r.doc_id == 3000] == [None, None]


def test_small_groups_join_wider_ones(docs_of, words, monkeypatch):
    monkeypatch.setattr(outliers, "GROUP_ROWS", 50)
    docs = docs_of([])
    for s in range(6):
        docs = docs.union(docs_of([(100 * s + i, " ".join(words(60, seed=100 * s + i))) for i in range(20)], "en", f"s{s}"))
    docs = docs.union(docs_of([(999, " ".join(w + "$$$$" for w in words(60)))], "en", "s9"))
    got = {r.doc_id: r for r in outliers.judge(docs).collect()}
    assert all(r.distance is not None for r in got.values())
    assert [i for i, r in got.items() if not r.kept] == [999]
    assert outliers.judge(docs_of([])).count() == 0


def test_wider_groups_hold_the_large_ones_too(docs_of, words):
    docs = docs_of([(i, " ".join(words(60, seed=i))) for i in range(120)], "en", "large")
    docs = docs.union(docs_of([(200 + i, " ".join(w + "$$$$" for w in words(60, seed=i))) for i in range(20)], "en", "few"))
    docs = docs.union(docs_of([(300, " ".join(words(60, seed=300)))], "en", "one"))
    got = {r.doc_id: r for r in outliers.judge(docs).collect()}
    assert {i for i, r in got.items() if not r.kept} == set(range(200, 220))
    assert all(r.distance is not None for r in got.values())


def test_too_few_in_all_are_kept(docs_of, words):
    got = outliers.judge(docs_of([(i, " ".join(words(60, seed=i))) for i in range(24)])).collect()
    assert [(r.kept, r.distance) for r in got] == [(True, None)] * 24


def test_no_python_on_the_main_path(docs_of, words, capsys):
    outliers.judge(docs_of([(i, " ".join(words(60, seed=i))) for i in range(300)])).explain("extended")
    plan = capsys.readouterr().out
    assert not re.search("Python|Arrow|Pandas", plan)
