import random

from treeloom.llm import substrings as S


def brute(rows):
    """(id, words, removed, kept words) by looking at every window."""
    last = (1 << 63) - 1
    rows = [(last if i is None else i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in rows:
        for p in range(len(w) - 49):
            h = tuple(w[p : p + 50])
            first[h] = min(first.get(h, i), i)
    out = []
    for i, w in rows:
        gone = set()
        for p in range(len(w) - 49):
            if first[tuple(w[p : p + 50])] < i:
                gone |= set(range(p, p + 50))
        out.append((None if i == last else i, len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=repr)


def test_the_cover_aligns_any_two_positions():
    for a in range(S.PERIOD):
        assert any((a + d) % S.PERIOD in S.COVER for d in S.COVER)
    assert S.ANCHOR + S.PERIOD - 1 == S.SIZE


def test_matches_brute_force(docs_of, words):
    r = random.Random(1)
    shared = [words(n, seed=n) for n in (49, 50, 51, 80, 200)]
    rows = []
    for i in range(60):
        text = words(r.randrange(0, 90), seed=100 + i)
        for part in r.sample(shared, r.randrange(0, 3)):
            at = r.randrange(0, len(text) + 1)
            text[at:at] = part if r.random() < 0.7 else part[: r.randrange(len(part))]
        rows.append((i, r.choice([" ", "\n", "  \t"]).join(text)))
    rows += [(70, None), (71, ""), (72, " \n\t "), (73, "ha " * 400), (74, "ha " * 300), (3, rows[3][1]), (5, "other text")]
    rows += [(None, rows[4][1]), (None, " ".join(shared[4])), (75, "é ü " * 120), (76, "é ü " * 60)]
    rows.append((77, " ".join(words(30_000, seed=7, vocabulary=40))))
    got = S.remove_repeats(docs_of(rows).repartition(5)).collect()
    got = [(x.doc_id, x.n_words, x.n_removed, b" ".join((x.kept_text or "").encode().split())) for x in got]
    assert sorted(got, key=repr) == brute(rows)


def test_layout_of_kept_words_stays(docs_of, words):
    passage = "\n".join(words(60, seed=3))
    rows = [(1, passage), (2, f"  a  b\n{passage}\n\nc\td "), (3, "x\n\ny")]
    got = {x.doc_id: x for x in S.without_repeats(docs_of(rows)).collect()}
    assert got[2].text == "a  b\nc\td " and got[3].text == "x\n\ny" and got[1].text == passage
    assert got[2].key == "k" and got[2].n_chars == len(rows[1][1])


def test_wholly_repeated_and_empty_documents(docs_of, words):
    passage = " ".join(words(60, seed=3))
    got = S.without_repeats(docs_of([(1, passage), (2, passage), (3, None), (4, "")])).collect()
    assert sorted((x.doc_id, x.text) for x in got if x.doc_id > 1) == [(3, None), (4, "")]
    empty = docs_of([])
    assert S.remove_repeats(empty).count() == 0
    assert S.without_repeats(empty).columns == empty.columns
