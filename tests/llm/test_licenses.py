import random
import textwrap

from treeloom.llm import licenses


def brute(text):
    """Every run of lines against every template, by the definition."""
    lines = [licenses.words_of(line) for line in text.split("\n")]
    sets = [(label, set(licenses.words_of(t)), len(licenses.words_of(t))) for label, t in licenses.TEMPLATES]
    hits = []
    for first in range(len(lines)):
        for last in range(first, min(first + licenses.LINES, len(lines))):
            run = lines[first : last + 1]
            own, n = {w for line in run for w in line}, sum(map(len, run))
            for i, (_, words, length) in enumerate(sets):
                if len(own & words) / len(words) < licenses.CONTAINED:
                    continue
                if first == last or (all(run) and n <= 2 * length):
                    hits.append((i, first, last, own & words))
    least = [
        (i, a, b, both) for i, a, b, both in hits
        if not any(j == i and other == both and a <= c and d <= b and (c, d) != (a, b) for j, c, d, other in hits)
    ]

    def share(hit):
        return len(hit[3]) / len(sets[hit[0]][1])

    def explained(m):
        for o in least:
            meets = o[1] <= m[2] and o[2] >= m[1] and m[3] <= sets[o[0]][1]
            if meets and (share(o) > share(m) or (share(o) == share(m) and sets[m[0]][1] < sets[o[0]][1])):
                return True
        return False

    return sorted((m[1], m[2], sets[m[0]][0], share(m), not explained(m)) for m in least)


def scanned(docs):
    found = licenses.with_licenses(docs, licenses.fit(docs), "found").select("doc_id", "found.matches").collect()
    return {r.doc_id: sorted((m.line, m.last_line, m.label, m.containment, m.best) for m in r.matches) for r in found}


def test_finds_every_block(spark, docs_of):
    r = random.Random(3)
    vocabulary = sorted({w for _, t in licenses.TEMPLATES for w in licenses.words_of(t)})
    texts = []
    for _ in range(150):
        lines = []
        for _ in range(r.randrange(5)):
            words = licenses.words_of(r.choice(licenses.TEMPLATES)[1])
            words = [w for w in words if r.random() < 0.9] + r.sample(vocabulary, r.randrange(6))
            if r.random() < 0.5:
                r.shuffle(words)
            text = " ".join(words)
            lines.append("\n".join(textwrap.wrap(text, r.choice([30, 60, 75]))) if r.random() < 0.6 else text)
        texts.append(r.choice(["\n", "\n\n", "\n#\n"]).join(lines))
    got = scanned(docs_of(list(enumerate(texts))))
    wants = [brute(text) for text in texts]
    assert sum(m[1] > m[0] for want in wants for m in want) > 50
    for i, want in enumerate(wants):
        assert got[i] == want


def test_each_template_yields_its_own_label(docs_of):
    """On one line, and wrapped at usual widths, in comments or not."""
    rows, want = [], {}
    for label, text in licenses.TEMPLATES:
        for width in (1_000, 75, 60):
            for lead in ("", "# "):
                i = len(rows)
                body = "\n".join(lead + line for line in textwrap.wrap(text, width))
                rows.append((i, f"print(1)\n\n{body}\n\nimport os"))
                want[i] = {label}
    got = scanned(docs_of(rows))
    assert {i: {m[2] for m in found if m[4]} for i, found in got.items()} == want


def test_paragraphs_are_not_joined(docs_of):
    first, second = "Permission is hereby granted, free of charge, to any person", "obtaining a copy of this software and associated documentation files"
    got = scanned(docs_of([(1, f"{first}\n{second}"), (2, f"{first}\n\n{second}"), (3, f"{first}\n" + "x " * 40 + f"\n{second}")]))
    assert [m[2] for m in got[1]] == ["mit-text"] and got[2] == [] and got[3] == []


def test_words_of_templates_are_ordered_by_the_corpus(docs_of):
    model = licenses.fit(docs_of([(1, "mit\nmit the\nmit"), (2, "The license")]))
    rank = model.rank_of(licenses._hash_of(["released", "license", "the", "mit", "zebra"]))
    assert rank[4] == -1 and rank[0] < rank[1] < rank[2] < rank[3]


def test_phrases(docs_of):
    texts = ["The MIT License. mit-license", "General\nPublic license; apache license", "mitlicense", None, "", "mit " * 50_000 + "license", "é" * 9]
    rows = list(enumerate(texts)) + [(1, texts[1]), (None, texts[0])]
    docs = docs_of(rows)
    got = licenses.with_licenses(docs, licenses.fit(docs), "n2").select("doc_id", "n2.*").collect()
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got]
    assert got == [
        (0, 5, 2, 1, 3, ["mit"]), (1, 5, 2, 0, 3, ["apache", "gpl"]), (2, 1, 0, None, None, []), (3, 0, 0, None, None, []),
        (4, 0, 0, None, None, []), (5, 50_001, 1, 49_999, 49_999, ["mit"]), (6, 1, 0, None, None, []),
        (1, 5, 2, 0, 3, ["apache", "gpl"]), (None, 5, 2, 1, 3, ["mit"]),
    ]
    empty = docs_of([])
    assert licenses.with_licenses(empty, licenses.fit(empty), "n2").count() == 0
