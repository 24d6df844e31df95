import random
import re
from collections import Counter

import pytest

from treeloom.llm import mixing


def worst_lag(order, quota):
    """Largest deviation from the weights at any time, in blocks."""
    slots, done, worst = sum(quota.values()), Counter(), 0
    for t, (s, i) in enumerate(order, 1):
        assert done[s] == i
        done[s] += 1
        worst = max(worst, *(abs(done[x] - t * n / slots) for x, n in quota.items()))
    return worst


def test_deviation_stays_below_one_block():
    r = random.Random(3)
    for _ in range(200):
        quota = {f"s{i}": r.randint(1, 40) for i in range(r.randint(1, 12))}
        order = mixing.earliest_deadline_first(quota)
        assert Counter(s for s, _ in order) == quota and worst_lag(order, quota) < 1 - 1e-9
    assert mixing.earliest_deadline_first({}) == []


def test_shares():
    assert mixing.shares({"a": 1, "b": 3}, 8) == {"a": 2, "b": 6}
    assert mixing.shares({"a": 0.0, "b": 1e9}, 10)["a"] == 1
    assert len(mixing.shares({str(i): 1 for i in range(50)}, 10)) == 50


@pytest.mark.parametrize("targets", [None, {"s0": 5, "s1": 1, "s2": 2}, {None: 1, "s0": 1}, {}, {"other": 1}])
def test_every_document_has_a_place_of_its_own(spark, docs_of, targets):
    docs = docs_of([])
    for s, n in (("s0", 500), ("s1", 130), ("s2", 70), (None, 33)):
        docs = docs.union(docs_of([(1000 * len(s or "") + ord((s or "x9")[1]) * 10_000 + i, "t") for i in range(n)], "en", s))
    docs = docs.union(docs_of([(None, "a"), (None, "a"), (7, None)], "en", "s1")).repartition(4)
    got = mixing.mix(docs, targets, block=4, round_blocks=20)
    assert got.columns == [*docs.columns, "mix_round", "mix_slot", "mix_row"]
    rows = sorted(got.collect(), key=lambda r: (r.mix_slot, r.mix_row))
    assert sorted(str(r[:9]) for r in rows) == sorted(str(tuple(r)) for r in docs.collect())
    assert len({(r.mix_slot, r.mix_row) for r in rows}) == len(rows)
    slots = {r.mix_slot: (r.mix_round, r.source) for r in rows}
    assert sorted(slots) == list(range(len(slots)))
    assert all(n == 1 for n in Counter((r.mix_slot, r.source) for r in {(r.mix_slot, r.source): r for r in rows}.values()).values())
    rounds = {}
    for slot in sorted(slots):
        number, source = slots[slot]
        rounds.setdefault(number, []).append(source)
    assert list(rounds) == sorted(rounds)
    for order in rounds.values():
        quota, seen = Counter(order), Counter()
        places = []
        for s in order:
            places.append((s, seen[s]))
            seen[s] += 1
        assert worst_lag(places, quota) < 1 - 1e-9
    if targets and "s2" in targets:
        first = Counter(rounds[0])
        assert (first["s0"], first["s2"], first["s1"]) == tuple(mixing.shares({"s0": 5, "s1": 1, "s2": 2, "": 0}, 20)[s] for s in ("s0", "s2", "s1"))


def test_edges(spark, docs_of, capsys):
    assert mixing.in_order(mixing.mix(docs_of([]))).count() == 0
    again = mixing.mix(mixing.mix(docs_of([(1, "a"), (1, "a")])))
    assert again.columns.count("mix_slot") == 1 and again.count() == 2
    again.explain("extended")
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)
