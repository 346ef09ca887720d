import re
from collections import defaultdict

from chronotape.llm.mixing import CAP, WEIGHTS, mix_sources, mixed_documents
from tests.llm.conftest import sentence


def targets(sizes):
    """Share by weight; cap; share the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: WEIGHTS[k % 3] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > CAP * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: CAP * sizes[s] for s in above}


def count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, out):
    sizes, taken, of = defaultdict(int), defaultdict(int), {}
    for _, t, s in rows:
        sizes[s] += count(t)
    for r in out:
        taken[r.source] += r.taken
        of[r.source] = r
        assert 0 <= r.taken <= CAP * r["size"]
    want, largest = targets(sizes), max((count(t) for _, t, _ in rows), default=0)
    for s, goal in want.items():
        assert of[s].source_size == sizes[s]
        assert abs(of[s].target - goal) <= 1e-6 * max(goal, 1)
        assert abs(taken[s] - goal) <= largest / 2 + 1, (s, taken[s], goal)


def test_targets_and_taken_words(make_documents):
    rows = [(k, sentence(k, 5 + k % 60), f"s{k % 9}" if k % 3 else "hot") for k in range(400)]
    rows += [(1_000 + k, sentence(k, 9), None) for k in range(12)] + [(2_000, None, "s1"), (2_001, "", "empty"), (2_002, "w " * 700, "Z")]
    docs = make_documents(rows)
    first = mix_sources(docs)
    got = first.collect()
    assert len(got) == len(rows)
    check(rows, got)
    again = mix_sources(docs.repartition(7)).select("doc_id", "taken")
    assert sorted(map(tuple, again.collect())) == sorted((r.doc_id, r.taken) for r in got)


def test_a_tiny_source_is_capped(make_documents):
    rows = [(k, sentence(k, 100), "b") for k in range(20)] + [(99, sentence(9, 10), "a")]
    out = mix_sources(make_documents(rows)).collect()
    check(rows, out)
    assert next(r for r in out if r.doc_id == 99).taken == 30


def test_copies_are_rows(clashing):
    rows = [(k, sentence(k, 40), "a" if k % 4 else "b") for k in range(60)] + [(5, "one two", "a")] * 3
    docs = clashing(rows)
    decided = {}
    for r in mix_sources(docs).collect():
        decided[r.doc_id] = decided.get(r.doc_id, 0) + r.copies
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    seen = {}
    for r in mixed.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {k: v for k, v in decided.items() if v}


def test_only_empty_texts_and_empty_table(make_documents):
    out = mix_sources(make_documents([(1, None, "a"), (2, "  ", None)])).collect()
    assert [(r.taken, r.target) for r in out] == [(0, 0.0), (0, 0.0)]
    assert mix_sources(make_documents([])).count() == 0
    assert mixed_documents(make_documents([])).count() == 0
