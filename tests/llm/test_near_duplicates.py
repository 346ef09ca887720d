import math
from collections import Counter

import numpy as np
import pytest

from chronotape.llm.components import components
from chronotape.llm.near_duplicates import POSSIBLE, THRESHOLD, near_duplicates, one_of_each
from chronotape.llm.weighted_sets import BANDS, FREQUENCY_BITS, ROWS, SAMPLES, ConsistentSampler, Shingler, buckets, inverse_frequencies, similarity, weights
from tests.llm.conftest import sentence


def edited(text, every, seed):
    words = text.split()
    for k in range(seed % every, len(words), every):
        words[k] = f"edit{seed}x{k}"
    return " ".join(words)


def brute(rows):
    """Classes of all pairs' weighted similarities, by their least id."""
    shingler = Shingler()
    sets = [shingler(t or "") for _, t in rows]
    table = np.zeros(1 << FREQUENCY_BITS)
    for s, _ in sets:
        table[np.unique(buckets(s))] += 1
    idf = inverse_frequencies(table, len(rows))
    weighted = [(s, weights(s, n, idf)) for s, n in sets]
    label = list(range(len(rows)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            same = (rows[a][1] or "") == (rows[b][1] or "")
            if same or (len(sets[a][0]) and len(sets[b][0]) and similarity(weighted[a], weighted[b]) >= THRESHOLD):
                label[max(root(a), root(b))] = min(root(a), root(b))
    members = {}
    for k in range(len(rows)):
        members.setdefault(root(k), []).append(rows[k][0])
    return {i: min(m) for m in members.values() for i in m}


@pytest.fixture(scope="module")
def rows():
    out = [(k, sentence(k, 40 + k % 90)) for k in range(60)]
    out += [(100 + k, out[k % 7][1]) for k in range(20)]  # exact copies
    out += [(200 + k, edited(out[10][1], 23 + k, k)) for k in range(30)]  # a group around one text, near the threshold too
    out += [(300 + k, edited(edited(out[11][1], 40, 1), 45, k)) for k in range(10)]
    out += [(400 + k, " ".join([sentence(3, 30), sentence(500 + k, 60)])) for k in range(20)]  # a shared passage
    out += [(500, None), (501, ""), (502, " \n"), (503, "two words"), (504, "two words"), (505, "two wordz"), (506, "rep " * 300), (507, "rep " * 301)]
    out += [(508, sentence(77, 9_000)), (509, sentence(77, 9_000) + " tail")]
    return out


def test_classes_equal_those_of_all_pairs(clashing, rows):
    got = near_duplicates(clashing(rows)).collect()
    want = brute(rows)
    assert {r.doc_id: r.class_id for r in got} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] for r in got)
    assert sorted(r.doc_id for r in got if r.kept) == sorted(set(want.values()))


def test_a_pair_of_few_equal_samples_is_verified(make_documents):
    sampler, shingler = ConsistentSampler(), Shingler()
    for k in range(4_000):
        pair = [sentence(k, 67), edited(sentence(k, 67), 68, 30)]
        sets = [shingler(t) for t in pair]
        table = np.zeros(1 << FREQUENCY_BITS)
        for s, _ in sets:
            table[np.unique(buckets(s))] += 1
        weighted = [(s, weights(s, n, inverse_frequencies(table, 2))) for s, n in sets]
        if similarity(*weighted) >= THRESHOLD:
            one, two = (sampler.samples(*w) for w in weighted)
            if (sampler.bands(one) == sampler.bands(two)).any() and (one == two).sum() <= 43:
                break
    else:
        raise AssertionError("no such pair")
    got = near_duplicates(make_documents([(1, pair[0]), (2, pair[1])])).collect()
    assert [r.class_id for r in got] == [1, 1]


def test_the_second_round_loses_less_than_the_bands():
    least = round(POSSIBLE * SAMPLES)
    lost = sum(math.comb(SAMPLES, k) * THRESHOLD**k * (1 - THRESHOLD) ** (SAMPLES - k) for k in range(least))
    assert lost < (1 - THRESHOLD**ROWS) ** BANDS


def test_one_document_of_each_class_stays(clashing, rows):
    docs = clashing([*rows, rows[0], rows[0], (None, "no id here at all"), (None, "no id here at all")])
    out = one_of_each(docs)
    left = [r.doc_id for r in out.collect()]
    assert out.columns == docs.columns
    assert Counter(left) == Counter([*set(brute(rows).values()), None])


def test_empty(make_documents):
    assert near_duplicates(make_documents([])).count() == 0 and one_of_each(make_documents([])).count() == 0


def test_samples_agree_as_often_as_sets_are_similar():
    random = np.random.default_rng(3)
    sampler = ConsistentSampler()
    for share in (0.3, 0.6, 0.9):
        equal, true = [], []
        for _ in range(60):
            common = np.unique(random.integers(1, 2**63, int(400 * share)).astype(np.uint64))
            parts = [np.unique(np.concatenate([common, random.integers(1, 2**63, int(200 * (1 - share)) + 1).astype(np.uint64)])) for _ in "ab"]
            weight = {int(h): float(w) for p in parts for h, w in zip(p, random.uniform(1, 5, len(p)))}
            sets = [(p, np.array([weight[int(h)] for h in p])) for p in parts]
            true.append(similarity(*sets))
            equal.append((sampler.samples(*sets[0]) == sampler.samples(*sets[1])).mean())
        assert abs(np.mean(equal) - np.mean(true)) < 4 * 0.5 / np.sqrt(60 * SAMPLES) + 0.01


def test_components_of_chains_stars_and_singles(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 150)] + [(200, 200), (300, 299)]
    nodes = spark.createDataFrame([(k,) for k in [*range(41), *range(100, 150), 200, 299, 300, 400]], "node long")
    got = dict(map(tuple, components(nodes, spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 150)}, 200: 200, 299: 299, 300: 299, 400: 400}
