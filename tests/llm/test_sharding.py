import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chronotape.llm.sharding import Permutation, shard_documents


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3_000), st.integers(0, 1_000))
def test_permutation_is_one_to_one_and_reversible(size, seed):
    p = Permutation(size, seed)
    places = p.place(np.arange(size))
    assert sorted(places.tolist()) == list(range(size))
    assert p.row(places).tolist() == list(range(size))


def test_permutation_shuffles():
    places = Permutation(10_000, 1).place(np.arange(10_000))
    assert np.mean(np.abs(np.diff(places)) == 1) < 0.01
    assert not np.array_equal(places, Permutation(10_000, 2).place(np.arange(10_000)))


def test_large_sizes_stay_in_range():
    size = 10**13 + 7
    rows = np.array([0, 1, size // 2, size - 1])
    p = Permutation(size)
    places = p.place(rows)
    assert ((places >= 0) & (places < size)).all() and p.row(places).tolist() == rows.tolist()


def check(rows, out, shards):
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[k]) for k in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in out) == want


def test_nulls_ties_repeats_and_clashes(clashing):
    rows = [(k % 7, f"text é {k % 5}") for k in range(90)] + [(None, None), (None, ""), (None, "x"), (3, "y" * 5_000)] + [(1, "same")] * 60
    check(rows, shard_documents(clashing(rows), 4).collect(), 4)


def test_independent_of_partitions(make_documents):
    rows = [(k, f"t{k}") for k in range(200)]
    one = {tuple(r) for r in shard_documents(make_documents(rows).coalesce(1), 7).collect()}
    many = {tuple(r) for r in shard_documents(make_documents(rows[::-1]).repartition(9), 7, partitions=5).collect()}
    assert one == many


def test_empty(make_documents):
    assert shard_documents(make_documents([])).count() == 0
    with pytest.raises(ValueError):
        shard_documents(make_documents([]), 0)
