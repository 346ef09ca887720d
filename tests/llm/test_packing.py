import itertools
import math
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chronotape.llm.grouping import Island
from chronotape.llm.packing import cut, pack_documents, pack_lengths, vocabulary
from chronotape.llm.tokens import encoder
from tests.llm.conftest import sentence

ODD = [
    "", " ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "tab\tb c", "\n\n", "x y z", "x 　y", "don't we'll I'M", "1234 5 67", "é ñ ß 日本語 テスト", "🙂 🙂🙂",
    "<|endoftext|> end", "hello <|endoftext|> world", "a<|endoftext|><|endoftext|>b  c", "<|endoftext|>", "<|endoftext| >", "a" * 3_000, "!?" * 40 + " ok", "line one.\nLine two. \n\n Line three", "a b c\u0085 d", "\x00 \x1f x", "word " * 50,
]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_equal_those_of_the_public_tokenizer(reference):
    encode = encoder(vocabulary()).encode
    for text in [*ODD, *(sentence(k, 80) for k in range(20)), "\n".join(ODD[:12]), " ".join(ODD)]:
        assert np.frombuffer(encode(text), "<u4").tolist() == reference(text), text[:60]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab1'!. \n\t éß日🙂")), max_size=40))
def test_ids_of_any_text(text):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")) if not hasattr(test_ids_of_any_text, "t") else test_ids_of_any_text.t
    test_ids_of_any_text.t = t
    assert np.frombuffer(encoder(vocabulary()).encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


@settings(deadline=None)
@given(st.integers(1, 10_000), st.integers(1, 1_100))
def test_cut(total, capacity):
    pieces = cut(total, capacity)
    assert sum(n for _, n in pieces) == total and all(n == capacity for _, n in pieces[1:]) and 0 < pieces[0][1] <= capacity
    assert [s for s, _ in pieces] == [0, *itertools.accumulate(n for _, n in pieces[:-1])]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=80), st.integers(0, 99))
def test_islands_keep_every_item_once(lengths, seed):
    island = Island(lengths, 100, seed)
    island.seed_population()
    start = len(island.best())
    island.evolve(6)
    for packing in island.population:
        assert sorted(i for b in packing for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 100 for b in packing)
    assert len(island.best()) <= start


def test_crossover_keeps_injected_bins_whole():
    lengths = [60, 40, 50, 50, 70, 30, 20, 20]
    island = Island(lengths, 100, 1)
    donor = [[0, 1], [2, 3], [4, 5], [6, 7]]
    child = island.crossover([[0], [1, 2], [3], [4], [5, 6, 7]], donor)
    assert any(b in child for b in donor) and sorted(i for b in child for i in b) == list(range(8))


def check(rows, out, reference):
    ids = defaultdict(list)
    for i, t in rows:
        ids[i].append(reference(t or "") + [2])
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    want = {}
    for i, many in ids.items():
        want[i] = sorted(
            (k, s, n, zlib.crc32(np.array(x[s : s + n], "<u4").tobytes())) for x in many for k, (s, n) in enumerate(cut(len(x), 1024))
        )
    assert {i: sorted(p) for i, p in pieces.items()} == want
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(len(x) for many in ids.values() for x in many)
    return len(sequences), math.ceil(total / 1024)


def test_documents(clashing, reference):
    rows = [(k, sentence(k, 20 + (k * 37) % 900)) for k in range(150)] + [(500, None), (501, ""), (None, "no id"), (502, sentence(1, 6_000))]
    rows += [(7, "again")] * 3 + [(600 + k, t) for k, t in enumerate(ODD)]
    used, least = check(rows, pack_documents(clashing(rows)).collect(), reference)
    assert used <= least * 1.03 + 1


def test_empty(make_documents):
    assert pack_documents(make_documents([])).count() == 0


def test_many_sets(spark):
    items = spark.range(3_000).selectExpr("id AS uid", "CAST(1 + (id * 7919) % 1023 AS INT) AS length")
    out = pack_lengths(items, per_set=500).join(items, "uid").groupBy("sequence_id").agg(F.sum("length").alias("fill"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in out) == 3_000 and max(r.fill for r in out) <= 1024
    assert len(out) <= 1.02 * math.ceil(sum(1 + (k * 7919) % 1023 for k in range(3_000)) / 1024) + 6
