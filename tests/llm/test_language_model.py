import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronotape.llm import language_model
from chronotape.llm.language_model import Vocabulary, score_language, tokens
from chronotape.llm.log_bilinear import LogBilinear, Scorer, Trainer, contexts, every, joined
from tests.llm.conftest import WORDS, sentence

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@pytest.mark.parametrize("text", ["", " A b\tC\x0bD\x0c\r\nÉé", " x y\x85z", "Ünï ÀB", "a\x1cb"])
def test_tokens(text):
    assert [t.decode() for t in tokens(text)] == words(text)


def naive(model, before, earlier, word):
    """log P(group) + log P(word within its group), by softmaxes written out."""
    x = model.gates[0] * model.inputs[before] + model.gates[1] * model.inputs[earlier]
    scores = [float(o[:-1] @ x + o[-1]) for o in model.outputs]
    by_group = {g: scores[model.words + g] for g in range(len(scores) - model.words)}
    peers = [scores[w] for w in range(model.words) if model.groups[w] == model.groups[word]]
    return by_group[model.groups[word]] - math.log(sum(map(math.exp, by_group.values()))) + scores[word] - math.log(sum(map(math.exp, peers)))


def test_scores_are_normalised_and_equal_the_naive_ones():
    groups = np.array([0, 1, 2, 2, 2, 3, 3])
    model = LogBilinear.fresh(np.array([0.3, 0.2, 0.15, 0.05, 0.1, 0.1, 0.1]), groups)
    model.held[:] = np.random.default_rng(3).normal(0, 0.8, model.held.shape)
    scorer, words = Scorer(model), np.arange(7, dtype=np.uint16)
    for before, earlier in ((7, 7), (2, 7), (6, 0)):
        found = scorer(np.full(7, before), np.full(7, earlier), words)
        assert found == pytest.approx([naive(model, before, earlier, w) for w in range(7)], abs=1e-4)
        assert np.exp(found).sum() == pytest.approx(1, abs=1e-4)


@pytest.mark.parametrize("size", [0.3, 40.0])
def test_scores_small_or_large_equal_the_naive_ones(size):
    groups = np.array([0, 1, 2, 2, 2, 3, 3])
    model = LogBilinear.fresh(np.full(7, 1 / 7), groups)
    model.held[:] = np.random.default_rng(5).normal(0, size, model.held.shape)
    found = Scorer(model)(np.full(7, 3), np.full(7, 1), np.arange(7, dtype=np.uint16))
    assert np.isfinite(found).all() and (found <= 1e-6).all()
    if size < 1:
        assert found == pytest.approx([naive(model, 3, 1, w) for w in range(7)], abs=1e-4)
    else:
        x = model.predicted(np.array([3]), np.array([1]))[0].astype(float)
        assert np.abs(model.outputs.astype(float) @ x).max() > 1_000  # exponentials would overflow


def test_a_step_moves_no_parameter_that_is_unused():
    unigram, groups = np.full(8, 1 / 8), np.array([0, 0, 0, 1, 1, 1, 2, 3])
    model = LogBilinear.fresh(unigram, groups)
    model.held[: 9, -1] = 7  # the unused column of inputs
    model.held[-2:, -1] = 3
    before = model.held.copy()
    trainer = Trainer(model, unigram, 1)
    trainer.step(np.array([1, 2], "<u2"), np.array([1, 8], "<u2"), np.array([4, 4], "<u2"))
    assert (model.held[:9, -1] == 7).all() and (model.held[-2:, -1] == 3).all()
    moved = (model.held != before).any(axis=1)
    assert moved[:9].nonzero()[0].tolist() == [1, 2, 8] and moved[-2:].all()
    assert trainer.hits[:9].tolist() == [0, 1, 1, 0, 0, 0, 0, 0, 1] and (trainer.hits > 0).tolist() == moved.tolist()


def test_documents_are_encoded_without_python_rows(make_documents):
    v = Vocabulary({b"a": 9}, {b"a": 2}, {b"ing": 3}, np.array([4.0, 0, 9, 5]), np.array([1.0, 0, 1, 2]))
    encoded = language_model.encode_documents(make_documents([(1, "A zing a zing b"), (2, None)]), v, 4)
    assert "MapInArrow" in encoded._jdf.queryExecution().toString()
    rows = {r.doc_id: r for r in encoded.collect()}
    assert np.frombuffer(rows["1"].classes, "<u2").tolist() == [2, 3, 2, 3, 1, 0] and (rows["1"].n_tokens, rows["1"].known) == (6, 3)
    assert {bytes(r.word): r.n for r in rows["1"].rare} == {b"zing": 2, b"b": 1}
    assert rows["2"].rare == [] and rows["2"].n_tokens == 1 and rows["2"].logs == pytest.approx(math.log10(5))


def test_tasks_encode_any_number_of_batches(spark, make_documents):
    v = Vocabulary({b"a": 9}, {b"a": 2}, {b"ing": 3}, np.array([4.0, 0, 9, 5]), np.array([1.0, 0, 1, 2]))
    docs = make_documents([(k, None if k % 5 == 0 else "A zing b " * (k % 4) + f"x{k} a") for k in range(23)]).coalesce(1)
    found = []
    for batch in (10_000, 3):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            found.append(language_model.encode_documents(docs, v, 4).sort("uid").collect())
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found[0]) == 23 and found[0] == found[1]


def test_scores_do_not_depend_on_batches(spark, make_documents):
    docs, found = make_documents([(k, sentence(k, 20 + k % 40)) for k in range(90)]).coalesce(1), []
    for batch in (10_000, 20):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            rows = score_language(docs).sort("doc_id").collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert len(rows) == 90 and all(r.score < 0 and math.isfinite(r.score) for r in rows)
        # training takes each batch's places in an order of its own, so scores may differ
        found.append([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9)) for r in rows])
    assert found[0] == found[1]


def test_groups_hold_one_frequent_word_or_words_of_like_endings(monkeypatch):
    monkeypatch.setattr(language_model, "SINGLE", 1)
    monkeypatch.setattr(language_model, "GROUP", 2)
    v = Vocabulary({}, {b"a": 2, b"xing": 3, b"bat": 4, b"ying": 5}, {b"rat": 6}, np.ones(7), np.ones(7))
    assert v.groups().tolist() == [0, 1, 2, 3, 4, 3, 4]


def test_thresholds_let_no_more_words_through_than_stated():
    histogram = language_model.pd.DataFrame({"level": [1, 9, 4], "words": [100, 3, 5]})
    assert [language_model._threshold(histogram, most) for most in (1_000, 107, 8, 7, 3)] == [1, 4, 4, 9, 9]
    assert language_model._threshold(histogram, 2) == 1 << 62


def test_words_of_a_class_share_its_probability():
    v = Vocabulary({b"a": 9, b"xing": 3, b"ying": 2}, {b"a": 2}, {b"ing": 3}, np.array([4.0, 0, 9, 5]), np.array([1.0, 0, 1, 2]))
    within = v.within()
    assert within[2] == 0 and 10 ** within[3] == pytest.approx((3 + 1) + (2 + 1) + 1)
    assert v.class_of(b"a") == 2 and v.class_of(b"zing") == 3 and v.class_of(b"qq") == 1


def test_contexts_stop_where_texts_begin():
    classes, begins = joined([np.array(t, "<u2").tobytes() for t in ([5], [1, 2, 3], [4], [6, 7])])
    before, earlier = contexts(classes, begins, 9)
    assert classes.tolist() == [5, 1, 2, 3, 4, 6, 7]
    assert before.tolist() == [9, 9, 1, 2, 9, 9, 6] and earlier.tolist() == [9, 9, 9, 1, 9, 9, 9]


def test_training_learns_what_follows_what():
    random = np.random.default_rng(0)
    sequence = np.zeros(60_000, dtype=np.uint16)
    for k in range(1, len(sequence)):
        sequence[k] = (sequence[k - 1] + 1) % 8 if random.random() < 0.8 else random.integers(8)
    unigram, groups = np.full(8, 1 / 8), np.array([0, 0, 0, 1, 1, 1, 2, 3])
    model = LogBilinear.fresh(unigram, groups)
    trainer = Trainer(model, unigram, 1)
    before, earlier = contexts(sequence, np.array([0]), 8)
    for _ in range(12):
        for s in range(0, len(sequence), 1_024):
            trainer.step(before[s : s + 1_024], earlier[s : s + 1_024], sequence[s : s + 1_024])
    mean = Scorer(model)(before, earlier, sequence).mean()
    best = 0.825 * math.log(0.825) + 0.175 * math.log(0.025)
    assert best - 0.1 < mean < best + 0.02


@pytest.mark.parametrize("shares", [1, 64])
def test_scores(clashing, monkeypatch, shares):
    monkeypatch.setattr(language_model, "SHARES", shares)
    monkeypatch.setattr(language_model, "FREQUENT", 30)
    monkeypatch.setattr(language_model, "WORD_CLASSES", 12)
    monkeypatch.setattr(language_model, "SINGLE", 5)
    monkeypatch.setattr(language_model, "GROUP", 4)
    monkeypatch.setattr(language_model, "CHUNK", 16)
    monkeypatch.setattr(language_model, "ENDING_CLASSES", 10)
    rows = [(k, sentence(k, 20 + k % 40)) for k in range(250)]
    rows += [(900, None), (901, ""), (902, "Never met ÉÉ words here"), (903, "AMBER amber"), (None, "no id"), (7, rows[7][1]), (904, "birch " * 9_000)]
    rows += [(1_000 + k, f"single{k}ing lone{k}") for k in range(30)]
    out = score_language(clashing(rows)).collect()

    def held(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2

    count, documents = Counter(), 0
    for i, t in rows:
        if not held(i):
            count.update(words(t))
            documents += 1
    n, v = sum(count.values()) + documents, len(count) + 1
    want = Counter()
    for i, t in rows:
        w = words(t)
        score = sum(math.log10(count[x] + 1) for x in w) + math.log10(documents + 1) - (len(w) + 1) * math.log10(n + v + 1)
        want[(i, held(i), len(w) + 1, 1 + sum(count[x] > 0 for x in w), n, round(score, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)
    ordinary = [r for r in out if r.doc_id is not None and r.doc_id < 250]
    assert sum(r.score for r in ordinary) > sum(r.base_score for r in ordinary)


def test_empty_and_nothing_to_learn_from(make_documents):
    assert score_language(make_documents([])).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (r,) = score_language(make_documents([(only, "a b")])).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and math.isfinite(r.score)


def test_vocabulary_words_are_the_most_frequent(spark):
    counts = spark.createDataFrame([(w.encode(), k + 1) for k, w in enumerate(WORDS)], "word binary, c long")
    v = language_model.build_vocabulary(counts, 3)
    assert v.word_class[WORDS[-1].encode()] == 2 and v.class_tokens[language_model.END_CLASS] == 3
    assert counts.where(F.col("c") > 0).count() == len(v.counts)


def test_scores_below_sets_are_normalised_and_equal_the_naive_ones():
    groups, sets = np.array([0, 1, 2, 2, 2, 3, 3, 4]), np.array([0, 1, 2, 2, 3])
    model = LogBilinear.fresh(np.full(8, 1 / 8), groups, sets)
    model.held[:] = np.random.default_rng(3).normal(0, 0.8, model.held.shape)
    scorer = Scorer(model)
    for before, earlier in ((8, 8), (2, 8), (6, 0)):
        x = model.gates[0] * model.inputs[before] + model.gates[1] * model.inputs[earlier]
        word, group, top = np.split(model.outputs[:, :-1].astype(float) @ x + model.outputs[:, -1], [8, 13])

        def log_share(scores, k, peers):
            return scores[k] - math.log(sum(math.exp(scores[p]) for p in peers))

        want = [
            log_share(top, sets[groups[w]], range(4)) + log_share(group, groups[w], np.flatnonzero(sets == sets[groups[w]]))
            + log_share(word, w, np.flatnonzero(groups == groups[w]))
            for w in range(8)
        ]
        found = scorer(np.full(8, before), np.full(8, earlier), np.arange(8, dtype=np.uint16))
        assert found == pytest.approx(want, abs=1e-4) and np.exp(found).sum() == pytest.approx(1, abs=1e-4)


def test_normalising_takes_few_scores_a_token():
    own = {f"{k}".encode(): 2 + k for k in range(language_model.WORD_CLASSES)}
    v = Vocabulary({}, own, {}, np.ones(len(own) + 2), np.ones(len(own) + 2))
    groups, sets = v.groups(), v.sets()
    # every word in a group, every group in a set, and nowhere more than a hundred to choose from (372 groups, and 256 words of a group, before)
    assert len(groups) == len(own) + 2 and len(sets) == groups.max() + 1
    assert sets.max() + 1 <= 100 and np.bincount(sets).max() <= 100 and np.bincount(groups).max() <= 100
    assert v.classes + len(sets) + sets.max() + 1 < 1 << 16


def test_rounds_share_out_all_places():
    texts = [np.array(t, "<u2").tobytes() for t in ([5], [1, 2, 3], [4], [6, 7, 8, 9, 10, 11, 12])]
    seen = []
    for round_ in range(3):
        classes, at = every(texts, 99, 3, round_)
        seen += zip(classes[at - 2].tolist(), classes[at - 1].tolist(), classes[at].tolist(), strict=True)
    want = []
    for t in ([5], [1, 2, 3], [4], [6, 7, 8, 9, 10, 11, 12]):
        marked = [99, 99, *t]
        want += zip(marked, marked[1:], t, strict=False)
    assert sorted(seen) == sorted(want)
    classes, at = every([], 99, 3, 0)
    assert len(at) == 0


def test_training_below_sets_tells_only_words_that_are_not_alone():
    random = np.random.default_rng(0)
    sequence = np.zeros(60_000, dtype=np.uint16)
    for k in range(1, len(sequence)):
        sequence[k] = (sequence[k - 1] + 1) % 8 if random.random() < 0.8 else random.integers(8)
    unigram, groups, sets = np.full(8, 1 / 8), np.array([0, 0, 1, 1, 2, 2, 3, 4]), np.array([0, 0, 1, 2, 3])
    model = LogBilinear.fresh(unigram, groups, sets)
    trainer = Trainer(model, unigram, 1)
    before, earlier = contexts(sequence, np.array([0]), 8)
    for _ in range(12):
        for s in range(0, len(sequence), 1_024):
            trainer.step(before[s : s + 1_024], earlier[s : s + 1_024], sequence[s : s + 1_024])
    hits = trainer.hits[9:-2]
    assert (hits[[6, 7, 11, 12]] == 0).all() and (np.delete(hits, [6, 7, 11, 12]) > 0).all()
    mean = Scorer(model)(before, earlier, sequence).mean()
    best = 0.825 * math.log(0.825) + 0.175 * math.log(0.025)
    assert best - 0.1 < mean < best + 0.02
