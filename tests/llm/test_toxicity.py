import zlib

import numpy as np
import pytest

from chronotape.llm.boosting import BoostedTrees, Isotonic
from chronotape.llm.toxicity import FEATURES, Features, Sampling, drop_toxic, score_toxicity, undisguised
from tests.llm.conftest import sentence

BAD = ["grublin", "snarfel", "moxxit"]


def test_trees_learn_an_interaction():
    random = np.random.default_rng(1)
    x = random.uniform(-1, 1, (2_000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.2)).astype(float)
    model = BoostedTrees().fit(x[:1_500], y[:1_500])
    assert ((model.raw(x[1_500:]) > 0) == y[1_500:]).mean() > 0.95


def test_trees_without_both_classes_or_rows():
    assert np.allclose(BoostedTrees().fit(np.zeros((3, 2)), np.zeros(3)).raw(np.ones((2, 2))), np.log(1e-4 / (1 - 1e-4)))
    assert len(BoostedTrees().fit(np.zeros((0, 2)), np.zeros(0)).raw(np.zeros((1, 2)))) == 1


def test_isotonic_rises_and_keeps_rates():
    random = np.random.default_rng(2)
    raw = random.normal(size=4_000)
    y = (random.random(4_000) < 1 / (1 + np.exp(-2 * raw))).astype(float)
    fitted = Isotonic().fit(raw, y)
    grid = fitted(np.linspace(-4, 4, 200))
    assert (np.diff(grid) >= 0).all() and abs(fitted(raw).mean() - y.mean()) < 0.02
    assert abs(float(fitted(np.array([0.5]))[0]) - 1 / (1 + np.exp(-1.0))) < 0.1


def test_features_of_disguised_and_spaced_words():
    f = Features({"grublin": 5.0, "snarf*": 3.0}, (5,))
    row = dict(zip(FEATURES, f.row("you gr0bl1n GRUBLIN! snarfelling g r u b l i n fine words"), strict=True))
    assert row["hits"] == 1 and row["beginnings"] == 1 and row["spaced_hits"] == 1 and row["near_second_person"] >= 1
    assert dict(zip(FEATURES, f.row("gru8lin grub1in"), strict=True))["disguised_hits"] >= 0
    assert undisguised("gr.ub-l1n") == "grublin" and f.row("") == [0.0] * len(FEATURES)


@pytest.fixture(scope="module")
def corpus(spark):
    rows, labels = [], []
    for k in range(900):
        words = sentence(k, 30 + k % 50).split()
        toxic = k % 6 == 0
        if toxic:
            for j in range(1 + k % 4):
                words.insert((k * 7 + j * 11) % len(words), BAD[(k // 6 + j) % 3])
        rows.append((k, " ".join(words), "en", "s", 1))
        labels.append((k, 1, int(toxic)))
    rows += [(2_000, None, None, None, None), (2_001, "", "en", "s", 0), (2_002, "fine " * 8_000 + "grublin snarfel", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents(corpus):
    docs, labels = corpus
    scored = {r.doc_id: r for r in score_toxicity(docs, labels).collect()}
    assert len(scored) == docs.count()
    for i, r in scored.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    unseen = [i for i in scored if i < 900 and scored[i].held_out]
    right = [scored[i].predicted == int(i % 6 == 0) for i in unseen]
    assert np.mean(right) > 0.97 and scored[2_000].predicted == scored[2_001].predicted == 0


def test_held_out_labels_do_not_matter(corpus):
    from pyspark.sql import functions as F

    from chronotape.llm.toxicity import held_out

    docs, labels = corpus
    turned = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    few = docs.where("doc_id < 40")
    one = score_toxicity(docs, labels).join(few.select("doc_id"), "doc_id").select("doc_id", "score").collect()
    two = score_toxicity(docs, turned).join(few.select("doc_id"), "doc_id").select("doc_id", "score").collect()
    assert dict(map(tuple, one)) == pytest.approx(dict(map(tuple, two)))


def test_stage_drops_toxic_documents(corpus, clashing):
    _, labels = corpus
    docs, _ = corpus
    more = clashing([(5_000, sentence(1, 40) + " grublin snarfel moxxit grublin"), (5_001, sentence(2, 40)), (5_002, None), (5_001, sentence(2, 40))])
    both = docs.unionByName(more, allowMissingColumns=True).select(more.columns)
    out = drop_toxic(both, labels)
    left = [r.doc_id for r in out.collect()]
    assert out.columns == more.columns and 5_000 not in left and left.count(5_001) == 2 and 5_002 in left


def test_without_labels_or_documents(corpus, make_documents):
    docs, labels = corpus
    few = docs.limit(5)
    assert {r.predicted for r in score_toxicity(few, labels.limit(0), Sampling(toxic=5)).collect()} == {0}
    assert score_toxicity(make_documents([]), labels).count() == 0
