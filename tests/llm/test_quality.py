import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chronotape.llm.quality import RULES, RiskLimit, _allowed, fit_cutoffs, judge_quality, keep_quality, measure
from tests.llm.conftest import sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    repeated = {k + d for k, w in enumerate(windows) if seen[w] > 1 for d in range(3)}
    n = len(words)
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated),
        n < 50 or 100 * len(repeated) > 50 * n,
    )


TEXTS = [
    None, "", " \n\t ", "one", "one two", "a b c a b c", "a a a a a", "a b a b a b a b", "x\ny\nx\n\n \nx", "#1 $2 %% <b> | & *", "é ñ ß 🙂 🙂", "Ünï CODE!",
    "z" * 3_000, "\x0b\x0c a\rb", sentence(1, 400), sentence(2, 60) + "\n" + sentence(2, 60), ("w " * 200).strip(), sentence(3, 49), sentence(4, 50),
]


def test_measures_equal_a_plain_count(clashing):
    rows = list(enumerate(TEXTS)) + [(3, "one"), (None, "two words")]
    got = measure(clashing(rows).drop("n_words")).select("doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[2:] == base(r.text), r.text


def tail(k, n, p):
    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log(1 - p)) for j in range(k + 1))


def test_allowed_rejections_are_the_exact_binomial_bound(spark):
    limit = RiskLimit()
    sizes = [10, 300, 308, 420, 1_000, 5_000, 40_000]
    cells = spark.createDataFrame([(f"l{n}", next(iter(RULES)), n) for n in sizes], "stratum string, rule string, n_good long")
    level = limit.delta / (len(sizes) * len(RULES))
    for r in _allowed(cells, limit).collect():
        n = int(r.stratum[1:])
        assert tail(r.allowed + 1, n, limit.alpha) > level
        assert r.allowed < 0 or tail(r.allowed, n, limit.alpha) <= level


@pytest.fixture(scope="module")
def corpus(spark):
    good = [(k, sentence(k, 60 + k % 20), "en", 1) for k in range(500)]
    marked = [(1_000 + k, " ".join(w + "***" for w in sentence(k, 70).split()), "en", 0) for k in range(60)]
    loud = [(2_000 + k, sentence(k, 70).upper().replace(" ", "!! "), "en", 0) for k in range(60)]
    rows = good + marked + loud
    docs = spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t, lang, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, q, 0) for i, _, _, q in rows if i % 5], "doc_id long, quality int, toxic int")
    return docs, labels


def test_junk_goes_and_good_documents_stay(corpus):
    docs, labels = corpus
    odd = docs.limit(1).select(F.lit(9_001).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("lang"), "source", "n_chars")
    verdict = {r.doc_id: r.kept for r in judge_quality(docs.unionByName(odd), labels).select("doc_id", "kept").collect()}
    assert sum(verdict[k] for k in range(500)) >= 499
    assert not any(v for k, v in verdict.items() if 1_000 <= k < 3_000) and verdict[9_001] is False


def test_cutoffs_reject_few_labelled_good_documents(corpus):
    docs, labels = corpus
    cuts = fit_cutoffs(measure(docs), labels).collect()
    assert [r.stratum for r in cuts] == ["en"] or [r.stratum for r in cuts] == ["*"]
    assert cuts[0]["cut_symbols"] is not None or cuts[0]["cut_marks"] is not None


def test_other_languages_are_judged_by_the_labels_of_all(corpus, spark):
    docs, labels = corpus
    more = docs.withColumn("doc_id", F.col("doc_id") + 10_000)
    all_labels = labels.unionAll(labels.select(F.col("doc_id") + 10_000, "quality", "toxic")).unionAll(
        spark.createDataFrame([(30_000 + k, 1, 0) for k in range(20)], labels.schema)
    )
    few = docs.where("doc_id < 20").withColumns({"doc_id": F.col("doc_id") + 30_000, "lang": F.lit("few")})
    none = docs.withColumns({"doc_id": F.col("doc_id") + 50_000, "lang": F.lit(None).cast("string")})
    junk = docs.where("doc_id >= 1000").withColumns({"doc_id": F.col("doc_id") + 70_000, "lang": F.lit("few")})
    every = docs.unionByName(more).unionByName(few).unionByName(none).unionByName(junk)
    verdict = {r.doc_id: r.kept for r in judge_quality(every, all_labels).select("doc_id", "kept").collect()}
    assert not any(v for k, v in verdict.items() if 51_000 <= k < 53_000 or 71_000 <= k < 73_000)
    assert all(verdict[30_000 + k] for k in range(20)) and sum(verdict[50_000 + k] for k in range(500)) >= 499
    assert not any(verdict[k] for k in range(1_000, 1_060)) and not any(verdict[k] for k in range(12_000, 12_060))


def test_contradictory_and_repeated_labels(corpus, spark):
    docs, labels = corpus
    twisted = labels.unionAll(labels).unionAll(spark.createDataFrame([(1, 0, 0), (None, None, None)], labels.schema))
    assert fit_cutoffs(measure(docs), twisted).count() == 1


def test_no_labels_and_no_documents(corpus, make_documents):
    docs, labels = corpus
    kept = judge_quality(docs, labels.limit(0)).where("kept").count()
    assert kept == 620
    assert judge_quality(make_documents([]), labels).count() == 0


def test_stage_keeps_the_columns(corpus, clashing):
    _, labels = corpus
    rows = [(k, sentence(k, 60)) for k in range(5)] + [(7, "short"), (8, None)]
    out = keep_quality(clashing(rows), labels)
    assert out.columns == clashing(rows).columns
    assert sorted(r.doc_id for r in out.collect()) == [0, 1, 2, 3, 4]
