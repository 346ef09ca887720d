"""Toxicity scores from boosted trees over dense text features, calibrated to probabilities.

Lexicons are learned: words and word beginnings that mark toxic training documents. The features are
their densities, how close they stand to a second person, capitals, punctuation, and how much spelling
is disguised. Trees and lexicons are fitted on a bounded sample of labelled documents
(:class:`Sampling`); every document is scored over its whole text, one Arrow batch at a time.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotape.llm.boosting import BoostedTrees, Isotonic
from chronotape.llm.common import crc32_of_id, present, stored

#: Second-person words of the corpus languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros du dich dir dein deine deinen euch euer ihr".split()
)
#: Characters used in place of letters.
DISGUISES = str.maketrans("0134578@$!", "oieastbasi")
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "¡¿«»…’“”„–—"
_REPEATED = re.compile(r"(.)\1{2,}")
THRESHOLD = 0.7
#: Words before or after a second person that count as near.
NEAR = 5
FEATURES = (
    "log_words", "hits", "hit_rate", "beginnings", "beginning_rate", "weight", "weight_rate", "near_second_person", "near_rate",
    "second_person_rate", "capital_word_rate", "mark_rate", "marks_run_rate", "disguised_rate", "disguised_hits", "spaced_hits", "strongest",
)
WORD_HIT, BEGIN_HIT, SECOND, CAPITALS, MARK, RUN, DISGUISED, DISGUISED_HIT, SINGLE = (1 << k for k in range(9))
WEIGHT_SHIFT, WEIGHT_SCALE = 9, 16.0


@dataclass(frozen=True)
class Sampling:
    """Labelled documents used to fit: at most so many toxic and other ones, chosen by a hash of their id.

    ``strength`` is the least log-likelihood ratio of a lexicon entry and ``entries`` the most entries;
    beyond them the weaker ones are left out."""

    toxic: int = 4_000
    other: int = 8_000
    entries: int = 2_000
    strength: float = 20.0
    beginnings: tuple[int, ...] = (4, 5, 6)


def plain(word: str) -> str:
    return word.strip(_EDGE).lower()


def undisguised(word: str) -> str:
    """A word with look-alike characters and separators undone."""
    bare = "".join(c for c in word.translate(DISGUISES) if c.isalpha())
    return _REPEATED.sub(r"\1", bare)


def terms_of(text: str, beginnings: tuple[int, ...]) -> set[str]:
    """Lexicon candidates: whole words, and beginnings of longer words marked by a star."""
    words = {plain(w) for w in text.split()}
    words.discard("")
    out = set(words)
    for n in beginnings:
        out.update(w[:n] + "*" for w in words if len(w) > n)
    return out


class Features:
    """Turns texts into rows of :data:`FEATURES`; remembers what it found about each word form."""

    MEMORY = 100_000

    def __init__(self, lexicon: dict[str, float], beginnings: tuple[int, ...]) -> None:
        self.lexicon, self.beginnings = lexicon, beginnings
        self._codes: dict[str, int] = {}

    def _entry(self, word: str) -> tuple[int, float]:
        if (weight := self.lexicon.get(word)) is not None:
            return WORD_HIT, weight
        found = [w for n in self.beginnings if len(word) > n and (w := self.lexicon.get(word[:n] + "*")) is not None]
        return (BEGIN_HIT, max(found)) if found else (0, 0.0)

    def _code(self, form: str) -> int:
        word = plain(form)
        code, weight = self._entry(word)
        if word in SECOND_PERSON:
            code |= SECOND
        letters = [c for c in form if c.isalpha()]
        if len(letters) > 1 and all(c.isupper() for c in letters):
            code |= CAPITALS
        if "!" in form or "?" in form:
            code |= MARK | (RUN if form.count("!") + form.count("?") > 1 else 0)
        if len(word) == 1 and word.isalpha():
            code |= SINGLE
        if letters and not word.isalpha():
            bare = undisguised(word)
            if len(bare) >= 3:
                code |= DISGUISED
                kind, value = self._entry(bare)
                if kind and not code & (WORD_HIT | BEGIN_HIT):
                    code, weight = code | kind | DISGUISED_HIT, value
        return code | int(weight * WEIGHT_SCALE) << WEIGHT_SHIFT

    def _coded(self, words: list[str]) -> np.ndarray:
        known, out = self._codes, []
        for form in words:
            code = known.get(form)
            if code is None:
                code = self._code(form)
                if len(known) < self.MEMORY and len(form) < 64:
                    known[form] = code
            out.append(code)
        return np.array(out, dtype=np.int64)

    def _spaced(self, words: list[str], codes: np.ndarray) -> int:
        """Lexicon words written letter by letter."""
        single = np.flatnonzero(codes & SINGLE)
        if len(single) < 3:
            return 0
        runs = np.split(single, np.flatnonzero(np.diff(single) > 1) + 1)
        return sum(self._entry("".join(plain(words[i]) for i in run))[0] > 0 for run in runs if len(run) >= 3)

    def row(self, text: str) -> list[float]:
        words = text.split()
        n = len(words)
        if not n:
            return [0.0] * len(FEATURES)
        codes = self._coded(words)
        hit = (codes & (WORD_HIT | BEGIN_HIT)) > 0
        second = np.flatnonzero(codes & SECOND)
        at = np.flatnonzero(hit)
        near = 0
        if len(second) and len(at):
            k = np.searchsorted(second, at)
            left = at - second[np.maximum(k - 1, 0)]
            right = second[np.minimum(k, len(second) - 1)] - at
            near = int((((left >= 0) & (left <= NEAR)) | ((right >= 0) & (right <= NEAR))).sum())
        weights = (codes >> WEIGHT_SHIFT) / WEIGHT_SCALE
        total = float(weights.sum())

        def count(bit: int) -> int:
            return int(np.count_nonzero(codes & bit))

        hits, begun = count(WORD_HIT), count(BEGIN_HIT)
        return [
            math.log1p(n), hits, hits / n, begun, begun / n, total, total / n, near, near / n, len(second) / n, count(CAPITALS) / n,
            count(MARK) / n, count(RUN) / n, count(DISGUISED) / n, count(DISGUISED_HIT), self._spaced(words, codes), float(weights.max()),
        ]

    def rows(self, texts: list[str]) -> np.ndarray:
        return np.array([self.row(t) for t in texts], dtype=float).reshape(-1, len(FEATURES))


@dataclass
class ToxicityModel:
    """A lexicon, trees and their calibration; a few hundred kilobytes at most."""

    lexicon: dict[str, float]
    trees: BoostedTrees
    calibration: Isotonic
    sampling: Sampling

    def scores(self, texts: list[str], features: Features | None = None) -> np.ndarray:
        rows = (features or self.features()).rows(texts)
        return np.clip(self.calibration(self.trees.raw(rows)), 0.0, 1.0)

    def features(self) -> Features:
        return Features(self.lexicon, self.sampling.beginnings)


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, sampling: Sampling) -> DataFrame:
    """doc_id, text and y of the rows to learn from. ``learn`` says of a doc_id whether it may be used.

    Repeated labels count once, contradictory ones and nulls not at all.
    """
    truth = (
        labels.where(learn & F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").alias("__id"))
        .agg(F.min("toxic").alias("y"), F.max("toxic").alias("__max")).where(F.col("y") == F.col("__max")).drop("__max")
    )
    chosen = [
        truth.where(F.col("y") == y).orderBy(F.xxhash64(F.lit(3), "__id"), "__id").limit(most)
        for y, most in ((1, sampling.toxic), (0, sampling.other))
    ]
    ids = F.broadcast(chosen[0].unionAll(chosen[1]))  # bounded by the sampling parameters
    joined = docs.select("doc_id", present(F.col("text")).alias("text")).join(ids, F.col("doc_id") == F.col("__id"))
    return joined.select("doc_id", "text", "y")


def learn_lexicon(sample: DataFrame, sampling: Sampling) -> dict[str, float]:
    """Entries that mark toxic documents, with the log of how much likelier they make toxicity."""

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(batch["text"], batch["y"], strict=True):
                seen[y].update(terms_of(text, sampling.beginnings))
        # an entry must occur in toxic documents, but the others' counts are needed wherever it occurs
        terms = list(seen[0] | seen[1])
        for start in range(0, len(terms), 50_000):
            part = terms[start : start + 50_000]
            yield pd.DataFrame({"term": part, "pos": [seen[1][t] for t in part], "neg": [seen[0][t] for t in part]})

    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows
    n_pos, n_neg = sizes.get(1, 0), sizes.get(0, 0)
    if not n_pos or not n_neg:
        return {}
    table = sample.select("text", "y").mapInPandas(counts, "term string, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("a"), F.sum("neg").alias("b"))
    table = table.where("a >= 3")
    expected = (F.col("a") + F.col("b")) / (n_pos + n_neg)

    def part(seen: Column, size: int) -> Column:
        rest = F.lit(size) - seen
        return F.when(seen > 0, seen * F.ln(seen / (expected * size))).otherwise(0.0) + F.when(
            rest > 0, rest * F.ln(rest / ((1 - expected) * size))
        ).otherwise(0.0)

    share = (F.col("a") / n_pos) / ((F.col("b") + 0.5) / n_neg)
    ranked = table.where(expected < 1).select("term", (2 * (part(F.col("a"), n_pos) + part(F.col("b"), n_neg))).alias("g"), F.ln(share).alias("w"))
    best = ranked.where((F.col("g") >= sampling.strength) & (F.col("w") > 1.5)).orderBy(F.col("g").desc(), "term").limit(sampling.entries)
    return {r["term"]: min(float(r["w"]), 15.0) for r in best.collect()}  # bounded by sampling.entries


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, sampling: Sampling = Sampling()) -> ToxicityModel:
    """Fit on labelled documents for which ``learn`` holds; at most the sample's bound is ever gathered."""
    sample = stored(labelled_sample(docs, labels, learn, sampling), "toxicity-sample")
    lexicon = learn_lexicon(sample, sampling)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features(lexicon, sampling.beginnings)
        for batch in batches:
            yield pd.DataFrame({"y": batch["y"], "id": batch["doc_id"].astype(str), "x": list(features.rows(batch["text"].tolist()))})

    rows = sample.mapInPandas(measured, "y int, id string, x array<double>").toPandas().sort_values("id", kind="stable")
    x = np.array(rows["x"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    y = rows["y"].to_numpy(dtype=float)
    trees = BoostedTrees().fit(x, y)
    # raw scores of rows their trees have not seen, for the calibration
    folds = np.arange(len(y)) % 4
    unseen = np.zeros(len(y))
    for k in range(4):
        if (folds != k).any():
            unseen[folds == k] = BoostedTrees().fit(x[folds != k], y[folds != k]).raw(x[folds == k])
    return ToxicityModel(lexicon, trees, Isotonic().fit(unseen, y), sampling)


def toxicity_score(model: ToxicityModel):
    """A column function from text to score."""

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = model.features()
        for batch in batches:
            yield pd.Series(model.scores(batch.tolist(), features))

    return F.pandas_udf(scores, "double")


def held_out() -> Column:
    return crc32_of_id("doc_id") % 3 == 1


def score_toxicity(docs: DataFrame, labels: DataFrame, sampling: Sampling = Sampling()) -> DataFrame:
    """doc_id, held_out, score and predicted for every document.

    A null or empty text has the features of no words and is scored like any other. Repeated rows get
    equal scores. Without labels of both kinds the score is their share. An empty table gives an empty
    result. Other columns are ignored.
    """
    model = fit_toxicity(docs, labels, ~held_out(), sampling)
    scored = docs.select("doc_id", held_out().alias("held_out"), toxicity_score(model)(present(F.col("text"))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, sampling: Sampling = Sampling()) -> DataFrame:
    """The documents that are not predicted toxic, with their own columns."""
    model = fit_toxicity(docs, labels, F.lit(True), sampling)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    work = docs.select(F.struct(*columns).alias("__row"), toxicity_score(model)(present(F.col("text"))).alias("__score"))
    return work.where(F.col("__score") < THRESHOLD).select("__row.*")
