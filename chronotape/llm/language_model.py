"""Text scores under a unigram base and a log-bilinear model, both from all training documents.

Word counts cover the training documents whole. The model works on classes: the end mark, every word
with at least ``LEAST`` occurrences or, where those are more than ``WORD_CLASSES``, at least as many as let
no more through, and the endings of all other words. A word has the probability of its class after
the two classes before it, times, for an ending, its smoothed share of the ending's words; one unseen
word per ending is allowed for, so the probabilities of all words sum to one. Classes are normalised in
three steps, over sets, over a set's groups and within a group: words one at a time for the most frequent,
the others by neighbourhood when sorted by their last letters.

Counts of very many words cannot be broadcast. The most frequent ones, at most ``FREQUENT``, are sent to
every task, chosen by a threshold from a histogram of counts, so that no more than those reach the
driver; the others' counts reach the documents through a join on the word. The model has at most 65,535
rows of each kind, 9 MB as sent, whatever the corpus.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotape.llm.common import crc32_of_id, present, stored
from chronotape.llm.log_bilinear import BATCH, LogBilinear, Scorer, Trainer, contexts, every, joined

#: Words whose counts travel to every task, words that are classes of their own, endings that are classes.
FREQUENT, WORD_CLASSES, ENDING_CLASSES = 150_000, 60_000, 800
#: Occurrences of a word that is a class of its own; words that are sets of their own, words in other groups, and groups in their sets.
LEAST, SINGLE, GROUP, SET = 4, 62, 64, 27
#: Local training and averaging take turns; every place is learned from in exactly one round.
ROUNDS = 3
#: Rows of parameters averaged together, and shares in which they are summed first.
CHUNK, SHARES = 256, 64
#: Distinct words counted in a task before partial counts are passed on.
HELD = 400_000
END_CLASS, OTHER_CLASS = 0, 1
_TRIM = b".,;:!?*$%&#|\"'()"


def tokens(text: str) -> list[bytes]:
    """Words as UTF-8, A-Z in lower case; white space is exactly space, tab, newline, VT, FF and CR."""
    return _split(text.encode("utf-8", "surrogatepass"))


def _split(text: bytes) -> list[bytes]:
    return text.lower().split()


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    """The column ``text`` of a batch as UTF-8, never turned into Python text and back."""
    return batch.column("text").cast(pa.binary()).to_pylist()


def ending(word: bytes) -> bytes:
    return word.rstrip(_TRIM)[-3:]


def held_out() -> Column:
    return crc32_of_id("doc_id") % 7 == 2


def word_counts(texts: DataFrame) -> DataFrame:
    """word (UTF-8 bytes) and c over all rows of ``text``."""

    def counted(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "c"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for text in _texts(batch):
                held.update(_split(text))
                if len(held) > HELD:
                    yield counted(held)
                    held.clear()
        yield counted(held)

    return texts.select("text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Classes of words and the counts of the frequent ones; its size does not grow with the corpus."""

    counts: dict[bytes, int]
    word_class: dict[bytes, int]
    ending_class: dict[bytes, int]
    #: Tokens and distinct words of each class in training.
    class_tokens: np.ndarray
    class_words: np.ndarray

    @property
    def classes(self) -> int:
        return len(self.class_tokens)

    @property
    def single(self) -> int:
        """Classes below this number hold one word (or the end), except :data:`OTHER_CLASS`."""
        return 2 + len(self.word_class)

    def class_of(self, word: bytes) -> int:
        found = self.word_class.get(word)
        return self.ending_class.get(ending(word), OTHER_CLASS) if found is None else found

    def unigram(self) -> np.ndarray:
        smooth = self.class_tokens + 1.0
        return smooth / smooth.sum()

    def groups(self) -> np.ndarray:
        """The group of each class: one each for the first, the others by their last letters."""
        names = [b"", b"", *self.word_class, *self.ending_class]
        out = np.arange(len(names))
        rest = sorted(range(2 + SINGLE, len(names)), key=lambda k: (names[k].rstrip(_TRIM)[::-1], k))
        out[rest] = 2 + SINGLE + np.arange(len(rest)) // GROUP
        return out

    def sets(self) -> np.ndarray:
        """The set of each group: one each for the groups of one word, the others by neighbourhood."""
        group = np.arange(self.groups().max() + 1)
        return np.where(group < 2 + SINGLE, group, 2 + SINGLE + (group - 2 - SINGLE) // SET)

    def within(self) -> np.ndarray:
        """log10 of the total a word's count is divided by within its class; 0 for classes of one word."""
        total = np.log10(self.class_tokens + self.class_words + 1.0)
        total[: self.single] = 0.0
        total[OTHER_CLASS] = math.log10(self.class_tokens[OTHER_CLASS] + self.class_words[OTHER_CLASS] + 1.0)
        return total


def _threshold(histogram: pd.DataFrame, most: int) -> int:
    """The least count, of those in the histogram, that at most so many words reach; one more than all counts if none does."""
    histogram = histogram.sort_values("level", ascending=False)
    fits = histogram["level"][histogram["words"].cumsum() <= most]
    return int(fits.iloc[-1]) if len(fits) else 1 << 62


def build_vocabulary(counts: DataFrame, documents: int) -> Vocabulary:
    """``counts`` is a stored table of (word, c). The driver sees at most ``FREQUENT`` of its rows.

    The histogram keeps the first twelve binary digits of counts: at most 2^11 levels for each of 64 lengths.
    """
    level = F.expr("shiftleft(shiftright(c, greatest(length(bin(c)) - 12, 0)), greatest(length(bin(c)) - 12, 0))")
    histogram = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).toPandas()
    best = counts.where(F.col("c") >= _threshold(histogram, FREQUENT)).toPandas()
    ranked = sorted(((int(c), bytes(w)) for w, c in zip(best["word"], best["c"], strict=True)), key=lambda r: (-r[0], r[1]))
    frequent = {w: c for c, w in ranked}
    least = max(_threshold(histogram, min(WORD_CLASSES, FREQUENT)), LEAST)
    own = {w: 2 + k for k, (w, c) in enumerate(frequent.items()) if c >= least}

    def by_ending(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        words: Counter = Counter()
        for batch in batches:
            for w, c in zip(batch["word"], batch["c"], strict=True):
                if (word := bytes(w)) not in own:
                    e = ending(word)
                    total[e] += int(c)
                    words[e] += 1
        yield pd.DataFrame({"e": list(total), "c": pd.Series(list(total.values()), dtype="int64"), "v": [words[e] for e in total]})

    endings = stored(
        counts.mapInPandas(by_ending, "e binary, c long, v long").groupBy("e").agg(F.sum("c").alias("c"), F.sum("v").alias("v")), "lm-endings"
    )
    kept = endings.orderBy(F.col("c").desc(), "e").limit(ENDING_CLASSES).toPandas()
    rest = endings.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    first = 2 + len(own)
    ending_class = {bytes(e): first + k for k, e in enumerate(kept["e"])}
    n = first + len(ending_class)
    tokens_, words_ = np.zeros(n), np.ones(n)
    tokens_[END_CLASS] = documents
    for w, k in own.items():
        tokens_[k] = frequent[w]
    tokens_[first:], words_[first:] = kept["c"].to_numpy(dtype=float), kept["v"].to_numpy(dtype=float)
    tokens_[OTHER_CLASS], words_[OTHER_CLASS] = rest[0] - tokens_[first:].sum(), rest[1] - words_[first:].sum()
    return Vocabulary(frequent, own, ending_class, tokens_, words_)


class _Codes(dict):
    """Numbers of frequent words; any other word is listed in ``rare`` and gets its class's number."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__((w, k) for k, w in enumerate(vocabulary.counts))
        self._base, self._ending_class, self.rare = len(vocabulary.counts), vocabulary.ending_class, []

    def __missing__(self, word: bytes) -> int:
        self.rare.append(word)
        # words that are classes of their own are frequent
        return self._base + self._ending_class.get(ending(word), OTHER_CLASS)


_ENCODED = (
    "uid long, doc_id string, held_out boolean, n_tokens long, known long, logs double, within double, classes binary,"
    " rare array<struct<word:binary,n:int>>"
)


_NUMBERS = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, documents: int) -> DataFrame:
    """Per document: classes of its tokens, sums over its frequent words, and its rare words with their numbers.

    logs sums log10(c + 1) over the end and frequent words; within sums the part of it that belongs to
    words inside ending classes, less those classes' totals.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        # entry k: a frequent word; the entries after them: any rare word of a class
        code = _Codes(vocabulary)
        classes = np.array([vocabulary.class_of(w) for w in code] + list(range(vocabulary.classes)), dtype=np.uint16)
        logs = np.concatenate([np.log10(np.array(list(vocabulary.counts.values()), dtype=float) + 1.0), np.zeros(vocabulary.classes)])
        totals = vocabulary.within()
        shared = np.ones(vocabulary.classes, dtype=bool)
        shared[: vocabulary.single] = False
        shared[OTHER_CLASS] = True
        end_log = math.log10(documents + 1.0)
        for batch in batches:
            rows: list[tuple] = []
            # rare words of all documents one after the other, their numbers, and where each document's begin
            rare_words, rare_numbers, begins = [], [], [0]
            for text in _texts(batch):
                words = _split(text)
                code.rare = []
                found = np.fromiter(map(code.__getitem__, words), np.int64, len(words))
                rare = Counter(code.rare)
                kinds, values = classes[found], logs[found]
                inside = shared[kinds]
                rows.append(
                    (
                        at, len(words) + 1, len(words) - len(code.rare) + (documents > 0), float(values.sum()) + end_log,
                        float(values[inside].sum() - totals[kinds[inside]].sum()), np.append(kinds, np.uint16(END_CLASS)).astype("<u2").tobytes(),
                    )
                )
                rare_words += rare
                rare_numbers += rare.values()
                begins.append(len(rare_words))
                at += 1
            if not rows:
                continue
            uid, *numbers = (pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _NUMBERS, strict=True))
            counted = pa.StructArray.from_arrays([pa.array(rare_words, pa.binary()), pa.array(rare_numbers, pa.int32())], ["word", "n"])
            columns = [uid, batch.column("doc_id"), batch.column("held_out"), *numbers, pa.ListArray.from_arrays(pa.array(begins, pa.int32()), counted)]
            yield pa.RecordBatch.from_arrays(columns, ["uid", "doc_id", "held_out", "n_tokens", "known", "logs", "within", "classes", "rare"])

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), held_out().alias("held_out"), present(F.col("text")).alias("text"))
    return rows.mapInArrow(encode, _ENCODED)


_PARTS = "chunk long, share int, hits binary, moves binary"


def _averaged(parts: DataFrame, *by: str) -> DataFrame:
    """Sums of hits and means of moves, weighted by them, in tasks that hold one chunk at a time."""

    def average(parts: pd.DataFrame) -> pd.DataFrame:
        hits = moves = 0.0
        for h, m in zip(parts["hits"], parts["moves"], strict=True):
            weight = np.frombuffer(h, dtype="<f4").astype(float)[:, None]
            hits = hits + weight
            moves = moves + weight * np.frombuffer(m, dtype="<f2").reshape(len(weight), -1)
        mean = (moves / np.maximum(hits, 1)).astype("<f2").tobytes()
        return pd.DataFrame({"chunk": parts["chunk"][:1], "share": parts["share"][:1], "hits": [hits.astype("<f4").tobytes()], "moves": [mean]})

    return parts.groupBy(*by).applyInPandas(average, _PARTS)


def train(encoded: DataFrame, vocabulary: Vocabulary) -> LogBilinear:
    """Rounds of local training in as many tasks as there are cores, each followed by averaging the parameters.

    A row of parameters is averaged over the tasks that moved it, weighted by how often they did; a row
    that none did stays. Spark adds what tasks moved, first within shares of the tasks, so the driver
    sees one model. Between rounds parameters have 16 bits.
    """
    unigram, n = vocabulary.unigram(), vocabulary.classes
    model = LogBilinear.fresh(unigram, vocabulary.groups(), vocabulary.sets())
    width = model.held.shape[1]
    tasks = max(encoded.sparkSession.sparkContext.defaultParallelism, 1)
    sequences = encoded.where(~F.col("held_out")).select("classes").coalesce(tasks)
    for round_ in range(ROUNDS):
        start, groups, sets = model.held.astype("<f2"), model.groups, model.sets

        def local(batches: Iterator[pd.DataFrame], start=start, round_=round_) -> Iterator[pd.DataFrame]:
            begun = start.astype(np.float32)
            trainer = Trainer(LogBilinear(begun.copy(), groups, sets), unigram, seed=round_)
            for batch in batches:
                classes, places = every(batch["classes"], n, ROUNDS, round_)
                trainer.random.shuffle(places)
                for s in range(0, len(places), BATCH):
                    at = places[s : s + BATCH]
                    trainer.step(classes.take(at - 1), classes.take(at - 2), classes.take(at))
            moved = (trainer.model.held - begun).astype("<f2")
            for k, begin in enumerate(range(0, len(begun), CHUNK)):
                hits = trainer.hits[begin : begin + CHUNK].astype("<f4")
                if hits.any():
                    share = TaskContext.get().partitionId() % SHARES
                    moves = moved[begin : begin + CHUNK].tobytes()
                    yield pd.DataFrame({"chunk": [k], "share": [share], "hits": [hits.tobytes()], "moves": [moves]})

        parts = sequences.mapInPandas(local, _PARTS)
        if tasks > SHARES:
            parts = _averaged(parts, "chunk", "share")
        held = start.astype(np.float32)
        for part in _averaged(parts, "chunk").toLocalIterator():
            held[part.chunk * CHUNK : (part.chunk + 1) * CHUNK] += np.frombuffer(part.moves, dtype="<f2").reshape(-1, width)
        model = LogBilinear(held, groups, sets)
    return model


def model_scores(model: LogBilinear):
    """A column function from a document's classes to the log10 probability of the class sequence."""

    sent, groups, sets = model.held.astype("<f2"), model.groups, model.sets

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = LogBilinear(sent.astype(np.float32), groups, sets)
        scorer = Scorer(model)
        for batch in batches:
            kinds, begins = joined(batch)
            logs = scorer(*contexts(kinds, begins, model.words), kinds)
            yield pd.Series(np.add.reduceat(logs, begins) / math.log(10.0) if len(begins) else np.zeros(0))

    return F.pandas_udf(score, "double")


def score_language(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score per document.

    Takes doc_id and text; other columns are ignored. A null or empty text is the end alone. Repeated
    rows are scored each and count each in training. Without training documents every count is zero. An
    empty table gives an empty result.
    """
    learned = docs.where(~held_out()).select(present(F.col("text")).alias("text"))
    counts = stored(word_counts(learned), "lm-counts")
    documents = learned.count()
    facts = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    train_tokens, distinct = facts.n + documents, facts.v + (documents > 0)
    vocabulary = build_vocabulary(counts, documents)
    encoded = stored(encode_documents(docs, vocabulary, documents), "lm-documents")
    model = train(encoded, vocabulary)

    rare = encoded.select("uid", F.explode("rare").alias("r")).select("uid", F.col("r.word").alias("word"), F.col("r.n").alias("n"))
    counted = rare.join(counts, "word", "left")
    looked_up = counted.groupBy("uid").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("rare_logs"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known")
    )
    rows = encoded.drop("rare").withColumn("sequence", model_scores(model)("classes")).drop("classes").join(looked_up, "uid", "left")
    logs = F.coalesce("rare_logs", F.lit(0.0))
    # N + 1 * (V + 1)
    total = math.log10(train_tokens + distinct + 1)
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + logs - F.col("n_tokens") * F.lit(total)).alias("base_score"),
        (F.col("sequence") + F.col("within") + logs).alias("score"),
    )
