"""A log-bilinear language model, trained by noise-contrastive estimation in numpy and normalised down a tree of words.

The prediction vector is a weighted sum of the vectors of the two words before; its product with an
output vector plus a bias is a score. A word's probability is that of its set, normalised over all sets,
times that of its group in the set, normalised over the set's groups, times that of the word in its
group, normalised over the group's words. All are products of two matrices, and far smaller ones than a
product with every word. Without sets, groups are normalised over all groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

DIMENSIONS, BATCH, RATE = 32, 1_024, 0.1
#: Noise of a batch: words, then groups, then sets; batches whose noise is drawn together.
NOISE, DRAWN = (64, 32, 32), 256
#: Squared gradient that every parameter starts with: small, or the rows of rare words would hardly move.
FIRST_SQUARE = 1e-5
CONTEXT = 2
#: Places scored together.
BLOCK = 1 << 17
#: Places whose scores are made at once, so that they stay in a core's cache.
CACHED = 2_048
#: The exponentials of scores of at most this size, and sums of 65,535 of them, are normal 32-bit numbers.
SMALL = 75.0


@dataclass
class LogBilinear:
    """All parameters as rows of ``held``: the inputs of the words and of the mark before a text, the
    outputs of the words, of the groups and of the sets, and a weight for each context position. The last
    column is the bias of an output and unused elsewhere. ``groups`` has the group of each word, ``sets``
    the set of each group, if there are sets.
    """

    held: np.ndarray
    groups: np.ndarray
    sets: np.ndarray | None = None

    @classmethod
    def fresh(cls, unigram: np.ndarray, groups: np.ndarray, sets: np.ndarray | None = None, seed: int = 0) -> LogBilinear:
        random, n = np.random.default_rng(seed), len(unigram)
        shares = np.concatenate(cls(np.empty(0), groups, sets).shares(unigram))
        held = random.normal(0, 0.1, (n + 1 + len(shares) + CONTEXT, DIMENSIONS + 1))
        held[: n + 1, -1] = 0
        held[n + 1 : -CONTEXT, -1] = np.log(shares)
        held[-CONTEXT:] = 0.5
        return cls(held.astype(np.float32), groups, sets)

    @property
    def parents(self) -> list[np.ndarray]:
        return [self.groups] if self.sets is None else [self.groups, self.sets]

    def nodes(self) -> list[np.ndarray]:
        """Of each word: itself, its group and its set."""
        out = [np.arange(self.words)]
        for parent in self.parents:
            out.append(parent[out[-1]])
        return out

    def shares(self, unigram: np.ndarray) -> list[np.ndarray]:
        """The shares of words, groups and sets from those of words."""
        out = [unigram]
        for parent in self.parents:
            out.append(np.bincount(parent, weights=out[-1]))
        return out

    @property
    def words(self) -> int:
        return len(self.groups)

    @property
    def inputs(self) -> np.ndarray:
        return self.held[: self.words + 1, :DIMENSIONS]

    @property
    def outputs(self) -> np.ndarray:
        """Of the words, then of the groups, then of the sets."""
        return self.held[self.words + 1 : -CONTEXT]

    @property
    def gates(self) -> np.ndarray:
        return self.held[-CONTEXT:, :DIMENSIONS]

    def predicted(self, before: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        """Prediction vectors, with a one for the bias."""
        out, other = self.held.take(before, axis=0), self.held.take(earlier, axis=0)
        gate, other_gate = self.held[-CONTEXT:]
        out *= gate
        other *= other_gate
        out += other
        out[:, -1] = 1
        return out


class Scorer:
    """Natural logarithms of normalised probabilities."""

    def __init__(self, model: LogBilinear) -> None:
        self.model, self.nodes = model, model.nodes()
        first = np.cumsum([0] + [len(parent) for parent in model.parents])
        self.top = np.ascontiguousarray(model.outputs[first[-1] :].T)
        #: Words in the order of their groups and sets: the number of each.
        self.rank = np.empty(model.words, dtype=np.uint16)
        self.rank[np.lexsort(self.nodes)] = np.arange(model.words)
        #: For each level below the top: of each parent of several, its children's output vectors; everyone's place there.
        self.levels = []
        for at, parent in zip(first, model.parents, strict=False):
            order = np.argsort(parent, kind="stable")
            ends = np.cumsum(np.bincount(parent))
            place, members = np.empty(len(parent), dtype=np.int64), {}
            for g, (begin, end) in enumerate(zip(np.r_[0, ends[:-1]], ends, strict=True)):
                own = order[begin:end]
                place[own] = np.arange(len(own))
                if len(own) > 1:
                    members[g] = np.ascontiguousarray(model.outputs[at + own].T)
            self.levels.append((parent, place, members))

    def __call__(self, before: np.ndarray, earlier: np.ndarray, target: np.ndarray) -> np.ndarray:
        out = np.empty(len(target), dtype=np.float64)
        for s in range(0, len(target), BLOCK):
            cut = slice(s, s + BLOCK)
            out[cut] = self._block(before[cut], earlier[cut], target[cut])
        return out

    def _block(self, before: np.ndarray, earlier: np.ndarray, target: np.ndarray) -> np.ndarray:
        # places of one group, and of one set, one after the other
        order = np.argsort(self.rank[target], kind="stable")  # a radix sort for 16-bit numbers
        target = target[order]
        x = self.model.predicted(before[order], earlier[order])
        # scores of the nodes taken, and what their exponentials are divided by
        wanted, sums = np.zeros(len(target), dtype=np.float32), np.ones(len(target), dtype=np.float32)
        top = self.nodes[-1][target]
        for s in range(0, len(target), CACHED):
            cut = slice(s, s + CACHED)
            wanted[cut], sums[cut] = _chosen(x[cut] @ self.top, top[cut])
        out = wanted - np.log(sums).astype(np.float64)
        for (parent, place, members), node in zip(self.levels, self.nodes, strict=False):
            node = node[target]
            of, column = parent[node], place[node]
            wanted[:], sums[:] = 0, 1
            begins = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            for g, begin, end in zip(of[begins].tolist(), begins.tolist(), [*begins[1:].tolist(), len(of)], strict=True):
                own = members.get(g)
                if own is not None:
                    for s in range(begin, end, CACHED):
                        cut = slice(s, min(s + CACHED, end))
                        wanted[cut], sums[cut] = _chosen(x[cut] @ own, column[cut])
            out += wanted
            out -= np.log(sums)
        back = np.empty_like(out)
        back[order] = out
        return back


def _chosen(scores: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row, the score in one column and the sum of all exponentials, both less the same shift."""
    wanted = scores.take(np.arange(0, scores.size, scores.shape[1]) + column)
    wanted -= _shifted(scores, wanted)
    np.exp(scores, out=scores)
    return wanted, _row_sums(scores)


def _shifted(scores: np.ndarray, some: np.ndarray) -> np.ndarray | float:
    """Lower each row by its largest score, unless none is above SMALL and ``some``, one of each row, are all above -SMALL."""
    if scores.max(initial=0) < SMALL and some.min(initial=0) > -SMALL:
        return 0.0
    top = scores.max(axis=1)
    scores -= top[:, None]
    return top


def _row_sums(values: np.ndarray) -> np.ndarray:
    return values @ np.ones(values.shape[1], dtype=values.dtype)


def joined(texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words of several texts (16-bit numbers, none of them empty) one after the other, and where each begins."""
    held = [bytes(t) for t in texts]
    lengths = np.array([len(t) // 2 for t in held], dtype=np.int64)
    return np.frombuffer(b"".join(held), dtype="<u2"), np.cumsum(lengths) - lengths


def contexts(classes: np.ndarray, begins: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The word before and the one before that, for each place of texts that begin at ``begins``."""
    before, earlier = np.empty_like(classes), np.empty_like(classes)
    before[1:], earlier[2:] = classes[:-1], classes[:-2]
    before[begins], earlier[begins] = start, start
    second = begins + 1
    earlier[second[second < len(classes)]] = start  # a text of one place has no second, and the next text's first is set below
    earlier[begins] = start
    return before, earlier


def every(texts: Iterable[bytes], start: int, step: int, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of several texts, each after CONTEXT marks ``start``, and where in them every ``step``-th place of each text is."""
    held, mark = [bytes(t) for t in texts], np.full(CONTEXT, start, dtype="<u2").tobytes()
    lengths = np.array([len(t) // 2 for t in held], dtype=np.int64)
    begins = np.cumsum(lengths + CONTEXT) - lengths
    counts = (lengths - first + step - 1) // step
    at = np.repeat(begins + first - step * (np.cumsum(counts) - counts), counts)
    at += np.arange(0, step * len(at), step)
    return np.frombuffer(mark + mark.join(held), dtype="<u2"), at


class Trainer:
    """Stochastic gradient steps with a rate for each row of parameters, all noise of a batch shared.

    Words, groups and sets are each told from ones drawn by frequency; their scores, comparable over all
    of a kind, are so within each parent. A word alone below its top has the top's probability, so only
    tops are told for it, and what is below them is drawn from the others. ``hits`` counts the steps that
    moved each row of parameters.
    """

    def __init__(self, model: LogBilinear, unigram: np.ndarray, seed: int) -> None:
        self.model, self.random = model, np.random.default_rng(seed)
        nodes, first = model.nodes(), 0
        self.alone = np.bincount(nodes[-1])[nodes[-1]] == 1
        #: For words, groups and sets: each word's row among the outputs, and the logarithm of how often that is drawn;
        #: rows to draw, the logarithms of how often, their cumulated shares, and how many are drawn.
        self.levels, self.draws, self._noise = [], [], iter(())
        for node, share, count in zip(nodes, model.shares(unigram), NOISE, strict=False):
            told = share.copy()
            if node is not nodes[-1]:
                told[node[self.alone]] = 0
            rows = np.flatnonzero(told)
            with np.errstate(divide="ignore"):
                log_noise = np.log(count * told / max(told.sum(), 1e-300)).astype(np.float32)
            self.levels.append(((first + node).astype(np.uint16), log_noise[node]))
            self.draws.append(((first + rows).astype(np.uint16), log_noise[rows], np.cumsum(told[rows]), count))
            first += len(share)
        self.hits = np.zeros(len(model.held), dtype=np.int64)
        self._squares = np.full(len(model.held), FIRST_SQUARE, dtype=np.float32)

    def _drawn(self) -> tuple[np.ndarray, ...]:
        """The rows that are a batch's noise and the logarithms of how often they are drawn: at the top, then below it."""
        drawn = next(self._noise, None)
        if drawn is None:
            batches = []
            for rows, log_noise, share, count in self.draws:
                at = np.searchsorted(share, np.sort(self.random.random(DRAWN * count if len(rows) else 0)) * share[-1:].sum())
                at = self.random.permutation(np.minimum(at, len(rows) - 1)).reshape(DRAWN, -1)
                batches.append((rows[at], log_noise[at]))
            below = [np.concatenate(arrays, axis=1) for arrays in zip(*batches[:-1], strict=True)]
            self._noise = zip(*batches[-1], *below, strict=True)
            drawn = next(self._noise)
        return drawn

    def step(self, before: np.ndarray, earlier: np.ndarray, target: np.ndarray) -> None:
        m, n = self.model, len(target)
        # words that are alone come last
        alone = self.alone.take(target)
        order = np.concatenate([np.flatnonzero(~alone), np.flatnonzero(alone)])
        before, earlier, target = before.take(order), earlier.take(order), target.take(order)
        several = n - np.count_nonzero(alone)
        # whole rows: inputs have a further column, which stays what it is
        x1, x2 = m.held.take(before, axis=0), m.held.take(earlier, axis=0)
        gate1, gate2 = m.held[-CONTEXT:]
        x = x1 * gate1
        x += x2 * gate2
        x[:, -1] = 1
        back = np.zeros_like(x)
        top_noise, top_logs, noise, logs = self._drawn()
        length = n + len(top_noise) + (len(self.levels) - 1) * several + len(noise)
        rows, moves, end = np.empty(length, dtype=np.uint16), np.empty((length, DIMENSIONS + 1), dtype=np.float32), 0
        for k, levels, noise, logs in ((n, self.levels[-1:], top_noise, top_logs), (several, self.levels[:-1], noise, logs)):
            if not k:
                continue
            # ascent directions of the log-likelihood of telling data from noise
            xs, words, others = x[:k], target[:k], m.outputs.take(noise, axis=0)
            down = _told(xs @ others.T, logs, -1)
            back[:k] += down @ others
            begin, end = end, end + len(noise)
            rows[begin:end] = noise
            np.matmul(down.T, xs, out=moves[begin:end])
            for row_of, log_told in levels:
                begin, end = end, end + k
                row_of.take(words, out=rows[begin:end], mode="clip")
                real = m.outputs.take(rows[begin:end], axis=0)
                up = _told(np.einsum("ij,ij->i", xs, real), log_told.take(words), 1)[:, None]
                np.multiply(xs, up, out=moves[begin:end])
                real *= up
                back[:k] += real
        back[:, -1] = 0
        outputs, up = _summed(rows[:end], moves[:end])
        down = np.empty((CONTEXT * n, DIMENSIONS + 1), dtype=np.float32)
        np.multiply(back, gate1, out=down[:n])
        np.multiply(back, gate2, out=down[n:])
        inputs, down = _summed(np.concatenate([before, earlier]), down)
        x1 *= back
        x2 *= back
        gates = np.ones((1, n), dtype=np.float32) @ np.concatenate([x1, x2], axis=1)
        at = np.concatenate([outputs + np.int64(m.words + 1), inputs, np.arange(len(m.held) - CONTEXT, len(m.held))])
        self._climb(at, np.concatenate([up, down, gates.reshape(CONTEXT, -1)]), n)

    def _climb(self, rows: np.ndarray, gradient: np.ndarray, n: int) -> None:
        """Move the given rows uphill, each at its own rate."""
        squares = self._squares[rows]
        squares += np.einsum("ij,ij->i", gradient, gradient) / np.float32(n * n * gradient.shape[1])
        self._squares[rows] = squares
        gradient *= (np.float32(RATE / n) / np.sqrt(squares))[:, None]
        gradient += self.model.held.take(rows, axis=0)
        self.model.held[rows] = gradient
        self.hits[rows] += 1


def _told(scores: np.ndarray, log_noise: np.ndarray, sign: int) -> np.ndarray:
    """How far data (sign 1) or noise (sign -1) is from being told as what it is, with that sign; changes ``scores``."""
    np.subtract(*((scores, log_noise) if sign == 1 else (log_noise, scores)), out=scores)
    with np.errstate(over="ignore"):
        np.exp(scores, out=scores)
    scores += 1
    return np.divide(sign, scores, out=scores)


def _summed(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct row numbers, and the sums of ``values`` by them."""
    order = np.argsort(rows, kind="stable")  # a radix sort for 16-bit numbers
    ordered = rows[order]
    begins = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    lengths = np.diff(np.r_[begins, len(ordered)])
    out = values.take(order[begins], axis=0)
    several = lengths > 1
    if several.any():
        # rows that occur once need no sum
        kept = np.repeat(several, lengths)
        starts = np.cumsum(lengths[several]) - lengths[several]
        out[several] = np.add.reduceat(values.take(order[kept], axis=0), starts, axis=0)
    return ordered[begins], out
