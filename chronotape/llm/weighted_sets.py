"""Texts as weighted sets of word shingles: hashes, TF-IDF weights, consistent samples, similarity.

Weights are counts times smoothed inverse document frequencies, the latter looked up by hash bucket.
The table has a fixed number of buckets whatever the corpus, and a bucket's noise is a share of the
documents that depends on their length and not on how many there are.
"""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
#: Buckets of the document-frequency table, as a power of two.
FREQUENCY_BITS = 14
#: Signature: bands of so many samples each.
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
#: Rows of precomputed draws, as a power of two, and columns drawn from the same bits of a hash.
DRAW_BITS, GROUP = 14, 16
MEMORY = 100_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashes of a text's runs of five words and their counts. Shorter texts are one shingle; texts without words have none."""

    def __init__(self) -> None:
        self._words: dict[bytes, int] = {}

    def _hashes(self, text: str) -> np.ndarray:
        # white space of bytes is exactly space, tab, newline, VT, FF and CR
        words, known = text.encode("utf-8", "surrogatepass").split(), self._words
        out = list(map(known.get, words))
        for k, h in enumerate(out):
            if h is None:
                out[k] = h = xxhash.xxh3_64_intdigest(words[k])
                if len(known) < MEMORY and len(words[k]) < 64:
                    known[words[k]] = h
        return np.array(out, dtype=np.uint64)

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = self._hashes(text)
        if not len(words):
            return words, np.zeros(0, dtype=np.int64)
        size = min(SHINGLE, len(words))
        n = len(words) - size + 1
        h = np.full(n, size, dtype=np.uint64)
        for k in range(size):
            h = h * _GOLDEN + words[k : k + n]
        h = np.sort(mixed(h))
        starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        return h[starts], np.diff(np.r_[starts, n])


def buckets(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64)


def inverse_frequencies(counts: np.ndarray, documents: int) -> np.ndarray:
    """1 + log((documents + 1) / (bucket's documents + 1)): never below 1."""
    return 1.0 + np.log((documents + 1.0) / (np.minimum(counts, documents) + 1.0))


def weights(shingles: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return counts * idf[buckets(shingles)]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of (sorted shingles, weights): the sum of minima over the sum of maxima."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    _, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = float(np.minimum(a[1][at], b[1][bt]).sum())
    return shared / (float(a[1].sum()) + float(b[1].sum()) - shared)


class ConsistentSampler:
    """Improved consistent weighted sampling: two sets draw the same sample with the probability of their
    weighted Jaccard similarity.

    The draws r, c (gamma 2, 1) and beta (uniform) of a shingle come from tables indexed by bits of its
    hash, other bits for each group of samples; within a text, shingles with equal draws and weights are
    told apart by their hash.
    """

    def __init__(self, seed: int = 0) -> None:
        random = np.random.default_rng(seed)
        shape = (SAMPLES // GROUP, 1 << DRAW_BITS, GROUP)
        r, log_c = random.gamma(2.0, 1.0, shape), np.log(random.gamma(2.0, 1.0, shape))
        #: By group and row: the draws r, beta and log c of the group's samples.
        self.draws = np.concatenate([r, random.random(shape), log_c], axis=2).astype(np.float32)

    def samples(self, shingles: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """One 64-bit identifier per sample."""
        log_w = np.log(weight).astype(np.float32)[:, None]
        out = []
        for g, draws in enumerate(self.draws):
            at = ((shingles >> np.uint64(DRAW_BITS * g)) & np.uint64((1 << DRAW_BITS) - 1)).astype(np.intp)
            drawn = draws.take(at, axis=0)
            r, beta, log_c = drawn[:, :GROUP], drawn[:, GROUP : 2 * GROUP], drawn[:, 2 * GROUP :]
            t = np.floor(log_w / r + beta)
            log_a = log_c - r * (t - beta + np.float32(1.0))
            first = np.ascontiguousarray(log_a.T).argmin(axis=1)
            step = t[first, np.arange(GROUP)].astype(np.int64).astype(np.uint64)
            out.append(mixed(shingles[first] + step * _GOLDEN))
        return np.concatenate(out)

    @staticmethod
    def bands(samples: np.ndarray) -> np.ndarray:
        """One signed 64-bit key per band; keys of different bands differ."""
        rows = samples.reshape(BANDS, ROWS)
        key = np.arange(1, BANDS + 1, dtype=np.uint64)
        for k in range(ROWS):
            key = mixed(key * _GOLDEN + rows[:, k])
        return key.view(np.int64)

    @staticmethod
    def sketch(samples: np.ndarray) -> bytes:
        """16 bits of every sample, to estimate similarities."""
        return (samples & np.uint64(0xFFFF)).astype("<u2").tobytes()
