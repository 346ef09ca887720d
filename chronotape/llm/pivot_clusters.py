"""Centroid clustering of integer vectors with a LAESA pivot table.

The distances of every vector to a few fixed pivots are computed once and stored beside it. In each
round the distances from pivots to centroids are known as well, and by the triangle inequality the
largest difference of the two bounds the distance to every centroid from below. A vector visits its
centroids in the order of these bounds and computes an exact integer distance only where the bound does
not exceed the best distance so far; equal bounds survive, so ties stay exact.

Centroids, pivots and their distances are a few thousand numbers and travel with the tasks. A task
returns one row of sums per cluster, so a cluster that holds most vectors is no heavier than others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotape.llm.common import stored

PIVOTS = 12
#: The bounded sample, in hash order, from which pivots are chosen far apart. It bounds work, never results.
PIVOT_SAMPLE = 256
#: A bound computed in floating point is lowered by this share of its terms.
SLACK = 1e-9
MOST = 2**63 - 1

ROW = "vec_id long, v array<long>, p array<double>"
SUMS = "cluster int, n long, total array<string>"
ASSIGNED = "vec_id long, cluster int, distance long"


def matrix(vectors: pd.Series | list, width: int, kind: type) -> np.ndarray:
    if not len(vectors):
        return np.zeros((0, width), dtype=kind)
    if kind is object:  # Python numbers, where 64 bits could overflow
        return np.array([[int(x) for x in v] for v in vectors], dtype=object).reshape(-1, width)
    return np.concatenate([np.asarray(v, dtype=kind) for v in vectors]).reshape(-1, width)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances between rows of a and rows of b, which may be a single one."""
    difference = a - b
    return (difference * difference).sum(axis=1)


def roots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of every row of a to every row of b, in floating point."""
    return np.stack([np.sqrt(squared(a, one).astype(np.float64)) for one in b], axis=1)


@dataclass(frozen=True)
class Round:
    """What a task needs to assign vectors: the centroids and their distances to the pivots."""

    centroids: np.ndarray
    to_pivots: np.ndarray

    def assign(self, v: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid (ties: the smaller number), its squared distance, and how many distances were computed."""
        lower = np.zeros((len(v), len(self.centroids)))
        for own, far in zip(p.T, self.to_pivots.T, strict=True):
            gap = np.abs(own[:, None] - far[None, :]) - SLACK * (own[:, None] + far[None, :])
            np.maximum(lower, gap, out=lower)
        lower = lower * lower * (1 - SLACK)
        order = np.argsort(lower, axis=1, kind="stable")
        best = np.full(len(v), len(self.centroids))
        least = np.zeros(len(v), dtype=v.dtype)
        computed = 0
        for at in order.T:
            known = best < len(self.centroids)
            bound = lower[np.arange(len(v)), at]
            rows = np.flatnonzero(~known | (bound <= least.astype(np.float64) * (1 + SLACK)))
            if not len(rows):
                break  # bounds only grow along the order
            exact = squared(v[rows], self.centroids[at[rows]])
            computed += len(rows)
            better = ~known[rows] | (exact < least[rows]) | ((exact == least[rows]) & (at[rows] < best[rows]))
            least[rows[better]], best[rows[better]] = exact[better], at[rows][better]
        return best, least, computed


def _whole(vector: Column, width: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == width) & finite, F.lit(False))


def chosen_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows of the sample, each as far as can be from those before it."""
    taken = [0]
    nearest = squared(sample, sample[0])
    while len(taken) < min(count, len(sample)):
        taken.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(sample, sample[taken[-1]]))
    return sample[taken]


def cluster_vectors(
    vectors: DataFrame, clusters: int = 16, rounds: int = 3, width: int = 64, scale: int = 64, seed: int = 1, pivots: int = PIVOTS
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every sound vector.

    Takes vec_id and embedding; other columns are ignored. Vectors that are null, of another width or
    hold null or non-finite components take no part; components become floor(scale * x), held in 64 bits.
    Centroids start as the vectors with the smallest SHA-256 of ``seed:vec_id`` (null ids last, equal ids
    by components), all of them if there are fewer. A round assigns every vector to its nearest centroid
    and moves each centroid that has vectors to the floor of their mean; a last assignment follows.
    Repeated rows count each, an empty table gives an empty result, and distances and sums beyond 64
    bits are cut to that range.
    """
    mark = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("vec_id").cast("string")), 256)
    components = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    sound = vectors.where(_whole(F.col("embedding"), width)).select(F.col("vec_id").cast("long").alias("vec_id"), components.alias("v"))
    # at most PIVOT_SAMPLE rows
    first = sound.orderBy(F.col("vec_id").isNull(), mark, "v").limit(max(PIVOT_SAMPLE, clusters)).select("v").collect()
    largest = sound.agg(F.max(F.greatest(F.abs(F.array_max("v").cast("decimal(38,0)")), F.abs(F.array_min("v").cast("decimal(38,0)"))))).first()[0]
    exact = width * (2 * int(largest or 0) + 1) ** 2 < 2**62
    kind = np.int64 if exact else object
    sample = matrix([row.v for row in first], width, kind)
    centroids = sample[:clusters].copy()
    fixed = chosen_pivots(sample, pivots) if len(sample) else sample

    def table_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(p=list(roots(matrix(batch["v"], width, kind), fixed)))

    table = stored(sound.mapInPandas(table_rows, ROW), "pivot-table")

    def assigned(batches: Iterator[pd.DataFrame], now: Round) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches:
            if len(batch):
                v = matrix(batch["v"], width, kind)
                best, least, _ = now.assign(v, matrix(batch["p"], len(fixed), np.float64))
                yield batch, v, best, least

    def moved(now: Round) -> np.ndarray:
        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            n = np.zeros(len(now.centroids), dtype=np.int64)
            # Python numbers, so that the sums of a task never overflow
            total = np.zeros((len(now.centroids), width), dtype=object)
            for _, v, best, _ in assigned(batches, now):
                for c in np.unique(best):
                    held = v[best == c]
                    n[c] += len(held)
                    total[c] += held.sum(axis=0).astype(object)
            held = np.flatnonzero(n)
            yield pd.DataFrame({"cluster": held.astype(np.int32), "n": n[held], "total": [[str(x) for x in total[c]] for c in held]})

        partial = table.mapInPandas(sums, SUMS).select("cluster", "n", F.posexplode("total").alias("at", "x"))
        summed = partial.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).cast("string").alias("x"))
        centroids = now.centroids.copy()
        for row in summed.collect():  # one number per cluster and component
            centroids[row.cluster, row["at"]] = int(row.x) // row.n
        return centroids

    def with_pivots(centroids: np.ndarray) -> Round:
        return Round(centroids, roots(centroids, fixed) if len(centroids) else np.zeros((0, 0)))

    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(with_pivots(centroids))
    final = with_pivots(centroids)

    def labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, _, best, least in assigned(batches, final):
            # a sum with a distance beyond 64 bits is cut as well, whatever that distance is
            held = np.minimum(least, MOST).astype(np.int64)
            yield pd.DataFrame({"vec_id": batch["vec_id"].astype("Int64"), "cluster": best.astype(np.int32), "distance": held})

    out = stored(table.mapInPandas(labelled, ASSIGNED), "pivot-clusters")
    inertia = out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total"))
    totals = {r.cluster: int(r.total) for r in inertia.collect()}  # one row per cluster
    digests = [hashlib.sha256(",".join(str(x) for x in c).encode()).hexdigest() for c in centroids]
    # one row per cluster, so it may be broadcast
    facts = vectors.sparkSession.createDataFrame(
        [(c, min(totals.get(c, 0), MOST), digest) for c, digest in enumerate(digests)], "__c int, cluster_inertia long, centroid_sha256 string"
    )
    everything = F.lit(min(sum(totals.values()), MOST)).cast("long").alias("inertia")
    return out.join(F.broadcast(facts), F.col("cluster") == F.col("__c")).select("vec_id", "cluster", "distance", "cluster_inertia", everything, "centroid_sha256")
