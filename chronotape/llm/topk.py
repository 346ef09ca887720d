"""Exact top-k by inner product with a three-phase uniform threshold.

A vector's dimensions are cut into segments, and a score is the sum of one partial score per segment.
Phase 1 gathers the best few of every segment's list and scores them in full; the k-th best score found
anywhere is a cutoff no worse than the true k-th. Phase 2 sends every query its cutoff: a candidate that
can reach it has at least one partial score of cutoff / segments, so each segment collects exactly those
entries, and bounds from the collected partial scores drop the hopeless. Phase 3 resolves the rest.

Queries and candidates meet in blocks of bounded size, each pair of blocks in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotape.llm.common import stored

SEGMENTS = 4
QUERY_BLOCK, CANDIDATE_BLOCK, CHUNK = 1_024, 4_096, 1_024
#: Lists of best scores that are merged per query at one level of the merge.
FAN_IN = 256


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, in double arithmetic."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def _whole(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


class Block:
    """Scores of one block of queries against one block of candidates, exact in 53 bits or as integers."""

    def __init__(self, queries: pd.DataFrame, candidates: pd.DataFrame, width: int, largest: int) -> None:
        # products of this size add up without rounding in floating point
        self.kind = np.float64 if width * largest * largest < 2**53 else object
        self.query_ids = queries["id"].to_numpy(dtype=np.int64)
        self.ids = candidates["c_id"].to_numpy(dtype=np.int64)
        self.q, self.c = self._matrix(queries["v"], width), self._matrix(candidates["c_v"], width)
        edges = np.linspace(0, width, min(SEGMENTS, max(width, 1)) + 1).astype(int)
        self.segments = list(zip(edges[:-1], edges[1:], strict=True))

    def _matrix(self, vectors: pd.Series, width: int) -> np.ndarray:
        out = np.zeros((len(vectors), width), dtype=self.kind)
        for k, v in enumerate(vectors):
            out[k, : len(v)] = v
        return out

    def chunks(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids, partial scores (segment, query, candidate) and which pairs count, for some candidates at a time."""
        for start in range(0, len(self.ids), CHUNK):
            part, ids = self.c[start : start + CHUNK], self.ids[start : start + CHUNK]
            partial = np.stack([self.q[:, a:b].dot(part[:, a:b].T) for a, b in self.segments])
            yield ids, partial, self.query_ids[:, None] != ids[None, :]


def _ranked(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of each row's k best entries: high scores first, small ids first among equals."""
    order = np.lexsort((ids, -scores, rows))
    grouped = rows[order]
    starts = np.r_[0, np.flatnonzero(np.diff(grouped)) + 1] if len(grouped) else np.zeros(0, int)
    within = np.arange(len(grouped)) - np.repeat(starts, np.diff(np.r_[starts, len(grouped)]))
    return order[within < k]


def _entries(block: Block, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> pd.DataFrame:
    if block.kind is object:
        scores = np.clip(scores.astype(object), -(2**63), 2**63 - 1)
    best = _ranked(rows, ids, scores, k)
    return pd.DataFrame({"query_id": block.query_ids[rows[best]], "vec_id": ids[best], "score": pd.Series(scores[best], dtype="int64")})


def local_lists(block: Block, k: int) -> pd.DataFrame:
    """Phase 1: the full scores of the k best entries of every segment's list; k of them per query at most."""
    rows, ids, scores = [], [], []
    for chunk_ids, partial, counts in block.chunks():
        listed = np.zeros(counts.shape, dtype=bool)
        for one in partial:
            keyed = np.where(counts, one, -np.inf).astype(float)
            top = np.argpartition(-keyed, min(k, keyed.shape[1]) - 1, axis=1)[:, :k]
            np.put_along_axis(listed, top, True, axis=1)
        r, c = np.nonzero(listed & counts)
        rows.append(r), ids.append(chunk_ids[c]), scores.append(partial.sum(axis=0)[r, c])
    return _entries(block, np.concatenate(rows), np.concatenate(ids), np.concatenate(scores), k)


def above_cutoff(block: Block, cutoff: np.ndarray, k: int) -> pd.DataFrame:
    """Phases 2 and 3: entries some segment collects, bounded, then resolved; k per query at most.

    ``cutoff`` has one value per query, minus infinity where fewer than k candidates are known.
    """
    m = len(block.segments)
    share = (cutoff / m)[:, None]
    rows, ids, scores = [], [], []
    for chunk_ids, partial, counts in block.chunks():
        sent = partial >= share
        collected = sent.any(axis=0) & counts
        # a segment that did not send an entry holds less than its share
        bound = np.where(sent, partial, share).sum(axis=0)
        r, c = np.nonzero(collected & (bound >= cutoff[:, None]))
        full = partial[:, r, c].sum(axis=0)
        keep = full >= cutoff[r]
        rows.append(r[keep]), ids.append(chunk_ids[c[keep]]), scores.append(full[keep])
    return _entries(block, np.concatenate(rows), np.concatenate(ids), np.concatenate(scores), k)


def _merged(entries: DataFrame, k: int) -> DataFrame:
    """query_id and its k best (score, vec_id) in order, merged in two levels so that no list is long."""
    entry = F.struct((-F.col("score")).alias("s"), "vec_id")
    first = entries.groupBy("query_id", F.pmod(F.xxhash64("vec_id"), F.lit(FAN_IN)).alias("part")).agg(F.sort_array(F.collect_list(entry)).alias("l"))
    best = first.select("query_id", F.slice("l", 1, k).alias("l")).groupBy("query_id").agg(F.sort_array(F.flatten(F.collect_list("l"))).alias("l"))
    return best.select("query_id", F.slice("l", 1, k).alias("best"))


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: every query's k best other rows, ties to the smaller vec_id.

    Takes vec_id and embedding; other columns are ignored. Rows whose vector is null, or holds null or
    non-finite components, and rows without an id take no part. Components that a shorter vector lacks
    count as zero. A query does not meet rows of its own id; otherwise repeated rows count each. With
    fewer than k candidates all are returned. Scores beyond 64 bits are cut to that range.
    """
    sound = vectors.where(F.col("vec_id").isNotNull() & _whole(F.col("embedding")))
    rows = stored(sound.select(F.col("vec_id").cast("long").alias("id"), quantised(F.col("embedding"), scale).alias("v"), is_query.alias("q")), "topk-vectors")
    least = F.array_min("v")
    facts = rows.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.col("q").cast("long")), F.lit(0)).alias("nq"), F.max(F.size("v")).alias("width"),
        F.max(F.greatest(F.abs(F.array_max("v")), F.abs(least))).alias("largest"),
    ).first()  # one row
    width, largest = facts.width or 1, facts.largest or 0
    query_blocks, blocks = max(1, -(-facts.nq // QUERY_BLOCK)), max(1, -(-facts.n // CANDIDATE_BLOCK))

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        spread = df.withColumn(own, F.pmod(F.monotonically_increasing_id(), F.lit(n_own)).cast("int"))
        return spread.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))

    # new names, so that the two sides of a pairing share no column
    candidates = dealt(rows.select(F.col("id").alias("c_id"), F.col("v").alias("c_v")), "cb", blocks, "qb", query_blocks)

    def paired(queries: DataFrame, score) -> DataFrame:
        def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
            return score(Block(left, right, width, largest), left)

        both = dealt(queries, "qb", query_blocks, "cb", blocks).groupBy("qb", "cb").cogroup(
            candidates.withColumnsRenamed({"qb": "c_qb", "cb": "c_cb"}).groupBy("c_qb", "c_cb")
        )
        return both.applyInPandas(meet, "query_id long, vec_id long, score long")

    queries = rows.where("q").select("id", "v")
    found = _merged(paired(queries, lambda block, left: local_lists(block, k)), k)
    cutoffs = stored(
        found.select(F.col("query_id").alias("__q"), F.when(F.size("best") >= k, -F.element_at("best", -1)["s"]).alias("cutoff")), "topk-cutoffs"
    ).dropDuplicates(["__q"])
    armed = queries.join(cutoffs, F.col("id") == F.col("__q"), "left").select("id", "v", F.coalesce(F.col("cutoff").cast("double"), F.lit(float("-inf"))).alias("cutoff"))
    resolved = paired(armed, lambda block, left: above_cutoff(block, left["cutoff"].to_numpy(dtype=float), k))
    listed = _merged(resolved, k).select("query_id", F.posexplode("best").alias("at", "e"))
    return listed.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"), (-F.col("e.s")).alias("score"))
