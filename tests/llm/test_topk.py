import math

import numpy as np
from pyspark.sql import functions as F

from chronotape.llm import topk
from chronotape.llm.topk import exact_top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, k):
    sound = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, q in sound:
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in sound if j != i)[:k]
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(best)]
    return sorted(out)


def run(spark, rows, k=5):
    frame = spark.createDataFrame([(i, v, 0, "mine") for i, v in rows], SCHEMA)
    return sorted(map(tuple, exact_top_k(frame, F.col("vec_id") % 50 == 0, k).collect()))


def vectors(n, width, seed=0):
    random = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in random.normal(0, 0.2, width)]) for i in range(n)]


def test_equals_all_scores_with_ties_nulls_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rows = vectors(400, 8)
    rows += [(1_000 + k, rows[7][1]) for k in range(120)]  # a third are equal
    rows += [(2_000, None), (2_050, [0.1, None] + [0.0] * 6), (2_100, [float("nan")] * 8), (2_150, [float("inf")] + [0.0] * 7), (None, rows[3][1]), (2_200, [0.0] * 8)]
    assert run(spark, rows) == brute(rows, 5)


def test_few_rows(spark):
    assert run(spark, vectors(3, 4)) == brute(vectors(3, 4), 5)
    assert run(spark, vectors(1, 4)) == [] == run(spark, [])
    assert run(spark, [(1, [0.5]), (2, [0.25])]) == []


def test_repeated_rows_count_each(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.1, 0.0])]
    assert run(spark, rows) == brute(rows, 5)


def scaled(scale):
    return [(i, [float(np.float32(x * scale)) for x in v]) for i, v in vectors(60, 4, 5)]


def test_scores_too_large_for_floating_point(spark):
    assert run(spark, scaled(1e6)) == brute(scaled(1e6), 5)


def test_scores_beyond_64_bits_are_cut(spark):
    got = run(spark, scaled(1e15))
    assert len(got) == 10 and {s for *_, s in got} == {2**63 - 1}
