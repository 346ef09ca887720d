import hashlib
import math

import numpy as np
import pytest

from chronotape.llm import pivot_clusters
from chronotape.llm.pivot_clusters import Round, cluster_vectors, roots, squared

SCHEMA = "vec_id long, embedding array<float>, cluster string, label int"


def brute(rows, clusters, rounds, width, scale=64):
    whole = lambda v: v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    long = lambda x: max(-(2**63), min(2**63 - 1, x))
    kept = [(i, [long(math.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows if whole(v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:clusters]]

    def assign():
        out = []
        for _, v in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids)))
        return out

    for _ in range(rounds):
        found = assign()
        for k in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, found, strict=True) if c == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = assign()
    inertia = [sum(d for d, c in found if c == k) for k in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, long(d), long(inertia[c]), long(sum(inertia)), digest[c]) for (i, _), (d, c) in zip(kept, found, strict=True)]


def run(spark, rows, **given):
    frame = spark.createDataFrame([(i, v, "mine", 0) for i, v in rows], SCHEMA)
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return ordered(map(tuple, cluster_vectors(frame, **given).select(*columns).collect()))


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


def vectors(n, width, seed=0, scale=0.3):
    random = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in random.normal(0, scale, width)]) for i in range(n)]


def test_equals_brute_force_with_ties_nulls_and_odd_rows(spark):
    rows = vectors(300, 6) + [(1_000 + k, vectors(1, 6)[0][1]) for k in range(150)]  # a third are equal
    rows += [(5, [0.25] * 6), (5, [0.25] * 6), (5, [-0.25] * 6)]  # repeated ids and rows
    rows += [(2_000, None), (2_001, [0.1, None] + [0.0] * 4), (2_002, [float("nan")] * 6), (2_003, [float("inf")] + [0.0] * 5), (2_004, [0.1] * 5), (2_005, [])]
    rows += [(None, [0.5] * 6), (None, [0.1] * 6)]
    assert run(spark, rows, clusters=9, width=6) == ordered(brute(rows, 9, 3, 6))


def test_production_shape(spark):
    rows = vectors(400, 64, 3, 0.1)
    assert run(spark, rows) == ordered(brute(rows, 16, 3, 64))


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = vectors(5, 4, 1)
    assert run(spark, rows, clusters=9, width=4) == ordered(brute(rows, 9, 3, 4))
    assert run(spark, []) == [] == run(spark, [(1, None), (2, [0.5])])


@pytest.mark.parametrize("scale", [1e6, 1e12, 1e30])
def test_large_components_stay_exact_and_results_are_cut_to_64_bits(spark, scale):
    rows = [(i, [float(np.float32(x * scale)) for x in v]) for i, v in vectors(60, 4, 5)]
    assert run(spark, rows, clusters=5, width=4) == ordered(brute(rows, 5, 3, 4))


def test_an_empty_centroid_stays(spark):
    rows = [(k, [0.0, 0.0]) for k in range(20)] + [(99, [8.0, 8.0])]
    got = run(spark, rows, clusters=4, width=2)
    assert got == ordered(brute(rows, 4, 3, 2)) and len({r[1] for r in got}) < 4


def test_pivots_spare_distances_without_changing_results():
    random = np.random.default_rng(2)
    centres = random.integers(-900, 900, (16, 8))
    v = centres[random.integers(0, 16, 4_000)] + random.integers(-20, 20, (4_000, 8))
    pivots = centres[:6]
    best, least, computed = Round(centres, roots(centres, pivots)).assign(v, roots(v, pivots))
    every = np.stack([squared(v, c) for c in centres], axis=1)
    assert (least == every.min(axis=1)).all() and (best == every.argmin(axis=1)).all()
    assert computed < every.size / 4


def test_pivots_never_decide(spark, monkeypatch):
    rows = vectors(120, 5, 8)
    want = run(spark, rows, clusters=6, width=5)
    monkeypatch.setattr(pivot_clusters, "PIVOT_SAMPLE", 7)
    assert run(spark, rows, clusters=6, width=5, pivots=1) == want
