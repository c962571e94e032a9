"""Top-k against all scores."""

import math
import random

import numpy as np
import pytest

from stockrecon.llm import nra as N

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, every=50):
    kept = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        kept[i] = min(kept.get(i, q), q)
    found = set()
    for q in kept:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(kept[q], v)), i) for i, v in kept.items() if i != q)
            found |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return found


def run(spark, rows, k=5, every=50):
    vectors = N.quantised(spark.createDataFrame(rows, VECTORS))
    return {tuple(r) for r in N.search(vectors.where(f"id % {every} = 0"), vectors, k).collect()}


def vectors(n, width, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((5, width)) * spread
    return [(i, (centres[i % 5] + rng.standard_normal(width)).astype(np.float32).tolist(), 0) for i in range(n)]


@pytest.mark.parametrize("n,width,spread", [(400, 8, 2.0), (300, 64, 0.2), (3, 4, 1.0), (60, 1, 1.0)])
def test_equals_all_scores(spark, monkeypatch, n, width, spread):
    monkeypatch.setattr(N, "CANDIDATES", 100)
    monkeypatch.setattr(N, "QUERIES", 3)
    rows = vectors(n, width, n, spread)
    assert run(spark, rows, every=10) == brute(rows, every=10)


def test_ties_repeats_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(N, "CANDIDATES", 16)
    same = [0.5, -0.25]
    rows = [(i, same, 0) for i in range(60)] + [(50, same, 1), (50, [0.1, 0.1], 2), (70, [0.5], 0), (71, [], 0)]
    rows += [(100, None, 0), (None, same, 0), (150, [float("nan"), 1.0], 0), (200, [float("inf"), 1.0], 0), (250, [None, 1.0], 0), (-50, same, 0)]
    assert run(spark, rows) == brute(rows)


def test_large_components_stay_exact(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice((-1, 1)) * rng.random() * 2.0**20 for _ in range(4)], 0) for i in range(80)]
    assert run(spark, rows, every=10) == brute(rows, every=10)


def test_bounds_enclose_scores():
    rng = np.random.default_rng(4)
    rows = rng.integers(-50, 50, (200, 6))
    query = rng.integers(-50, 50, 6)
    lists = N.Lists(rows)
    factors = np.concatenate([np.maximum(query, 0), np.minimum(query, 0)])
    exact = rows @ query
    for depth in (1, 20, 100, 200):
        low, high = lists.seen(depth, np.float64)
        assert (low @ factors <= exact).all() and (exact <= high @ factors).all()
    assert (low @ factors == exact).all() and (high @ factors == exact).all()


def test_reading_stops_early():
    """With one clear winner a query is decided before its lists are read to the end."""
    rng = np.random.default_rng(5)
    rows = rng.integers(-20, 20, (4000, 8))
    rows[:5] = 200
    depths = []
    lists = N.Lists(rows)
    seen = lists.seen
    lists.seen = lambda depth, kind: depths.append(depth) or seen(depth, kind)
    found = list(N.top_k(lists, np.arange(4000), np.full((1, 8), 7), np.array([-1]), 5))
    assert depths == [500] and set(found[0][1]) >= set(range(5))


def test_no_vectors(spark):
    assert run(spark, []) == set()
