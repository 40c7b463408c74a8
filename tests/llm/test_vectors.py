"""Vector searches against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoweave.llm import queries, vector_search

KIND = "vec_id long, embedding array<float>, score string"


def odd(seed: int, n: int = 300, d: int = 6) -> list[tuple]:
    rng = random.Random(seed)
    rows = [(i, [round(rng.gauss(0, 1), 2) for _ in range(d)], "x") for i in range(n)]
    rows += [(n + i, list(rows[7][1]), "x") for i in range(120)]  # equal vectors: ties
    rows += [(1000, None, "x"), (1040, [], "x"), (1060, [0.0] * d, "x"), (1080, [1.0, None] + [0.0] * (d - 2), "x"), (1100, [math.nan] * d, "x"), (1120, [math.inf] + [1.0] * (d - 1), "x"), (None, [1.0] * d, "x"), (1200, [1.0, 2.0], "x"), (1201, [1.0, 1.0], "x")]
    return [*rows, rows[20], rows[21]]


def brute(rows, every, k, scale=None):
    good = []
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            v = np.asarray(v, np.float32).astype(float)
            good.append((i, np.floor(scale * v) if scale else v))
    if not scale:
        good = [g for g in good if g[1].any()]
    out = []
    for q, v in {i: v for i, v in good if i % every == 0}.items():
        scored = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q and len(w) == len(v)))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [8192, 50])
def test_exact_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(vector_search, "BLOCK", block)
    rows = odd(1)
    found = vector_search.exact_top_k(spark.createDataFrame(rows, KIND).repartition(3), F.col("id") % 20 == 0)
    assert sorted(map(tuple, found.collect())) == brute(rows, 20, 5, 256)


@pytest.mark.parametrize("large", [1e6, 1e13])
def test_large_components_are_exact(spark, large):
    """Beyond 2^53 in 64-bit integers, beyond 2^62 in Python's; the queries are small enough for scores to fit a long."""
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) * (1 if i % 20 == 0 else large) for _ in range(6)]) for i in range(200)]
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    if large == 1e6:
        rows += [(220, rows[1][1])]
        whole[220] = whole[1]
    expected = []
    for q in (i for i in whole if i % 20 == 0):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], w, strict=True)), i) for i, w in whole.items() if i != q)
        expected += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:5], 1)]
    assert max(e[3] for e in expected) > 2**53
    found = vector_search.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), F.col("id") % 20 == 0)
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert vector_search.scaled(256, np.array([[1.7e308, -0.5]]))[0].tolist() == [[256 * int(1.7e308), -128]]


def test_the_threshold_stops_early():
    """Where a few rows dominate, most rows are never met."""
    rng = np.random.default_rng(0)
    x = np.floor(rng.exponential(20, size=(5000, 4)))
    x[:5] += 10_000
    lists = vector_search.SortedLists(x)
    touched = np.zeros(len(x), bool)

    class Watched(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray):
                touched[at] = True
            return np.asarray(super().__getitem__(at))

    lists.x = x.view(Watched)
    places, scores = lists.top(np.array([3.0, 1.0, 2.0, 0.0]), np.arange(5000), -1, 5)
    assert sorted(places.tolist()) == [0, 1, 2, 3, 4] and scores[0] == max(x @ [3, 1, 2, 0]) and touched.sum() < 200


def test_whole_visits_are_exact(spark):
    rows = odd(2)
    found = vector_search.nearest(spark.createDataFrame(rows, KIND).repartition(3), F.col("id") % 20 == 0, visit=1.0)
    got, expected = sorted(map(tuple, found.collect())), brute(rows, 20, 20)
    assert [g[:3] for g in got] == [e[:3] for e in expected] and np.allclose([g[3] for g in got], [e[3] for e in expected], atol=1e-12)


def test_recall(spark):
    """At least 0.9 of the true 20 nearest, over all queries of a whole table."""
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    found = queries.op9_nearest(spark, sf).collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    by, near = {}, 0
    for r in found:
        by.setdefault(r.query_id, set()).add(r.vec_id)
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        near += len(by[ids[i]] & set(ids[np.argsort(-s)[:20]].tolist()))
    assert near >= 0.9 * len(found) and len(found) == 20 * (ids % 20 == 0).sum()
    assert max(abs(r.score - x[ids == r.query_id][0] @ x[ids == r.vec_id][0]) for r in found[:50]) < 1e-12


def test_empty(spark):
    none = spark.createDataFrame([], KIND)
    assert vector_search.exact_top_k(none, F.col("id") % 20 == 0).count() == vector_search.nearest(none, F.col("id") % 20 == 0).count() == 0
