"""Hard negatives against scores of all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoweave.llm import hard_negatives, queries

KIND = "vec_id long, embedding array<double>, label int, list int, score string, d string"


def odd(seed: int, n: int = 260, d: int = 5, size: float = 1.0) -> list[tuple]:
    rng = random.Random(seed)
    middles = [[rng.gauss(0, size) for _ in range(d)] for _ in range(6)]
    rows = [(i, [m + rng.gauss(0, size / 6) for m in rng.choice(middles)], rng.randrange(3)) for i in range(n)]
    rows += [(n + i, list(rows[7][1]), rng.randrange(3)) for i in range(150)]  # equal vectors: a hot list, ties
    rows += [(1000, None, 1), (1010, [], 1), (1020, [0.0] * d, 1), (1030, [1.0, None] + [0.0] * (d - 2), 1), (1040, [math.nan] * d, 1), (1050, [math.inf] + [1.0] * (d - 1), 0), (None, [1.0] * d, 1), (1060, [1.0] * d, None)]
    rows += [(1070, [1.0, 2.0], 1), (1071, [1.0, 1.5], 1), (1072, [1.0, 1.2], 2), (1080, [-x for x in rows[7][1]], 0)]
    rows += [rows[10], rows[10], rows[11], (20, [0.5] * d, 2)]  # a repeated anchor, a repeated row, an anchor's id with another vector
    return [(*r, 1, "x", "y") for r in rows]


def brute(rows, every, least=80, most=100) -> list[tuple]:
    good = [(i, tuple(math.floor(256 * x) for x in v), label) for i, v, label, *_ in rows if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, q, label in {g for g in good if g[0] % every == 0}:
        scored = [(-sum(x * y for x, y in zip(q, v, strict=True)), i, other) for i, v, other in good if i != a and len(v) == len(q)]
        for s, p, _ in sorted((s, i, o) for s, i, o in scored if o == label)[:5]:
            fits = sorted((t, i) for t, i, o in scored if o != label and least * -s <= 100 * -t <= most * -s)[:5]
            out += [(a, p, r, i, -s, -t) for r, (t, i) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_against_all_pairs(spark, monkeypatch, small):
    """One list, and many lists in parts, with blocks of few searches."""
    if small:
        for name, value in (("LIST_ROWS", 20), ("PART_ROWS", 30), ("ASKS", 7), ("FIRST_ROWS", 15), ("SAMPLE_VALUES", 800)):
            monkeypatch.setattr(hard_negatives, name, value)
    rows = odd(3)
    df = hard_negatives.mine(spark.createDataFrame(rows, KIND).repartition(3), F.col("id") % 10 == 0)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, df.collect())) == brute(rows, 10)


def test_other_windows_and_large_components(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LIST_ROWS", 40)
    rows = odd(4, size=3e5)
    df = hard_negatives.mine(spark.createDataFrame(rows, KIND), F.col("id") % 20 == 0, least=-50, most=70)
    assert sorted(map(tuple, df.collect())) == brute(rows, 20, -50, 70)


def test_bounds_hold_and_rule_lists_out():
    rng = np.random.default_rng(5)
    middles = rng.normal(0, 300, (8, 16))
    x = np.floor(np.repeat(middles, 100, axis=0) + rng.normal(0, 20, (800, 16)))
    c = hard_negatives.kmeans(x, 8)
    of = hard_negatives._nearest(x, c)
    radii = np.array([np.sqrt(((x[of == i] - c[i]) ** 2).sum(1)).max() for i in range(len(c))])
    low, high = hard_negatives.bounds(x[:20], c, radii)
    scores = x[:20] @ x.T
    assert (scores >= low[:, of]).all() and (scores <= high[:, of]).all()
    sizes, best = np.bincount(of), np.sort(scores[0])[-5]
    first = hard_negatives._plan(low[0], high[0], sizes, [{"low": None, "high": None, "kth": None}], 1)
    rest = hard_negatives._plan(low[0], high[0], sizes, [{"low": None, "high": None, "kth": int(best)}], 2)
    assert 0 < len(first) and len(first) + len(rest) < len(c), "lists below the kth score must not be visited"
    assert set(of[np.flatnonzero(scores[0] >= best)]) <= {*first.tolist(), *rest.tolist()}


def test_empty_and_no_anchor(spark):
    assert hard_negatives.mine(spark.createDataFrame([], KIND), F.col("id") % 10 == 0).collect() == []
    assert hard_negatives.mine(spark.createDataFrame([(1, [1.0], 1, 1, "x", "y"), (2, [1.0], 2, 1, "x", "y")], KIND), F.col("id") % 10 == 0).collect() == []


def test_the_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(map(tuple, queries.op11_hard_negatives(spark, sf_dir).collect())) == brute(rows, 100)
