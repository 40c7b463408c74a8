"""The Jaccard join against brute force, with links near the threshold, chains, copies and shared passages."""

from __future__ import annotations

import random

import pytest

from genoweave.llm import jaccard_join as J


def brute(rows: list[tuple]) -> list[tuple]:
    sets = [J.shingle_set(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i: int) -> int:
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                comp[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def corpus(seed: int, words: int) -> list[tuple]:
    rng = random.Random(seed)
    draw = lambda n: [f"w{rng.randint(0, 4000)}" for _ in range(n)]
    texts, passage = [], draw(60)
    for _ in range(25):
        base = draw(max(1, int(words * rng.uniform(0.4, 2.2))))
        texts.append(base)
        for _ in range(rng.randint(0, 6)):  # edits of edits, so that chains form around the threshold
            edited = list(rng.choice(texts[-3:]))
            for _ in range(max(1, int(len(edited) * rng.uniform(0.005, 0.04)))):
                edited[rng.randrange(len(edited))] = f"e{rng.randint(0, 10**9)}"
            texts.append(edited + draw(rng.randint(0, max(1, len(edited) // 12))))
    texts += [draw(rng.randint(20, 80)) + passage + draw(rng.randint(0, 80)) for _ in range(40)]
    texts += [passage] * 5 + [draw(rng.randint(1, 6)) for _ in range(10)]
    return [(rng.randint(0, 10**6) * 1000 + i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("seed", "words"), [(1, 20), (2, 90), (3, 400)])
def test_components_are_those_of_all_pairs(spark, seed, words):
    rows = corpus(seed, words)
    rows += [(rows[0][0], rows[0][1]), (5, None), (6, ""), (7, " \n "), (None, rows[1][1]), (None, "alone with no id at all here"), (8, "ONE two"), (9, "one\tTWO"), (rows[2][0], "same id other text entirely")]
    random.Random(seed).shuffle(rows)
    found = J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_keys_meet_for_every_link():
    """Any two sets at the threshold share a key, in one size band or across two."""
    import numpy as np

    rng = np.random.default_rng(4)
    for n in [1, 2, 4, 5, 9, 31, 57, 63, 64, 65, 90, 127, 128, 150, 255, 256, 300, 511, 520, 1000, 3000]:
        for _ in range(25):
            h = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
            apart = int(rng.integers(0, len(h) // 4 + 1))
            gone = int(rng.integers(0, apart + 1))
            other = np.unique(np.concatenate((rng.permutation(h)[gone:], rng.integers(0, 2**63, apart - gone, dtype=np.uint64))))
            both = len(np.intersect1d(h, other))
            if 100 * both >= 80 * (len(h) + len(other) - both):
                assert set(J.keys_of(h).tolist()) & set(J.keys_of(other).tolist())


def test_keep_one_leaves_a_document_of_each_group(spark):
    rows = [(r[0], r[1], "x") for r in corpus(5, 60)] + [(1, None, "x"), (2, "", "y"), (1, None, "x")]
    kept = J.keep_one(spark.createDataFrame(rows, "doc_id long, text string, comp string"))
    assert kept.columns == ["doc_id", "text", "comp"]
    expected = sorted({(d) for d, _, c in brute([r[:2] for r in rows]) if d == c})
    assert sorted(r.doc_id for r in kept.collect()) == expected


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert J.jaccard_components(none).count() == 0 and J.keep_one(none).count() == 0
