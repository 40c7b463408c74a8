"""Each stage against a brute-force version on its own input."""

from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline

from genoweave.llm import jaccard_join, mixing

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    toxicity, quality, near, mix, pack = (f for _, f in corpus_pipeline.STAGES)
    columns, before = docs.columns, docs.collect()

    kept = toxicity(spark, docs, SF)
    assert kept.columns == columns
    ids = {r.doc_id for r in kept.collect()}
    known = [r.doc_id for r in before if r.doc_id in labels]
    assert np.mean([(i in ids) == (labels[i].toxic == 0) for i in known]) > 0.97
    assert np.mean([i in ids for i in known if labels[i].toxic == 0]) > 0.99

    kept = quality(spark, kept, SF).cache()
    assert kept.columns == columns
    rows = kept.collect()
    good = {r.doc_id for r in rows}
    assert good <= ids and np.mean([(i in good) == (labels[i].quality == 1) for i in known if i in ids]) > 0.97

    one = near(spark, kept, SF).cache()
    assert one.columns == columns
    left = {r.doc_id: jaccard_join.shingle_set(r.text) for r in one.collect()}
    sets = {r.doc_id: jaccard_join.shingle_set(r.text) for r in rows}
    assert set(left) <= set(sets) and len(left) == one.count()
    linked = lambda s, t: len(s & t) * 100 >= 80 * len(s | t) > 0
    comp = {i: i for i in sets}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    order = sorted(sets)
    for k, i in enumerate(order):
        for j in order[:k]:
            if linked(sets[i], sets[j]):
                a, b = sorted((find(i), find(j)))
                comp[b] = a
    assert sorted(left) == sorted(i for i in sets if find(i) == i)

    mixed = mix(spark, one, SF).cache()
    assert mixed.columns == columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {r.doc_id: r.copies for r in mixing.copies(one).collect() if r.copies}

    pieces = pack(spark, mixed, SF).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = sum(len(e.ids) + 1 for e in library.encode_batch([r.text or "" for r in mixed.collect()], add_special_tokens=False))
    assert sum(p.length for p in pieces) == tokens
    fill: dict[int, int] = {}
    for p in pieces:
        fill[p.sequence_id] = fill.get(p.sequence_id, 0) + p.length
    assert max(fill.values()) <= 2048 and len(fill) * 2048 < 1.05 * tokens + 8 * 2 * 2048


def test_run_is_all_stages(spark):
    sf = "/root/testdata/sf0.001"
    assert corpus_pipeline.run(spark, sf).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_clashing_columns(spark):
    """Columns that are named like the operators' own are carried through all stages but the last."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = ["size", "copies", "_key", "_offset", "_rank", "score", "score_", "text_hash", "_hash", "comp", "node", "y", "w"]
    from pyspark.sql import functions as F

    wide = docs.select("*", *[F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        wide = stage(spark, wide, sf)
        assert wide.columns == docs.columns + names
    rows = wide.collect()
    assert rows and all(r[n] == f"{n}:{r.doc_id}" for r in rows for n in names)
