"""Decontamination against every window looked for in every text."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from genoweave.llm import decontamination, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string, found string, n_words int", "item_id string, text string, more int"


def words_of(text: str | None) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window: int = 10) -> list[tuple]:
    looked: dict[tuple, set] = {}
    for item, text in items:
        words = words_of(text)
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            looked.setdefault(tuple(words[k : k + n]), set()).add(item)
    out = []
    for i, text in docs:
        words, hit, found = words_of(text), set(), set()
        for n in {len(x) for x in looked}:
            for k in range(len(words) - n + 1):
                if (owners := looked.get(tuple(words[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= owners
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(words), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def odd() -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(12)
    few = lambda n: " ".join(rng.choice(("a", "b", "Ab", "é", "x1")) for _ in range(n))
    items = [(f"i{k}", few(rng.choice((0, 1, 3, 9, 10, 11, 25, 60)) or 0)) for k in range(30)]
    items += [("null", None), ("blank", " ,.- "), (None, "nobody owns these ten words that a text may hold here"), ("twice", items[5][1]), items[7], items[7], ("short", "Zebra! crossing"), ("shorter", "crossing")]
    items += [("long", " ".join(f"w{k}" for k in range(400)))]
    texts = [None, "", "...", few(5), "zebra-CROSSING zebra crossing", "crossing", "w5 " * 20, " ".join(f"W{k}," for k in range(100, 330)), "x " * 9 + " ".join(f"w{k}" for k in range(9)), "nobody owns these ten words that a text may hold here"]
    texts += [few(rng.randrange(200)) for _ in range(60)] + ["start " + (items[k][1] or "") + " end" for k in range(len(items))] + [few(30_000), "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 " * 3000]
    docs = [(k, t) for k, t in enumerate(texts)]
    return [*docs, docs[7], (None, docs[7][1])], items


def digest(df) -> list[tuple]:
    f = decontamination.F
    hit = decontamination.n_hit(f.col("found"))
    return sorted(map(tuple, df.select("doc_id", "found.n_words", hit, f.size("found.items"), f.sha2(f.array_join("found.items", ","), 256), hit > 0).collect()), key=str)


@pytest.mark.parametrize("sizes", [None, (40, 7, 2)])
def test_against_every_window(spark, monkeypatch, sizes):
    """In one shard, and in many shards and passes with long items in pieces."""
    if sizes:
        for name, value in zip(("SHARD_WORDS", "PIECE_WORDS", "SHARDS_AT_ONCE"), sizes, strict=True):
            monkeypatch.setattr(decontamination, name, value)
        monkeypatch.setattr(decontamination, "SHARD_WORDS", 400)
    docs, items = odd()
    left = spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS).repartition(3)
    right = spark.createDataFrame([(*i, 1) for i in items], ITEMS).repartition(2)
    df = decontamination.find(left, right)
    assert df.columns == ["doc_id", "text", "found", "n_words"]
    assert digest(df) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert decontamination.find(docs, items).collect() == []
    one = spark.createDataFrame([(1, "a b c", "x", 1)], DOCS)
    assert digest(decontamination.find(one, items)) == brute([(1, "a b c")], [])
    assert decontamination.find(docs, spark.createDataFrame([("i", "a", 1)], ITEMS)).collect() == []


def test_cutting(spark):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, "Before it. One, two three four five six seven eight nine TEN! And after it come so many more words."), (2, item + " tail"), (3, "é nothing of it"), (4, None)]
    kept = {r.doc_id: r.text for r in decontamination.decontaminate(spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS), spark.createDataFrame([("i", item, 1)], ITEMS)).collect()}
    assert kept == {1: "Before it. ! And after it come so many more words.", 3: "é nothing of it", 4: None}


def test_longest_match(spark):
    item = " ".join(f"w{k}" for k in range(40))
    df = spark.createDataFrame([(1, "a " + " ".join(f"w{k}" for k in range(5, 30)) + " b", "x", 1)], DOCS)
    found = decontamination.find(df, spark.createDataFrame([("i", item, 1)], ITEMS)).first().found
    assert found.longest == 25 and [(s.start, s.end) for s in found.spans] == [(1, 26)] and found["items"] == ["i"]


def test_the_query_reads_all_documents(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    df = queries.op12_decontaminate(spark, sf_dir).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted(map(tuple, df.collect()), key=str) == brute(docs, items)
