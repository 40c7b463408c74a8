"""The filter audit against running every order of the filters over the documents."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

from genoweave.llm import filter_audit, queries

DOCS, LABELS = "doc_id long, text string, lang string, n int, step string, key string, good int", "doc_id long, quality int, toxic int, part string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def odd() -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(2)
    texts = ["", None, " \t\n", "A" * 50, "a# b", " x ", "one two " * 150, " ".join(f"w{i}" for i in range(200)), " ".join(f"w{i}" for i in range(199)), "Word " * 400, "x " * 100_000]
    texts += [" ".join(rng.choice(("Ab", "c%", "d", f"e{rng.randrange(900)}")) for _ in range(rng.randrange(450))) for _ in range(25)]
    docs = [(i, rng.choice(texts), rng.choice(("en", "fr", "", None)), 1, "x", "y", 7) for i in range(160)]
    docs += [docs[3], docs[3], docs[90]]  # repeated rows are documents each
    docs += [(None, rng.choice(texts), "en", 1, "x", "y", 7) for _ in range(12)]
    docs += [(500 - i, "the same text everywhere", "de", 1, "x", "y", 7) for i in range(60)]
    docs += [(441, "the same text everywhere", "fr", 1, "x", "y", 7)]  # the least id of the group twice, in two parts
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 1)), "z") for i in range(0, 160, 2)] + [(4, 1, 1, "z"), (None, 1, 1, "z"), (9999, 1, 1, "z"), (450, 1, 0, "z")]
    return docs, labels


def brute(docs, labels) -> list[tuple]:
    least: dict = {}
    for i, text, *_ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good, toxic = {r[0] for r in labels if r[1] == 1}, {r[0] for r in labels if r[2] == 1}
    fails = []
    for i, text, lang, *_ in docs:
        text = text or ""
        words = WORD.findall(text)
        which = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text)}
        which |= {"D": any(c in "#$%&*|" for c in text), "E": i is not None and i > least[text]}
        fails.append((lang or "", {k for k, v in which.items() if v}, i is not None and i in good, i is not None and i in toxic))
    out = []
    for part in {f[0] for f in fails}:
        own = [f[1:] for f in fails if f[0] == part]
        rows, total = [], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone, left = [f for f in left if x in f[0]], [f for f in left if x not in f[0]]
                total[x] += len(gone)
                rows.append((x, order, step, len(left), len(gone), sum(x in f[0] for f in own) - len(gone), sum(f[0] == {x} for f in own), sum(f[1] for f in gone), sum(f[2] for f in gone)))
        out += [(part, *r[1:], total[r[0]]) for r in rows]
    return sorted(out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_every_order(spark):
    docs, labels = odd()
    df = filter_audit.audit(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(labels, LABELS))
    assert df.columns == COLUMNS
    assert sorted(map(tuple, df.collect())) == brute(docs, labels)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(docs, labels).collect() == []
    one = [(1, None, None, 1, "x", "y", 7)]
    assert sorted(map(tuple, filter_audit.audit(spark.createDataFrame(one, DOCS), labels).collect())) == brute(one, [])


def test_report_of_any_filters(spark):
    """Three filters named by the caller, with weights: the joint counts give what single rows say."""
    rows = [("p", a, b, c, 1 + a + 2 * b + 5 * c) for a in (0, 1) for b in (0, 1) for c in (0, 1)]
    joint = filter_audit.joint_counts(spark.createDataFrame(rows, "k string, x int, y int, z int, n long"), ["x", "y", "z"], {"n": "n"}, ["k"])
    found = {(r.filter_order, r.step): r for r in filter_audit.report(joint, "xyz", ["k"]).collect()}
    assert len(found) == 18
    assert found["xyz", 3].kept == 1 and found["zyx", 1].removed == sum(r[4] for r in rows if r[3])
    assert sum(found["xyz", i].removed for i in (1, 2, 3)) == sum(r[4] for r in rows) - 1
    assert {found[o, s].shapley for o, s in found if o[s - 1] == "y"} == {sum(found[o, s].removed for o, s in found if o[s - 1] == "y")}


def test_the_query_reads_all_documents(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    df = queries.op13_filter_audit(spark, sf_dir)
    assert sorted(map(tuple, df.select(*COLUMNS).collect())) == brute(docs, labels)
