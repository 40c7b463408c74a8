"""Quality and toxicity: held-out accuracy, the machine's readings, and edge cases."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoweave.llm import quality, queries, toxicity

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize(("name", "label", "least"), [("op3_quality", "quality", 0.97), ("op7_toxicity", "toxic", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    found = queries.QUERIES[name](spark, SF)
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = found.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert len(rows) > 50 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert np.mean([r.predicted == r[label] for r in rows]) >= least


def test_the_update_rule_is_that_of_the_paper():
    """Against a plain per-coordinate loop."""
    rng = np.random.default_rng(0)
    model = quality.FollowTheRegularisedLeader(6, alpha=0.3, beta=1.0, l1=0.1, l2=0.2)
    z, n = [0.0] * 6, [0.0] * 6
    for _ in range(200):
        at = np.sort(rng.choice(6, 3, replace=False))
        x, y = rng.normal(size=3), int(rng.integers(0, 2))
        w = [0.0 if abs(z[i]) <= 0.1 else -(z[i] - (0.1 if z[i] > 0 else -0.1)) / ((1 + n[i] ** 0.5) / 0.3 + 0.2) for i in at]
        p = 1 / (1 + np.exp(-sum(a * b for a, b in zip(w, x, strict=True))))
        for i, a, b in zip(at, w, x, strict=True):
            g = (p - y) * b
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.3 * a
            n[i] += g * g
        model.update(at, x, y)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_scores_of_odd_texts(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "one", "c"), (3, "word " * 30_000, "d"), (3, "word " * 30_000, "d"), (4, "\n|#", "e")], "doc_id long, text string, w string")
    weights = np.linspace(-1, 1, quality.VIEWS * quality.SLOTS + 1)
    for scored in (quality.score(docs, weights), toxicity.score(docs, {"=word": 3.0}, np.array([-3.0, 0.5, 0.5, 0.5, 0.5]))):
        rows = scored.collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows) and rows[0].score == rows[1].score and rows[3].score == rows[4].score
        assert scored.columns == ["doc_id", "text", "w", "score"] and scored.limit(0).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert not quality.train(docs, none).any()
    assert toxicity.learn(docs, none)[0] == {}
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, 1, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    assert len(quality.train(docs, labels)) == quality.VIEWS * quality.SLOTS + 1
    insults, calibration = toxicity.learn(docs, labels)
    assert insults == {} and np.isfinite(calibration).all()


def test_all_of_a_long_word_counts_in_each_view():
    slots = quality.Features().slots
    head = "東京は日本の首都です。" * 12
    plain, odd = slots(head + "東京。" * 100), slots(head + "x9-Y!" * 60)
    assert all(set(a.tolist()) != set(b.tolist()) for a, b in zip(plain, odd, strict=True))
    rng = np.random.default_rng(4)
    text = "".join(map(chr, rng.integers(0x21, 0x7F, 1000)))
    pieces = slots(" ".join(text[i : i + 64] for i in range(0, 1000, 64)))
    assert [v.tolist() for v in slots(text)] == [v.tolist() for v in pieces] and [len(v) for v in pieces] == [16, 15, 16, 15]
    assert quality.shape("a1" * 50) == "a0" * 50


def test_readings_of_clauses():
    m = toxicity.Matcher({"=idiot": 8.0, "lowei": 6.0})
    of = lambda t: m.clauses(t)[0]
    assert of("The idiot went.") == [8.0] and of("You idiot!") == [12.0] and of("an IDIOT, a loweischaft.") == [8.0, 6.0]
    assert of("Nobody is an idiot.") == [2.0] and of("He is not an idiot.") == [3.0] and of("She said he was an idiot.") == [3.0] and of("She said a thing. An idiot.") == [8.0]
    assert of('He wrote "an idiot. An idiot" and idiot') == [3.0, 10.0] and of("idiots") == [] and of(None) == []
    # a threat needs a target as its object
    assert of("I will kill you.") == of("we hurt all you") == of("Ich werde dich töten.") == of("te matar") == [4.0]
    assert of("They kill time.") == of("kill the lights before you go") == of("kill the process") == of("kill all of you") == of("you kill") == of("kill, you") == []
    assert of("I will not kill you.") == of("She said kill him.") == [1.0] and of("never kill the process") == []


def test_what_the_grammar_tells_apart():
    """Texts of the same words, toxic and not: the insults' sum can't tell them apart, the clauses can."""
    m = toxicity.Matcher({"=clown": 5.0, "=worm": 7.0})
    pairs = []
    for word in ("clown", "worm"):
        for other in ("today", "indeed", "by the river"):
            pairs += [(f"you are a {word} and not wrong {other}", f"you are not a {word} and wrong {other}"), (f"a {word} you are, she said {other}", f"she said you are a {word} {other}"), (f"you {word}, {other} we said so", f"{other} we said so you {word}")]
            pairs += [(f"we kill you {other}, a {word}", f"{other} you kill, we a {word}"), (f"I will hurt you, the lights {other} {word}", f"I will hurt the lights, you {other} {word}")]
    words_of = lambda t: sorted(t.replace(",", "").split())
    assert all(words_of(a) == words_of(b) for a, b in pairs)
    plain = lambda t: sum(m.insults.get("=" + w, 0.0) for w in t.replace(",", "").split())
    above = lambda f: np.mean([f(a) > f(b) for a, b in pairs])
    assert above(plain) == 0.0 and above(lambda t: sum(m.clauses(t)[0])) == 1.0


def test_no_clause_makes_a_text_less_toxic(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    insults, calibration = toxicity.learn(docs, queries.learned(spark.read.parquet(f"{SF}/labels.parquet"), 5, 0))
    assert (calibration[1:] >= 0).all() and calibration[1:].any()
    m = toxicity.Matcher(insults)
    logit = lambda t: float(np.array([1.0, *m.features(t)]) @ calibration)
    worst = max((p for p in insults if p.startswith("=")), key=insults.get)[1:]
    assert logit(f"you {worst}. " * 6) >= logit(f"you {worst}. " * 2) > logit("") and logit(f"you {worst}.") > logit(f"you are not a {worst}.") > logit("")
    assert logit("I will kill you.") > logit("I will kill the lights before you go.")


def test_factors_are_not_negative():
    rng = np.random.default_rng(7)
    x = np.column_stack((np.ones(300), rng.normal(size=(300, 4))))
    y = (x @ np.array([0.2, 2.0, -1.5, 0.7, -0.1]) + rng.logistic(size=300) > 0).astype(float)
    w = toxicity._logistic(x, y)
    assert (w[1:] >= 0).all() and w[2] == 0 and w[1] > 1 and w[3] > 0.2


def test_composition_is_running_one_after_the_other():
    import random

    first, second, third = toxicity.negation(), toxicity.reported_speech(), toxicity.clause_scoring()
    composed, rng = toxicity.grammar(), random.Random(1)
    for _ in range(200):
        symbols = [rng.randrange(9) for _ in range(30)]
        expected, got, a, b, c, s = [], [], first.start, second.start, third.start, composed.start
        for x in symbols:
            a, y, u = first.step(a, x)
            b, y, v = second.step(b, y)
            c, y, w = third.step(c, y)
            expected.append((y, u + v + w))
            s, z, w = composed.step(s, x)
            got.append((z, w))
        assert got == expected


def plain_quality(text: str, w: np.ndarray) -> float:
    """The score of a text word by word, in Python's integers."""
    import xxhash

    mask, p, q = 2**64 - 1, 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
    words = [x[i : i + quality.LONGEST] for x in (text or "").split() for i in range(0, len(x), quality.LONGEST)]
    names = [xxhash.xxh3_64_intdigest(x.lower()) for x in words]
    forms = [xxhash.xxh3_64_intdigest(quality.shape(x), 1) ^ (q if i and names[i] == names[i - 1] else 0) for i, x in enumerate(words)]
    logit = w[-1]
    for view, seq in ((0, names), (2, forms)):
        pairs = [(a * p & mask) + (b ^ (b >> 31)) & mask for a, b in zip(seq, seq[1:], strict=False)]
        for k, grams in ((view, seq), (view + 1, pairs)):
            slots = [k * quality.SLOTS + (((y ^ (y >> 29)) * q & mask) >> (64 - quality.BITS)) for y in grams]
            if slots:
                logit += quality.SCALE * sum(w[s] for s in slots) / len(slots)
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


def test_whole_scores_against_plain_loops(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    weights = quality.train(docs, queries.learned(labels, 3, 1))
    insults, calibration = toxicity.learn(docs, queries.learned(labels, 5, 0))
    rows = toxicity.score(quality.score(docs, weights, out="q"), insults, calibration, out="t").collect()
    machines = (toxicity.negation(), toxicity.reported_speech(), toxicity.clause_scoring())
    matcher = toxicity.Matcher(insults)
    for r in rows[::10]:
        assert abs(r.q - plain_quality(r.text, weights.astype("<f4").astype(float))) < 1e-6
        states, clauses, total, tokens = [m.start for m in machines], [], 0.0, toxicity._TOKEN.findall((r.text or "").lower())
        for token in tokens:
            symbol, own = matcher.fixed.get(token) or matcher.tag(token)
            weight = 0.0
            for i, m in enumerate(machines):
                states[i], symbol, w = m.step(states[i], symbol)
                weight += w
            if symbol == toxicity.END:
                clauses, total = clauses + [total] * (total > 0), 0.0
            else:
                total += weight * (own if symbol == toxicity.INSULT else toxicity.THREAT_WEIGHT)
        clauses += [total] * (total > 0)
        f = [max(clauses), np.log1p(len(clauses)), np.log1p(sum(clauses)), np.log1p(100 * sum(clauses) / len(tokens))] if clauses else [0.0] * 4
        assert abs(r.t - 1 / (1 + np.exp(-np.clip(calibration[0] + calibration[1:] @ f, -35, 35)))) < 1e-9


def test_columns_of_the_same_names(spark):
    docs = spark.createDataFrame([(1, "word", "own", 5)], "doc_id long, text string, score string, y int")
    for scored in (quality.score(docs, np.zeros(quality.VIEWS * quality.SLOTS + 1)), toxicity.score(docs, {}, np.zeros(5))):
        assert scored.columns == docs.columns and scored.first().score == 0.5
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert np.isfinite(quality.train(docs, labels)).all() and np.isfinite(toxicity.learn(docs, labels)[1]).all()
