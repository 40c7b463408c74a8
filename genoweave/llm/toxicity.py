"""Toxicity by a weighted finite-state pattern grammar.

Words are first mapped to tags: insult, threat, target, object, negation, reporting verb, quote, end of clause, other. Three
transducers over tags are composed to one machine: *negation* softens an insult or threat that a negation governs (three words
at most between), *reported speech* softens those after a reporting verb or inside quotes after one, and *clause scoring* weighs
what is left. An insult counts more when a target stands ahead of it, with at most three words between. A threat counts only where a
target is its object: at most one word after it ("kill all of you" has one too many, "kill you all" doesn't), or, as verbs come last
in some languages, an object pronoun at most one word ahead. A softened reading counts a quarter. A clause's score is the
sum of the weights along its path; a document's score is a calibrated logistic function of its matched clauses: the
highest, their number and sum, and their share of the text, none of which can make a document less toxic. So matched
clauses count, not isolated words.

Insults are patterns with weights: whole words, or beginnings of words, so that inflected forms of a stem match. They
are learned from labels, as log odds of occurring in toxic against other documents, each distinct form in a document
counting once. Labelled documents that share the least hash of three words in a row are taken as copies, of which one
is learned from. Small lists give the other tags.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import stage, unstage
from genoweave.llm.quality import sampled

#: The closed word classes of the grammar, in English, German, French and Spanish.
TARGETS = "you your yours u he she they them him her people everyone du dir ihr sie er tu toi il elle ils tú usted ustedes él ella ellos".split()
OBJECTS = "dich euch ihn te vous".split()
NEGATIONS = "not never no isn't aren't wasn't don't doesn't nobody nicht kein keine nie pas jamais aucun nunca jamás".split()
REPORTS = "said says wrote writes called calls claimed reported quoted sagte schrieb nannte dit écrit appelé dijo escribió llamó".split()
THREATS = "kill hurt destroy murder strangle shoot stab töten umbringen verletzen tuer blesser frapper matar golpear herir".split()

OTHER, INSULT, THREAT, TARGET, OBJECT, NEGATION, REPORT, QUOTE, END = range(9)
TAGS = range(9)
#: Tags that transducers make: insults and threats that are denied or reported.
SOFT_INSULT, SOFT_THREAT = 9, 10
_TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[.!?;,\n]|[\"“”„«»]")
_CLAUSE_END, _QUOTES = frozenset(".!?;,\n"), frozenset("\"“”„«»")


class Transducer:
    """A deterministic weighted transducer: (state, input) -> (state, output, weight); missing arcs stay and copy."""

    def __init__(self, arcs: dict[tuple, tuple], start=0):
        self.arcs, self.start = arcs, start

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (state, symbol, 0.0))

    def compose(self, after: Transducer, alphabet: range) -> Transducer:
        """This one, then ``after`` on its outputs, with weights added; states are pairs that can be reached."""
        start = (self.start, after.start)
        arcs, open_ = {}, [start]
        seen = {start}
        while open_:
            s = open_.pop()
            for x in alphabet:
                a, y, w = self.step(s[0], x)
                b, z, v = after.step(s[1], y)
                arcs[s, x] = ((a, b), z, w + v)
                if (a, b) not in seen:
                    seen.add((a, b))
                    open_.append((a, b))
        return Transducer(arcs, start)

    def table(self, alphabet: range) -> list[list[tuple[int, int, float]]]:
        """The arcs of each state by input, states numbered from the start, 0."""
        number = {self.start: 0} | {s: i for i, s in enumerate((s for s in dict.fromkeys(k[0] for k in self.arcs) if s != self.start), 1)}
        return [[(number[to], y, w) for to, y, w in (self.step(s, x) for x in alphabet)] for s in number]


SOFTENED = {INSULT: SOFT_INSULT, THREAT: SOFT_THREAT, SOFT_INSULT: SOFT_INSULT, SOFT_THREAT: SOFT_THREAT}


def negation(reach: int = 3) -> Transducer:
    """State k: k - 1 more words may stand between the negation and what it governs."""
    arcs = {}
    for k in range(reach + 2):
        for x in (OTHER, TARGET, OBJECT, REPORT):
            arcs[k, x] = (max(0, k - 1), x, 0.0)
        for x in (INSULT, THREAT):
            arcs[k, x] = (0, SOFTENED[x] if k else x, 0.0)
        arcs[k, NEGATION] = (reach + 1, OTHER, 0.0)
        arcs[k, QUOTE] = (k, QUOTE, 0.0)
        arcs[k, END] = (0, END, 0.0)
    return Transducer(arcs)


def reported_speech() -> Transducer:
    """States: 0 plain, 1 after a reporting verb in this clause, 2 inside quotes after one."""
    arcs = {}
    for s in range(3):
        for x, soft in SOFTENED.items():
            arcs[s, x] = (s, soft if s else x, 0.0)
        arcs[s, REPORT] = (max(1, s), OTHER, 0.0)
        arcs[s, QUOTE] = ({0: 0, 1: 2, 2: 0}[s], OTHER, 0.0)
        arcs[s, END] = (2 if s == 2 else 0, END, 0.0)
    return Transducer(arcs)


#: Weights that the grammar adds, as multiples of a word's own: a softened reading, an aimed insult, a threat to its object; a
#: threat's own weight; how many words a target reaches ahead, and how many may lie between a threat and its object.
SOFT, AIMED, THREATENED, THREAT_WEIGHT, AHEAD, BETWEEN = 0.25, 0.5, 1.0, 4.0, 3, 1


def clause_scoring() -> Transducer:
    """State (t, o, k, w): a target reaches t - 1 words further, an object pronoun o - 1; a threat waits k - 1 more words for its
    object and is worth w then."""
    arcs = {}
    states = [(t, o, k, w) for t in range(AHEAD + 2) for o in range(BETWEEN + 2) for k in range(BETWEEN + 2) for w in ((0.0,) if not k else (THREATENED, SOFT * THREATENED))]
    for t, o, k, w in states:
        older = (max(0, t - 1), max(0, o - 1), max(0, k - 1), w if k > 1 else 0.0)
        s = (t, o, k, w)
        arcs[s, OTHER] = (older, OTHER, 0.0)
        met = (AHEAD + 1, older[1], 0, 0.0)
        arcs[s, TARGET] = (met, OTHER, w)
        arcs[s, OBJECT] = ((*met[:1], BETWEEN + 1, *met[2:]), OTHER, w)
        for x, share in ((INSULT, 1.0), (SOFT_INSULT, SOFT)):
            arcs[s, x] = (older, INSULT, share * (1.0 + (AIMED if t else 0.0)))
        for x, share in ((THREAT, THREATENED), (SOFT_THREAT, SOFT * THREATENED)):
            arcs[s, x] = ((older[0], 0, 0, 0.0), OTHER, share) if o else ((older[0], older[1], BETWEEN + 1, share), OTHER, 0.0)
        arcs[s, END] = ((0, 0, 0, 0.0), END, 0.0)
    return Transducer(arcs, (0, 0, 0, 0.0))


def grammar() -> Transducer:
    return negation().compose(reported_speech(), TAGS).compose(clause_scoring(), TAGS)


#: Lengths of the word beginnings that can be insult patterns, next to whole words; bound on a worker's cache.
STEMS, CACHE_ENTRIES = range(4, 9), 300_000


def patterns(word: str) -> list[str]:
    """What a word can match: its beginnings, and itself, marked by an equals sign."""
    return [word[:k] for k in STEMS if k <= len(word)] + ["=" + word]


class Matcher:
    """Runs the composed machine over a text. ``insults`` maps patterns to weights in log odds."""

    def __init__(self, insults: dict[str, float]):
        self.arcs, self.insults = grammar().table(TAGS), insults
        fixed = {w: t for t, words in ((TARGET, TARGETS), (OBJECT, OBJECTS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)) for w in words}
        fixed |= dict.fromkeys(_CLAUSE_END, END) | dict.fromkeys(_QUOTES, QUOTE)
        self.fixed = {w: (t, THREAT_WEIGHT) for w, t in fixed.items()}
        self.cache = dict(self.fixed)

    def tag(self, token: str) -> tuple[int, float]:
        """Tag and own weight of a token; an insult's weight is that of its heaviest pattern."""
        weight = max((self.insults[x] for x in patterns(token) if x in self.insults), default=0.0)
        found = (INSULT, weight) if weight else (OTHER, 0.0)
        if len(self.cache) >= CACHE_ENTRIES:
            self.cache = dict(self.fixed)
        if len(token) <= 64:
            self.cache[token] = found
        return found

    def clauses(self, text: str | None) -> tuple[list[float], int]:
        """Scores of the clauses that match, in order, and the number of tokens."""
        tokens = _TOKEN.findall(text.lower()) if text else []
        get = self.cache.get
        tags = [get(t) or self.tag(t) for t in tokens]
        out, state, total, arcs = [], 0, 0.0, self.arcs
        for tag, own in tags:
            state, kind, w = arcs[state][tag]
            if kind == END:
                if total:
                    out.append(total)
                total = 0.0
            elif w:  # a threat's object brings the threat's own weight
                total += w * (own if kind == INSULT else THREAT_WEIGHT)
        return ([*out, total] if total else out), len(tokens)

    def features(self, text: str | None) -> tuple[float, ...]:
        """Highest clause, number and sum of matched clauses, and their share of the text; all 0 without a match."""
        found, n = self.clauses(text)
        return (max(found), math.log1p(len(found)), math.log1p(sum(found)), math.log1p(100 * sum(found) / n)) if found else (0.0,) * 4


FEATURES = ["high", "many", "total", "share"]


def learn(docs: DataFrame, labels: DataFrame, *, target: str = "toxic", sample: int = 12_000, support: int = 6, least: float = 1.5) -> tuple[dict[str, float], np.ndarray]:
    """Insult patterns with weights, and the calibration (constant and a factor for each of ``FEATURES``).

    Both come from one bounded sample of labelled rows. A pattern occurs in ``support`` toxic documents or more, so the sample bounds
    their number too. Rows are in two halves, by their sketch; the calibration reads the clauses of a half with patterns from the
    other, as patterns fit the rows that they were learned from too well. Without labels of both kinds there are no
    patterns, and every score is about the share of toxic labels, near 0 without any.
    """
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    rows = sampled(docs, labels, target, sample).filter("y IN (0, 1)").withColumn("w", words)
    triples = F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - 3, F.lit(0))), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))
    one = rows.withColumn("sketch", F.array_min(triples)).groupBy("y", "sketch").agg(F.min(F.struct("text", "w")).alias("x"))
    rows = stage(one.select("y", F.pmod("sketch", F.lit(2)).cast("int").alias("half"), "x.text", "x.w"), "labelled")
    n = {(r.y, r.half): r.n for r in rows.groupBy("y", "half").agg(F.count("*").alias("n")).collect()}
    toxic, other = (n.get((y, 0), 0) + n.get((y, 1), 0) for y in (1, 0))
    if not (toxic and other):
        return {}, np.array([math.log((toxic + 0.5) / (other + 1.0)) if toxic or other else -5.0, *[0.0] * len(FEATURES)])
    of = [F.count_if((F.col("y") == y) & (F.col("half") == h)).alias(f"n{y}{h}") for y in (0, 1) for h in (0, 1)]
    forms = rows.select("y", "half", F.explode(F.array_distinct("w")).alias("word")).groupBy("word").agg(*of)
    parts = F.array(*[F.when(F.length("word") >= k, F.substring("word", 1, k)) for k in STEMS], F.concat(F.lit("="), "word"))
    names = ["n00", "n01", "n10", "n11"]
    seen = forms.select(*names, F.explode(F.array_compact(parts)).alias("p")).groupBy("p").agg(*[F.sum(x).alias(x) for x in names])
    rare = max(2, support // 2)  # in one half
    seen = seen.filter((F.col("n10") + F.col("n11") >= support) | (F.col("n10") >= rare) | (F.col("n11") >= rare))
    odds = lambda a, b, t, o: math.log((a + 0.5) / (t + 1.0)) - math.log((b + 0.5) / (o + 1.0))
    insults, halves = {}, ({}, {})
    for r in seen.collect():
        if r.n10 + r.n11 >= support and (v := odds(r.n10 + r.n11, r.n00 + r.n01, toxic, other)) >= least:
            insults[r.p] = v
        for h in (0, 1):
            if r[f"n1{h}"] >= rare and (v := odds(r[f"n1{h}"], r[f"n0{h}"], n.get((1, h), 0), n.get((0, h), 0))) >= least:
                halves[h][r.p] = v

    @F.pandas_udf(", ".join(f"{x} double" for x in FEATURES))
    def features(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        matchers = [Matcher(halves[1 - h]) for h in (0, 1)]
        for texts, half in batches:
            yield pd.DataFrame([matchers[h].features(t) for t, h in zip(texts, half, strict=True)], columns=FEATURES, dtype=float)

    found = rows.select(features("text", "half").alias("f"), "y").select("f.*", "y").collect()  # at most ``sample`` narrow rows
    unstage(rows)
    x = np.array([(1.0, *(r[k] for k in FEATURES)) for r in found]).reshape(-1, len(FEATURES) + 1)
    return insults, _logistic(x, np.array([float(r.y) for r in found]))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by damped Newton steps, without negative factors: of those that come out negative the lowest goes, until
    none is. The constant (the first column) is free and not penalised."""
    w, open_ = np.zeros(x.shape[1]), list(range(x.shape[1]))
    while len(y):
        w[:] = 0
        w[open_] = _newton(x[:, open_], y, ridge)
        lowest = min(open_[1:], key=lambda i: w[i], default=0)
        if not lowest or w[lowest] >= 0:
            break
        open_.remove(lowest)
    return w


def _newton(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    w = np.zeros(x.shape[1])
    r = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + r @ w
        h = (x * (p * (1 - p))[:, None]).T @ x + r + 1e-6 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 4.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return w


def score(docs: DataFrame, insults: dict[str, float], calibration: np.ndarray, *, text: str = "text", out: str = "score") -> DataFrame:
    """Append the probability that a text is toxic to all rows; texts without a match (null, empty) get the base rate.

    Rows that repeat get the same score each, texts of any length are read whole, an empty table stays empty. Other columns are
    kept, but for one named like ``out``, which it replaces.
    """

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(insults)
        for batch in batches:
            x = np.array([(1.0, *matcher.features(t)) for t in batch]).reshape(-1, len(FEATURES) + 1)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ calibration, -35, 35))), dtype=float)

    return docs.withColumn(out, scored(F.col(text)))
