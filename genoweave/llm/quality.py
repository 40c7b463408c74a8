"""Quality classifier: hashed word n-gram logistic regression, trained by follow-the-regularised-leader updates.

A text has four views: words and pairs of words, and the shapes of words (letter case, digits, punctuation, repetition of
the word before) alone and in pairs, so unseen words still carry evidence. Words of more than ``LONGEST`` characters (text
without white space) are cut into consecutive pieces that all count as words. Each n-gram is hashed to a slot of its view's
table; a view's value at a slot is the share of the text's n-grams there, and a score is the sparse dot product of these
shares and the weights, through the logistic function.

Training reads a bounded sample of labelled rows (``sample``, those with the least hash of the id, so it is the same at every
run and size); the model's size is fixed by ``BITS``. Scoring is a scan and a projection with the broadcast weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS, VIEWS, SCALE = 17, 4, 20.0
SLOTS = 1 << BITS
CACHE_ENTRIES, LONGEST = 300_000, 64
_RUN = re.compile(r"(.)\1+")
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def shape(word: str) -> str:
    """Letters become A or a, digits 0, all else stays; runs become one."""
    return _RUN.sub(r"\1", "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word))


class Features:
    """Slots of a text's n-grams, by a bounded cache over words."""

    def __init__(self) -> None:
        self.cache: dict[str, tuple[int, int]] = {}

    def _hashes(self, word: str) -> tuple[int, int]:
        found = xxhash.xxh3_64_intdigest(word.lower()), xxhash.xxh3_64_intdigest(shape(word), 1)
        if len(self.cache) >= CACHE_ENTRIES:
            self.cache.clear()
        self.cache[word] = found
        return found

    def slots(self, text: str | None) -> list[np.ndarray]:
        """An array of slots for each view; a null or empty text has none in any."""
        words = text.split() if text else []
        if max(map(len, words), default=0) > LONGEST:
            words = [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]
        get = self.cache.get
        pairs = np.array([get(w) or self._hashes(w) for w in words], np.uint64).reshape(-1, 2)
        word, form = pairs[:, 0], pairs[:, 1].copy()
        form[1:][word[1:] == word[:-1]] ^= _Q
        out = []
        for x, view in ((word, 0), (form, 2)):
            both = x[:-1] * _P + (x[1:] ^ (x[1:] >> np.uint64(31)))
            for k, y in ((view, x), (view + 1, both)):
                y = (y ^ (y >> np.uint64(29))) * _Q
                out.append(((y >> np.uint64(64 - BITS)) + np.uint64(k * SLOTS)).astype(np.int64))
        return out


class FollowTheRegularisedLeader:
    """Per-coordinate FTRL-proximal logistic regression over sparse rows."""

    def __init__(self, size: int, *, alpha: float = 0.1, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def update(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        """One row with distinct coordinates ``at``."""
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - y) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def _row(views: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct coordinates and values: shares of each view, and a constant at the end of the table."""
    at, x = [np.array([VIEWS * SLOTS])], [np.ones(1)]
    for v in views:
        if len(v):
            slot, count = np.unique(v, return_counts=True)
            at.append(slot)
            x.append(SCALE * count / len(v))
    return np.concatenate(at), np.concatenate(x)


def sampled(docs: DataFrame, labels: DataFrame, target: str, sample: int) -> DataFrame:
    """text and y of at most ``sample`` labelled documents, those with the least hash of the id.

    Labels without id or label don't count; of several for an id the least does. Ids that repeat give several rows.
    """
    chosen = labels.select("doc_id", F.col(target).alias("y")).dropna().groupBy("doc_id").agg(F.min("y").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # at most ``sample`` narrow rows, so it may be broadcast
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.col("y").cast("int").alias("y"))


def train(docs: DataFrame, labels: DataFrame, *, target: str = "quality", sample: int = 8000, epochs: int = 3) -> np.ndarray:
    """Weights of all slots and the constant. One task sees the sample's sparse rows; without labels all are 0."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = Features().slots
        for b in batches:
            rows = [_row(slots(t.as_py())) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(2), pa.array([r[0].astype("<i4").tobytes() for r in rows], pa.binary()), pa.array([r[1].astype("<f4").tobytes() for r in rows], pa.binary())], names=["doc_id", "y", "at", "x"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            rows += [(np.frombuffer(a.as_py(), "<i4"), np.frombuffer(x.as_py(), "<f4"), y.as_py()) for a, x, y in zip(b.column(2), b.column(3), b.column(1), strict=True)]
        model = FollowTheRegularisedLeader(VIEWS * SLOTS + 1)
        for _ in range(epochs):
            for at, x, y in rows:
                model.update(at.astype(np.int64), x.astype(float), y)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights().astype("<f4").tobytes()], pa.binary())], names=["w"])

    rows = sampled(docs, labels, target, sample).mapInArrow(features, "doc_id long, y int, at binary, x binary")
    fitted = rows.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "at").mapInArrow(fit, "w binary").collect()
    return np.frombuffer(fitted[0].w, "<f4").astype(float) if fitted else np.zeros(VIEWS * SLOTS + 1)


def score(docs: DataFrame, weights: np.ndarray, *, text: str = "text", out: str = "score") -> DataFrame:
    """Append the probability of label 1 to all rows; empty and null texts get that of the constant alone.

    Rows that repeat get the same score each, texts of any length are read whole, an empty table stays empty. Other columns are
    kept, but for one named like ``out``, which it replaces.
    """
    model = docs.sparkSession.sparkContext.broadcast(weights.astype("<f4"))  # 2 MB, fixed by BITS

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        slots, w = Features().slots, model.value
        for batch in batches:
            sums = [sum((SCALE * w[v].mean(dtype=float) for v in slots(t) if len(v)), float(w[-1])) for t in batch]
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(sums, float), -35, 35))), dtype=float)

    return docs.withColumn(out, scored(F.col(text)))
