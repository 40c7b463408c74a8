"""Benchmark decontamination: a generalised suffix automaton of the test items, past which documents stream.

Words are runs of digits, letters a to z (A to Z lower-cased) and whatever lies beyond ASCII. The automaton has a state
for each set of places in the items at which the same stretches of words end. A document's words move it along: at each
word the state stands for the longest stretch ending there that some item holds. Where that is a window's length or
more, the words of the window are hit, and the state that holds just the window knows its items; items shorter than a
window are found among the state's suffixes. The work is that of the document's words, whatever the number of items.

Items are dealt to shards of about ``SHARD_WORDS`` words, an item beyond ``PIECE_WORDS`` in pieces that overlap by a window
less one word. Each shard's automaton is built by a task and broadcast, at most ``SHARDS_AT_ONCE`` to a pass over the
documents; a larger benchmark takes more passes, whose hits are joined. So the size of what a worker holds is bounded.
"""

from __future__ import annotations

import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from genoweave.llm.common import stage

WINDOW, SHARD_WORDS, PIECE_WORDS, SHARDS_AT_ONCE = 10, 250_000, 50_000, 4

#: A word before A to Z are lower-cased.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")

#: What ``find`` adds: words, hit spans of word places [start, end), the items' ids in order, the longest match that hit.
FOUND = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string())), ("longest", pa.int32())])
FOUND_DDL = "struct<n_words: bigint, spans: array<struct<start: int, end: int>>, items: array<string>, longest: int>"


Shard = tuple[str, Broadcast]  # a name, and the automaton's bytes


def normalised(text: str) -> bytes:
    """The text's UTF-8 bytes, letters lower-cased, blanks for what is no word; places stay."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE)


class SuffixAutomaton:
    """A generalised suffix automaton over numbers. State 0 holds the empty stretch."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """A state for those stretches of q that end in w after p."""
        new = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = new
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = new
            p = self.link[p]
        return new

    def extend(self, p: int, w: int) -> int:
        """The state after word w, for the string whose state so far is p."""
        q = self.next[p].get(w)
        if q is not None:
            return q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        new = self._state(self.length[p] + 1, 0, {})
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new


def build(items: list[tuple[str | None, bytes]], window: int) -> bytes:
    """The automaton of items (id, words joined by blanks) as arrays: moves, suffix links, lengths, and for each state the
    state of the window that its stretches end in, the next state up that is a whole short item, and items by state."""
    vocabulary: dict[bytes, int] = {}
    texts = [[vocabulary.setdefault(w, len(vocabulary)) for w in words.split()] for _, words in items]
    made = SuffixAutomaton()
    for words in texts:
        at = 0
        for w in words:
            at = made.extend(at, w)
    n, link, length = len(made.length), made.link, made.length
    by_length = np.argsort(np.array(length), kind="stable").tolist()
    of_window = [0] * n
    for s in by_length:
        if length[s] >= window:
            of_window[s] = s if length[link[s]] < window else of_window[link[s]]
    names = sorted({i for i, _ in items if i is not None})
    number = {x: i for i, x in enumerate(names)}
    held: dict[int, set[int]] = {}
    for (item, _), words in zip(items, texts, strict=True):
        at = 0
        for k, w in enumerate(words, 1):
            at = made.next[at][w]
            if k >= window or k == len(words):
                state = of_window[at] if k >= window else at
                held.setdefault(state, set()).update(() if item is None else (number[item],))
    short = [0] * n
    for s in by_length[1:]:
        short[s] = s if s in held and length[s] < window else short[link[s]]
    states = sorted(held)
    owners = [sorted(held[s]) for s in states]
    moves = [(s * len(vocabulary) + w, t) for s, following in enumerate(made.next) for w, t in following.items()]
    arrays = {
        "key": np.array([m[0] for m in moves], np.int64), "to": np.array([m[1] for m in moves], np.int32), "link": np.array(link, np.int32), "length": np.array(length, np.int32), "of_window": np.array(of_window, np.int32),
        "short": np.array(short, np.int32), "states": np.array(states, np.int32), "counts": np.array([len(o) for o in owners], np.int32), "owners": np.array([i for o in owners for i in o], np.int32),
        "words": np.frombuffer(b" ".join(vocabulary), np.uint8), "names": np.frombuffer(json.dumps(names).encode(), np.uint8), "least": np.array([min((min(len(x), window) for x in texts if x), default=window)]),
    }
    out = io.BytesIO()
    np.savez_compressed(out, **arrays)
    return out.getvalue()


class Matcher:
    """Moves documents along a shard's automaton."""

    def __init__(self, blob: bytes, window: int):
        x = np.load(io.BytesIO(blob), allow_pickle=False)
        self.window, self.least = window, int(x["least"][0])
        self.number = {w: i for i, w in enumerate(x["words"].tobytes().split())}
        self.moves = dict(zip(x["key"].tolist(), x["to"].tolist(), strict=True))
        self.link, self.length, self.of_window, self.short = (x[k].tolist() for k in ("link", "length", "of_window", "short"))
        names, ends, owners = json.loads(x["names"].tobytes()), np.cumsum(x["counts"]).tolist(), x["owners"].tolist()
        self.held = {s: [names[i] for i in owners[a:b]] for s, a, b in zip(x["states"].tolist(), [0, *ends], ends, strict=False)}

    def match(self, words: list[bytes], hit: np.ndarray, items: set[str]) -> int:
        """Marks the hit words, adds the items found, and gives the longest match that hit."""
        number = np.fromiter(map(self.number.get, words, (-1 for _ in words)), np.int64, len(words))
        gaps = np.concatenate(([-1], np.flatnonzero(number < 0), [len(words)]))
        longest, seen = 0, set()
        for k in np.flatnonzero(np.diff(gaps) > self.least).tolist():  # stretches of known words, long enough for a hit
            start = int(gaps[k]) + 1
            longest = max(longest, self._walk(number[start : int(gaps[k + 1])].tolist(), start, hit, items, seen))
        return longest

    def _walk(self, numbers: list[int], start: int, hit: np.ndarray, items: set[str], seen: set[int]) -> int:
        moves, link, length, short, window, size = self.moves.get, self.link, self.length, self.short, self.window, len(self.number)
        state = matched = longest = 0
        for i, w in enumerate(numbers, start + 1):
            to = moves(state * size + w)
            while to is None:  # state 0 has a move for every known word
                state = link[state]
                matched = length[state]
                to = moves(state * size + w)
            state, matched = to, matched + 1
            if matched >= window:
                hit[i - window : i] = True
                longest = max(longest, matched)
                found = self.of_window[state]
                if found not in seen:
                    seen.add(found)
                    items.update(self.held.get(found, ()))
            found = short[state]
            if found:
                if length[found] > matched:  # the state itself, of which only shorter stretches match here
                    found = short[link[state]]
                if found:
                    hit[i - length[found] : i] = True
                    longest = max(longest, length[found])
                while found and found not in seen:
                    seen.add(found)
                    items.update(self.held[found])
                    found = short[link[found]]
        return longest


def _shards(benchmark: DataFrame, item_id: str, text: str, window: int) -> list[Shard]:
    """The broadcast automata of all shards; none if no item has a word. The driver sees one shard at a time."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).filter("text IS NOT NULL")
    total = items.agg(F.sum(F.regexp_count("text", F.lit(ITEM_WORD)).cast("long"))).first()[0] or 0
    shards = -(-total // SHARD_WORDS)
    if not shards:
        return []
    piece = PIECE_WORDS

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = normalised(text).split()
                for k in range(0, max(len(words) - window + 1, 1) if words else 0, piece):
                    part = b" ".join(words[k : k + piece + window - 1])
                    rows.append((zlib.crc32(part + (item or "").encode("utf-8", "surrogatepass")) % shards, item, part))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.binary())], names=["shard", "item", "words"])

    def automaton(key, t):
        blob = build(list(zip(t.column("item").to_pylist(), t.column("words").to_pylist(), strict=True)), window)
        return pa.table({"blob": pa.array([blob], pa.binary())})

    dealt = items.mapInArrow(pieces, "shard long, item string, words binary").distinct()
    made = dealt.groupBy("shard").applyInArrow(automaton, "blob binary")
    return [(uuid.uuid4().hex, spark.sparkContext.broadcast(bytes(r[0]))) for r in made.toLocalIterator()]


_WORKER: dict[str, Matcher] = {}


def _pass(shards: list[Shard], text: Column, window: int) -> Column:
    """The column of what the shards find in a text."""

    @F.arrow_udf(FOUND_DDL)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = [k for k, _ in shards]
        for gone in [k for k in _WORKER if k not in own]:  # of an earlier call in this worker
            del _WORKER[gone]
        for k, blob in shards:
            if k not in _WORKER:
                _WORKER[k] = Matcher(blob.value, window)
        for batch in batches:
            yield pa.array([_found([_WORKER[k] for k in own], x) for x in batch.to_pylist()], FOUND)

    return found(text)


def _found(matchers: list[Matcher], text: str | None) -> dict:
    words = normalised(text or "").split()
    hit, items, longest = np.zeros(len(words), bool), set(), 0
    for m in matchers:
        longest = max(longest, m.match(words, hit, items))
    edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8))).tolist()
    return {"n_words": len(words), "spans": [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)], "items": sorted(items), "longest": longest}


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def find(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, out: str = "found") -> DataFrame:
    """Appends column ``out`` (see ``FOUND``; one of that name is replaced) to all rows and columns of the documents.

    A window is ``window`` consecutive words of an item; an item of fewer words is one window, an item without words none.
    Words inside any occurrence of a window are hit. Null and empty texts have no words. Repeated documents are looked at
    alike; repeated items count once, items without an id hit words but aren't listed. Empty tables are fine.
    """
    shards = _shards(benchmark, item_id, item_text, window)
    if len(shards) <= SHARDS_AT_ONCE:
        return docs.withColumn(out, _pass(shards, F.col(text), window))
    row, part = _free(docs, "_row"), _free(docs, "_part")
    docs = stage(docs.withColumn(row, F.monotonically_increasing_id()), "decontamination")
    groups = [shards[i : i + SHARDS_AT_ONCE] for i in range(0, len(shards), SHARDS_AT_ONCE)]
    hits = reduce(DataFrame.union, [docs.select(row, _pass(g, F.col(text), window).alias(part)).filter(F.size(f"{part}.spans") > 0) for g in groups])
    both = hits.groupBy(row).agg(F.flatten(F.collect_list(f"{part}.spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(f"{part}.items")))).alias("items"), F.max(f"{part}.longest").alias("longest"))
    union = F.aggregate(  # spans in order, joined where they overlap or touch
        F.array_sort("spans"), F.array().cast("array<struct<start: int, end: int>>"),
        lambda done, x: F.when((F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["start"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"))))).otherwise(F.concat(done, F.array(x))),
    )
    both = both.select(row, union.alias("_spans"), F.col("items").alias("_items"), F.col("longest").alias("_longest"))
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(ITEM_WORD)).cast("long")
    none = lambda kind: F.array().cast(f"array<{kind}>")
    found = F.struct(words.alias("n_words"), F.coalesce("_spans", none("struct<start: int, end: int>")).alias("spans"), F.coalesce("_items", none("string")).alias("items"), F.coalesce("_longest", F.lit(0)).alias("longest"))
    return docs.join(both, row, "left").withColumn(out, found).drop(row, "_spans", "_items", "_longest")


def n_hit(found: Column) -> Column:
    """How many words the spans of ``find`` hold."""
    return F.aggregate(found["spans"], F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


@F.arrow_udf(StringType())
def _cut(text: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for x, cuts in zip(text.to_pylist(), spans.to_pylist(), strict=True):
        if x and cuts:
            raw, places = x.encode("utf-8", "surrogatepass"), [m.span() for m in _WORD.finditer(normalised(x))]
            kept, at = [], 0
            for c in cuts:
                kept.append(raw[at : places[c["start"]][0]])
                at = places[c["end"] - 1][1]
            x = b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")
        out.append(x)
    return pa.array(out, pa.string())


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, max_coverage: float = 0.5, text: str = "text", **how) -> DataFrame:
    """The documents with hit spans cut from their texts; those with more than ``max_coverage`` of their words hit go.

    A cut runs from the first character of a span's first word to the last of its last one. Columns stay as they are.
    """
    found = _free(docs, "found")
    df = find(docs, benchmark, text=text, out=found, **how)
    df = df.filter(n_hit(F.col(found)) <= F.lit(max_coverage) * F.col(f"{found}.n_words"))
    return df.withColumn(text, F.when(F.size(f"{found}.spans") > 0, _cut(F.col(text), F.col(f"{found}.spans"))).otherwise(F.col(text))).select(*docs.columns)
