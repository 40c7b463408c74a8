"""Packing token sequences by Karmarkar-Karp multiway differencing.

Each task tokenizes its own documents, cuts them, and packs what it has read, so the plan is a scan and one narrow
step: no shuffle, no group that could grow, and a lost task is simply run again. A document's full windows stand
alone; its rest is cut into pieces of at most ``piece`` tokens. Batches of pieces are dealt to windows by multiway
differencing: the two partial partitions with the largest imbalance are merged, the fullest window of one with the
emptiest of the other, until one partition is left. Where its fullest window exceeds the capacity, the batch gets one
window more.
"""

from __future__ import annotations

import heapq
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from genoweave.llm.common import common_only

#: How the tokenizer splits lower-cased text before its merges (the published pattern of its file); bounds of the caches.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CACHE_ENTRIES, CACHE_CHARS = 300_000, 64  # words have twice as many
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


_NODE = 32  # bits of an entry for its node; the sum is above them


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Deal items to windows with near-equal sums; returns the item numbers of each window.

    A partial partition is a list of its windows that hold items, largest sum first, less the smallest sum of all windows
    (0 while some are empty). A window is one number, its sum and a node of a binary tree over items. Ties are broken by the
    order of creation, so results are repeatable.
    """
    n = len(sizes)
    left, right = [], []  # of inner nodes, which are numbered from n
    low = (1 << _NODE) - 1
    heap = [(-x if windows > 1 else 0, i, [x << _NODE | i]) for i, x in enumerate(sizes)]
    heapq.heapify(heap)
    tick = n
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        alone_a, alone_b = windows - len(b), windows - len(a)  # windows of one that meet an empty one of the other
        if alone_a >= len(a):
            c = a + b
        else:
            c = a[:alone_a] + b[:alone_b]
            for x, y in zip(a[alone_a:], reversed(b[alone_b:]), strict=True):
                c.append((x >> _NODE) + (y >> _NODE) << _NODE | n + len(left))
                left.append(x & low)
                right.append(y & low)
        c.sort(reverse=True)
        if len(c) == windows and (least := c[-1] >> _NODE):
            least <<= _NODE
            c = [x - least for x in c]
        heapq.heappush(heap, (-(c[0] >> _NODE), tick, c))
        tick += 1
    out = []
    for top in heap[0][2] if heap else []:
        items, open_ = [], [top & low]
        while open_:
            x = open_.pop()
            if x < n:
                items.append(x)
            else:
                open_ += (right[x - n], left[x - n])
        out.append(sorted(items))
    return out + [[] for _ in range(windows - len(out))]


def pack_sizes(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity`` for all items (none larger than it), as few as differencing can fill."""
    if not sizes:
        return []
    if max(sizes) > capacity:
        raise ValueError("an item exceeds the capacity")
    windows = -(-sum(sizes) // capacity)
    while True:
        dealt = differencing(sizes, windows)
        if max(sum(sizes[i] for i in w) for w in dealt) <= capacity:
            return [w for w in dealt if w]
        windows += 1


class Cache(dict):
    """A dictionary of two generations: when the young one is full it becomes the old one, whose entries come back when
    they are asked for. So what is frequent stays, and at most twice ``entries`` are held."""

    def __init__(self, entries: int, make):
        self.entries, self.make, self.old = entries, make, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
            if len(key) > CACHE_CHARS:
                return found
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class WordIds:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes, by bounded caches over words and pre-tokens.

    The tokenizer drops white space and never merges across it, so a text's ids are those of its words, and a word's
    those of its pre-tokens, which the library's own merge model gives. Texts with special strings or rare characters go
    to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.added = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        self.find = regex.compile(PRE_TOKEN).findall
        self.merge, self.as_bytes = self.library.model.tokenize, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.pre_tokens = Cache(CACHE_ENTRIES, self._merged)
        self.words = Cache(2 * CACHE_ENTRIES, self._word)

    def _merged(self, piece: str) -> bytes:
        form = piece if piece.isascii() else self.as_bytes(piece)[0][0]
        return struct.pack(f"<{len(found := self.merge(form))}I", *[t.id for t in found])

    def _word(self, word: str) -> bytes:
        of, word = self.pre_tokens, word.lower()  # lowering first: a lowered letter can hold a mark, as that of U+0130 does
        if word.isalpha():  # letters alone are one pre-token, and so is a last mark
            return of[word]
        if word[-1] in ".,;:!?" and word[:-1].isalpha():
            return of[word[:-1]] + of[word[-1]]
        return b"".join([of[x] for x in self.find(word)])

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(a in text for a in self.added) or not common_only(text):
            return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.words.__getitem__, text.split()))


_WORKER: dict[str, WordIds] = {}


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 1, piece: int = 256, batch: int = 2048) -> DataFrame:
    """Cut and pack all documents (columns ``doc_id`` and ``text``; others are ignored) into sequences.

    Returns a row per piece, see ``PIECES``. A null or empty text has the end id alone; a null ``doc_id`` stays null;
    a repeated row is packed as often as it occurs; an empty table gives no piece. ``batch`` is the number of pieces
    that are dealt at once and bounds a task's memory. ``sequence_id`` is the task's number and a counter.
    """
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _WORKER:
            _WORKER[tokenizer] = WordIds(tokenizer)
        encode = _WORKER[tokenizer].ids
        sequence = TaskContext.get().partitionId() << 36
        done: list[tuple] = []
        rest: list[tuple] = []  # pieces that wait for their window

        def deal() -> None:
            nonlocal sequence, rest
            for window in pack_sizes([x[2] for x in rest], capacity):
                at = 0
                for i in window:
                    done.append((*rest[i], sequence, at))
                    at += rest[i][2]
                sequence += 1
            rest = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [[]] * 7
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=names)

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = encode(text.as_py()) + end
                total = len(ids) // 4
                start = 0
                while total - start >= capacity:
                    done.append((doc_id, start, capacity, zlib.crc32(ids[4 * start : 4 * (start + capacity)]), total, sequence, 0))
                    sequence += 1
                    start += capacity
                while start < total:
                    n = min(piece, total - start)
                    rest.append((doc_id, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), total))
                    start += n
                if len(rest) >= batch:
                    deal()
            yield flush()
        deal()
        yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)
