"""Token counts by a map-side two-tier lookup.

Tier one is a compact hash table of frequent pre-tokens and their lengths in tokens, broadcast to all workers. The
frequent pre-tokens are the tokenizer's own vocabulary entries: the strings its merges were learned from because they
are frequent. Its size is bounded by the vocabulary (about 50,000 entries), never by the corpus. Tier two is a cache in
each Python worker for all other pre-tokens, filled by the tokenizer library itself and emptied when it reaches its
bound. No pre-token is ever shuffled: the plan is a scan and a projection.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.llm.common import common_only

#: How the byte-level tokenizer splits a text before its merges (the published pattern of its file).
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Bound on the entries of a worker's cache, and on a cached pre-token's characters.
CACHE_ENTRIES, CACHE_CHARS = 400_000, 64


class PreTokenLengths:
    """Lengths in tokens of pre-tokens: a given table first, then this worker's cache, then the library."""

    def __init__(self, path: str, table: dict[str, int]):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        self.find = regex.compile(PRE_TOKEN).findall
        self.table, self.cache = table, {}

    def encode_length(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def count(self, text: str | None) -> int:
        """Tokens of a text as the library gives them; texts with special strings or rare characters go to it whole."""
        if not text:
            return 0
        if any(a in text for a in self.added) or not common_only(text):
            return self.encode_length(text)
        total, table, cache = 0, self.table, self.cache
        for piece in self.find(text):
            n = table.get(piece)
            if n is None:
                n = cache.get(piece)
                if n is None:
                    n = self.encode_length(piece)
                    if len(piece) <= CACHE_CHARS:
                        if len(cache) >= CACHE_ENTRIES:
                            cache.clear()
                        cache[piece] = n
            total += n
        return total


def frequent_lengths(path: str) -> dict[str, int]:
    """The first tier: lengths of all vocabulary entries that are pre-tokens, by encoding each once."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    added = {t.content for t in library.get_added_tokens_decoder().values()}
    entries = (library.decode([i]) for i in range(library.get_vocab_size()))
    whole = regex.compile(PRE_TOKEN).fullmatch
    pre_tokens = sorted({x for x in entries if x and x not in added and "�" not in x and whole(x)})
    return {x: len(e.ids) for x, e in zip(pre_tokens, library.encode_batch(pre_tokens, add_special_tokens=False), strict=True)}


_WORKER: dict[str, PreTokenLengths] = {}


def count_tokens(df: DataFrame, tokenizer: str, *, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Append the number of tokens of each whole text as column ``out``.

    All other columns are kept. A null or empty text has 0 tokens; repeated rows are counted alike; an empty table
    stays empty. ``tokenizer`` is the path of a byte-level tokenizer file that all nodes have.
    """
    spark: SparkSession = df.sparkSession
    table = spark.sparkContext.broadcast(frequent_lengths(tokenizer))

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if tokenizer not in _WORKER:  # the cache outlives the task
            _WORKER[tokenizer] = PreTokenLengths(tokenizer, table.value)
        count = _WORKER[tokenizer].count
        for batch in batches:
            yield pd.Series([count(x) for x in batch], dtype="int64")

    return df.withColumn(out, tokens(F.col(text)))
