"""Searches over vectors: exact top-k by Fagin's threshold algorithm, nearest neighbours by multiprobe p-stable hashing.

Both hold a stated query set against all rows in blocks: rows are dealt to blocks of about ``BLOCK`` and queries to blocks of
about ``QUERIES``, by hashes of row numbers, so equal vectors or ids don't meet in one block. A pair of blocks is a task's
unit and bounds its memory; it builds its lists or hash tables, searches them, and emits at most k rows a query; a
window with a limit merges those.

Vectors that are null or empty or hold null or non-finite components take no part, nor do rows without an id. A query is
compared with vectors of its own length, and never with rows of its own id. Rows that repeat are candidates each, and
one query. Empty tables give no row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK, QUERIES = 8192, 2048


def _valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    df = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    return df.filter(F.col("id").isNotNull() & (F.size("v") > 0) & ~bad).withColumn("at", F.xxhash64(F.monotonically_increasing_id()))


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, sorted by id."""
    ids = table.column("id").to_numpy()
    v = table.column("v").combine_chunks()
    v = (v.flatten() if isinstance(v, pa.Array) else pa.chunked_array([c.flatten() for c in v.chunks], pa.float64())).to_numpy().reshape(len(ids), -1)
    order = np.argsort(ids, kind="stable")
    return ids[order], v[order]


Search = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], list[tuple[int, np.ndarray, np.ndarray]]]


def _in_blocks(df: DataFrame, is_query: Column, search: Search, kind: str, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of what ``search(row ids, rows, query ids, queries)`` finds in each block."""
    n, m = df.select(F.count("*"), F.count_if(is_query)).first()
    rows, asks = max(1, -(-n // BLOCK)), max(1, -(-m // QUERIES))
    each = lambda x: F.explode(F.sequence(F.lit(0), F.lit(x - 1)))
    size = F.size("v").alias("d")
    left = df.select(size, F.pmod("at", F.lit(rows)).cast("int").alias("i"), "id", "v").withColumn("j", each(asks))
    right = df.filter(is_query).groupBy("id", "v").agg(F.min("at").alias("at")).select(size, F.pmod("at", F.lit(asks)).cast("int").alias("j"), "id", "v").withColumn("i", each(rows))

    def block(x: pa.Table, q: pa.Table) -> pa.Table:
        found = search(*_matrix(x), *_matrix(q)) if len(x) and len(q) else []
        sizes = [len(f[1]) for f in found]
        columns = [pa.array(np.repeat(np.array([f[0] for f in found], np.int64), sizes) if found else np.empty(0, np.int64))]
        columns += [pa.array(np.concatenate([f[i] for f in found]) if found else np.empty(0, t)) for i, t in ((1, np.int64), (2, np.int64 if kind == "long" else np.float64))]
        return pa.Table.from_arrays(columns, names=["query_id", "vec_id", "score"])

    keys = ["d", "i", "j"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(block, f"query_id long, vec_id long, score {kind}")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        kept = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((ids[kept], -scores[kept]))][:k]


class SortedLists:
    """A block's rows in one list for each dimension, sorted by that component."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.order = np.ascontiguousarray(np.argsort(-x, axis=0, kind="stable").T)
        self.value = np.take_along_axis(x.T, self.order, 1)

    def top(self, q: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k rows with the largest inner products, by the threshold algorithm.

        Lists are read from the end that the query's component favours, all to the same depth, which grows fourfold;
        each row met is scored once. No unmet row can exceed the bound, the product of the query and the components last
        read, so the search stops when the kth score is above it.
        """
        n = len(self.x)
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        seen = ids == own
        places, scores = np.empty(0, np.int64), np.empty(0, self.x.dtype)
        start, end = 0, min(4, n)
        while True:
            met = np.zeros(n, bool)
            met[self.order[up, start:end]] = True
            met[self.order[down, n - end : n - start]] = True
            new = np.flatnonzero(met & ~seen)
            if end == n:  # all lists are read; with no list at all every score is 0
                new = np.flatnonzero(~seen)
            seen[new] = True
            if len(new):
                places, scores = np.concatenate((places, new)), np.concatenate((scores, self.x[new] @ q))
                kept = _best(scores, ids[places], k)
                places, scores = places[kept], scores[kept]
            bound = q[up] @ self.value[up, end - 1] + q[down] @ self.value[down, n - end]
            if end == n or len(scores) == k and scores[-1] > bound or seen.all():
                return places, scores
            start, end = end, min(n, 4 * end)


def scaled(scale: int, *vectors: np.ndarray) -> list[np.ndarray]:
    """floor(scale * v) of each, as whole numbers of the first type that has their inner products exactly: doubles, 64-bit
    integers, or Python's integers, which have no bound but are slow."""
    with np.errstate(over="ignore"):
        out = [np.floor(scale * v) for v in vectors]
    largest = max((float(np.abs(x).max()) for x in out if x.size), default=0.0)
    reach = largest * largest * max(v.shape[1] for v in vectors)
    if reach < 2.0**53:
        return out
    if reach < 2.0**62:
        return [x.astype(np.int64) for x in out]
    whole = np.frompyfunc(lambda x, v: int(x) if np.isfinite(x) else scale * int(v), 2, 1)
    return [whole(x, v) for x, v in zip(out, vectors, strict=True)]


def exact_top_k(vectors: DataFrame, is_query: Column, *, k: int = 5, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The k rows of each query with the largest integer inner products; ``is_query`` is a condition on column ``id``.

    Components may be of any finite size; only a score among the k best that a long can't hold is an error.
    """

    def search(ids, x, query_ids, q):
        x, q = scaled(scale, x, q)
        lists = SortedLists(x)
        found = []
        for own, v in zip(query_ids.tolist(), q, strict=True):
            places, scores = lists.top(v, ids, own, k)
            found.append((own, ids[places], scores.astype(np.int64)))
        return found

    return _in_blocks(_valid(vectors, vec_id, embedding), is_query, search, "long", k)


class HashTables:
    """p-stable hash tables of a block: a row's bucket is the vector of floor((a.x + b) / width) over Gaussian a.

    Inner products become distances: rows are divided by the largest norm and get a component that makes them unit
    vectors; queries are normalized. Then the nearest rows are those with the largest inner products.
    """

    def __init__(self, x: np.ndarray, largest: float, *, tables: int, functions: int, width: float, seed: int):
        self.x, self.width = x, width
        unit = x / largest
        unit = np.hstack((unit, np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(1)))[:, None]))
        rng = np.random.default_rng(seed)
        _, first = np.unique(x, axis=0, return_index=True)
        once = np.zeros(len(x), bool)
        once[first] = True
        self.tables = []
        for _ in range(tables):
            a, b = rng.normal(size=(unit.shape[1], functions)), rng.uniform(0, width, functions)
            codes = np.floor((unit @ a + b) / width)
            buckets, of = np.unique(codes, axis=0, return_inverse=True)
            of = of.ravel()
            self.tables.append((a[:-1], b, buckets, of, np.bincount(of, weights=once, minlength=len(buckets))))

    def candidates(self, q: np.ndarray, visit: float) -> np.ndarray:
        """For each query, which rows lie in a bucket visited in some table.

        The own bucket comes first, then perturbed ones by falling estimated success, that is by rising squared
        distance of the query's projections to the bucket's intervals, until the visited buckets hold a share ``visit`` of
        the block's distinct vectors; a bucket always counts and is taken whole.
        """
        out = np.zeros((len(q), len(self.x)), bool)
        unit = q / np.sqrt((q * q).sum(1))[:, None]
        for a, b, buckets, of, sizes in self.tables:
            y = (unit @ a + b) / self.width
            apart = np.zeros((len(q), len(buckets)), np.float32)
            for i in range(buckets.shape[1]):
                d = (y[:, i, None] - buckets[None, :, i]).astype(np.float32)
                d = np.maximum(np.maximum(-d, d - 1), 0)
                apart += d * d
            order = np.argsort(apart, axis=1, kind="stable")
            held = sizes[order]
            taken = np.cumsum(held, axis=1) - held < visit * sizes.sum()
            visited = np.zeros(apart.shape, bool)
            np.put_along_axis(visited, order, taken, 1)
            out |= visited[:, of]
        return out


def by_norm(x: np.ndarray, **how) -> list[tuple[np.ndarray, HashTables | None]]:
    """Tables for the rows of each octave of norms, so that a few very long vectors don't make all others alike; an octave of
    few rows has none."""
    octave = np.floor(np.log2(np.sqrt((x * x).sum(1))))
    out = []
    for o in np.unique(octave):
        at = np.flatnonzero(octave == o)
        out.append((at, HashTables(x[at], 2.0 ** (o + 1), **how) if len(at) >= 64 else None))
    return out


def candidates(indexes: list[tuple[np.ndarray, HashTables | None]], q: np.ndarray, n: int, visit: float) -> np.ndarray:
    """For each query, which rows are candidates in their octave; all of an octave without tables."""
    out = np.ones((len(q), n), bool)
    for at, index in indexes:
        if index is not None:
            out[:, at] = index.candidates(q, visit)
    return out


def nearest(vectors: DataFrame, is_query: Column, *, k: int = 20, tables: int = 4, functions: int = 8, width: float = 2.0, visit: float = 0.3, seed: int = 9, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The k rows of each query with the largest inner products among the candidates of all tables.

    Zero vectors take no part. Every row is in every table. Candidates are reranked on the original vectors, summed in
    the order of dimensions, so equal vectors have equal scores. A query with fewer candidates than k in a block and more
    rows there has all of the block's rows scored.
    """
    df = _valid(vectors, vec_id, embedding).filter(F.exists("v", lambda x: x != 0))

    def search(ids, x, query_ids, q):
        indexes = by_norm(x, tables=tables, functions=functions, width=width, seed=seed)
        found = []
        for start in range(0, len(q), 256):
            some = slice(start, start + 256)
            for own, v, c in zip(query_ids[some].tolist(), q[some], candidates(indexes, q[some], len(x), visit), strict=True):
                places = np.flatnonzero(c & (ids != own))
                if len(places) < k:
                    places = np.flatnonzero(ids != own)
                rough = x[places] @ v
                if len(places) > k:
                    least = np.partition(rough, len(rough) - k)[len(rough) - k]
                    places = places[rough >= least - 1e-9 * (1 + abs(least))]
                scores = np.zeros(len(places))
                for a, b in zip(x[places].T, v, strict=True):
                    scores += a * b
                kept = _best(scores, ids[places], k)
                found.append((own, ids[places[kept]], scores[kept]))
        return found

    return _in_blocks(df, is_query, search, "double", k)
