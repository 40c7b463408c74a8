"""Hard-negative mining over k-means inverted lists.

K-means on a bounded sample of rows gives centroids; every row goes to the list of its nearest one, and each list stores
its radius, the largest distance of its rows from the centroid. By Cauchy-Schwarz an anchor's inner products with a list's
rows lie within ``anchor . centroid`` plus or minus ``|anchor| radius``. So a search visits lists by falling upper bound, skips
those whose bounds lie outside the window of wanted scores, and stops when the upper bound falls strictly below the kth
score found (an equal one may still hold a tie with a smaller id). It does so in two waves: the first visits the
first lists of the order, which gives each search a kth score; the second visits all lists that this score doesn't rule out.
A wave is a join of searches with lists on the list's number; what isn't visited isn't shuffled. Results are exact.

Lists beyond ``PART_ROWS`` rows (a vector that a third of the rows share) are dealt to parts of that size with the list's
centroid and radius, and searches to blocks of ``ASKS``, so a task's memory is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.llm.common import stage
from genoweave.llm.vector_search import _best, scaled

#: Rows a list should have, lists at most, numbers in the sample and in all centroids at most, rows of a part, searches of a
#: block, rows that the first wave's lists hold at least.
LIST_ROWS, MAX_LISTS, SAMPLE_VALUES, CENTROID_VALUES, PART_ROWS, ASKS, FIRST_ROWS = 1024, 1024, 1 << 20, 1 << 22, 8192, 8192, 256

FOUND = "a long, win int, vec_id long, score long"


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    """Centroids by Lloyd's rounds from k distinct rows; those that lose all rows go."""
    x = np.clip(np.nan_to_num(x, posinf=1e100, neginf=-1e100), -1e100, 1e100)
    distinct = np.unique(x, axis=0)
    c = distinct[np.sort(np.random.default_rng(seed).permutation(len(distinct))[:k])]
    for _ in range(rounds):
        of = _nearest(x, c)
        n = np.bincount(of, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, of, x)
        c = sums[n > 0] / n[n > 0, None]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        apart = (c * c).sum(1)[None, :] - 2 * (x @ c.T)
    return np.argmin(np.nan_to_num(apart, nan=np.inf), axis=1)


def _whole(v: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.floor(scale * v)


def _arrays(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) and column.num_chunks else column.flatten() if isinstance(column, pa.Array) else None
    return np.empty((0, d)) if flat is None else flat.to_numpy(zero_copy_only=False).reshape(-1, d)


def _rows(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    df = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"), F.col(label).cast("string").alias("label"))
    df = df.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & ~bad)
    return df.withColumns({"d": F.size("v"), "at": F.xxhash64(F.monotonically_increasing_id())})


class InvertedLists:
    """All rows in lists by nearest centroid, staged in the shared folder; the table of lists is small and bounded."""

    def __init__(self, rows: DataFrame, scale: int):
        spark = rows.sparkSession
        self.scale = scale
        self.n, widest = rows.agg(F.count("*"), F.max("d")).first()
        k = max(1, min(self.n // LIST_ROWS, MAX_LISTS, CENTROID_VALUES // (widest or 1)))
        every = max(1, -(-self.n * (widest or 1) // SAMPLE_VALUES))

        def fit(key, t):
            d = key[0].as_py()
            c = kmeans(_whole(_arrays(t.column("v"), d), scale), k)
            return pa.table({"d": pa.array([d] * len(c), pa.int32()), "centroid": pa.array(c.tolist(), pa.list_(pa.float64()))})

        sample = rows.filter(F.pmod("at", F.lit(every)) == 0).select("d", "v")
        centroids: dict[int, list] = {}
        for r in sample.groupBy("d").applyInArrow(fit, "d int, centroid array<double>").collect():  # at most CENTROID_VALUES numbers a length
            centroids.setdefault(r.d, []).append(r.centroid)
        self.centroids = {d: np.array(c) for d, c in centroids.items()}
        shared = spark.sparkContext.broadcast(self.centroids)

        @F.arrow_udf("struct<list: int, far: double>")
        def place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for b in batches:
                size = np.diff(b.offsets.to_numpy())
                of, far = np.zeros(len(b), np.int32), np.zeros(len(b))
                for d in np.unique(size).tolist():
                    at = np.flatnonzero(size == d)
                    x = _whole(_arrays(b.take(pa.array(at)), d), scale)
                    c = shared.value.get(d, np.zeros((1, d)))  # a length that the sample missed has one list around 0
                    of[at] = _nearest(x, c)
                    with np.errstate(over="ignore", invalid="ignore"):
                        far[at] = np.sqrt(((x - c[of[at]]) ** 2).sum(1))
                yield pa.StructArray.from_arrays([pa.array(of), pa.array(np.nan_to_num(far, nan=np.inf, posinf=np.inf))], names=["list", "far"])

        placed = rows.withColumn("_p", place("v")).select("d", "_p.list", "_p.far", "at", "id", "label", "v")
        self.rows = stage(placed, "lists")
        self.table = [tuple(r) for r in self.rows.groupBy("d", "list").agg(F.max("far"), F.count("*")).collect()]  # a row for each list
        self.sizes = spark.createDataFrame([(d, i, -(-n // PART_ROWS)) for d, i, _, n in self.table], "d int, list int, parts int")

    def of_length(self, d: int) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
        """Numbers, centroids, radii and sizes of the lists of one vector length."""
        own = [t for t in self.table if t[0] == d]
        every = self.centroids.get(d, np.zeros((1, d)))
        return [t[1] for t in own], every[[t[1] for t in own]], np.array([t[2] for t in own]), np.array([t[3] for t in own])


def bounds(q: np.ndarray, centroids: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lower and upper bounds of each row's inner products with each list, a hair wide for rounding; infinite where doubles
    don't reach."""
    with np.errstate(over="ignore", invalid="ignore"):
        middle, length = q @ centroids.T, np.sqrt((q * q).sum(1))[:, None]
        reach = length * radii[None, :]
        hair = 1e-9 * (reach + length * np.sqrt((centroids * centroids).sum(1))[None, :]) + 1e-6
        low, high = middle - reach - hair, middle + reach + hair
    return np.where(np.isfinite(low), low, -np.inf), np.where(np.isfinite(high), high, np.inf)


def _plan(low: np.ndarray, high: np.ndarray, sizes: np.ndarray, wanted: list[dict], wave: int) -> np.ndarray:
    """Which lists a search visits in a wave. Both waves know the same first lists, as these don't depend on kth scores."""
    inside = np.zeros(len(high), bool)
    alive = np.zeros(len(high), bool)
    for w in wanted:
        fits = np.ones(len(high), bool)
        if w["low"] is not None:
            fits = (high >= w["low"]) & (low <= w["high"])
        inside |= fits
        alive |= fits if w["kth"] is None else fits & (high >= w["kth"])
    order = np.flatnonzero(inside)[np.argsort(-high[inside], kind="stable")]
    ahead = np.cumsum(sizes[order]) - sizes[order]
    first = np.zeros(len(high), bool)
    first[order[ahead < FIRST_ROWS]] = True
    return np.flatnonzero(first if wave == 1 else alive & ~first)


def _visits(asks: DataFrame, lists: InvertedLists, wave: int) -> DataFrame:
    """The searches, a row for each list that they visit in a wave."""
    tables = asks.sparkSession.sparkContext.broadcast({d: lists.of_length(d) for d in {t[0] for t in lists.table}})
    scale = lists.scale

    @F.arrow_udf("array<int>")
    def plan(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for v, windows in batches:
            out = []
            for x, wanted in zip(v.to_pylist(), windows.to_pylist(), strict=True):
                numbers, centroids, radii, sizes = tables.value[len(x)]
                low, high = bounds(_whole(np.array([x]), scale), centroids, radii)
                out.append([numbers[i] for i in _plan(low[0], high[0], sizes, wanted, wave)])
            yield pa.array(out, pa.list_(pa.int32()))

    return asks.withColumn("list", F.explode(plan("v", "wins")))


def _search(asks: DataFrame, n_asks: int, lists: InvertedLists, wave: int, same: bool, k: int) -> DataFrame:
    """a, win, vec_id, score: for each search and window, the k best rows of each part of each list visited."""
    blocks, scale = max(1, -(-n_asks // ASKS)), lists.scale
    sizes = F.broadcast(lists.sizes)  # a row for each list
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    right = _visits(asks, lists, wave).join(sizes, ["d", "list"]).withColumns({"block": F.pmod("a", F.lit(blocks)).cast("int"), "part": part}).drop("parts")
    left = lists.rows.join(sizes, ["d", "list"]).withColumn("part", F.pmod("at", F.col("parts").cast("long")).cast("int")).drop("parts", "far", "at")
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def visit(key, rows, q):
        out: list[list] = [[], [], [], []]
        if len(rows) and len(q):
            d = key[0].as_py()
            x, y = scaled(scale, _arrays(rows.column("v"), d), _arrays(q.column("v"), d))
            ids = rows.column("id").to_numpy()
            codes = pa.chunked_array([*rows.column("label").chunks, *q.column("label").chunks]).combine_chunks().dictionary_encode().indices.to_numpy()
            own, of = codes[: len(ids)], codes[len(ids) :]
            asked = zip(q.column("a").to_pylist(), q.column("id").to_pylist(), of.tolist(), q.column("wins").to_pylist(), strict=True)
            chunk = max(1, (1 << 21) // len(ids))
            for j, (a, anchor, label, wanted) in enumerate(asked):
                if j % chunk == 0:
                    scores = x @ y[j : j + chunk].T
                s = scores[:, j % chunk]
                at = np.flatnonzero((own == label if same else own != label) & (ids != anchor))
                for w in wanted:
                    fits = at if w["low"] is None else at[(s[at] >= w["low"]) & (s[at] <= w["high"])]
                    if len(fits):
                        best = fits[_best(s[fits], ids[fits], k)]
                        for column, values in zip(out, ([a] * len(best), [w["win"]] * len(best), ids[best].tolist(), [int(z) for z in s[best].tolist()]), strict=True):
                            column.extend(values)
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["a", "win", "vec_id", "score"])

    keys = ["d", "list", "part", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(visit, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("a", "win").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _both_waves(asks: DataFrame, n_asks: int, lists: InvertedLists, same: bool, k: int) -> DataFrame:
    first = _ranked(_search(asks, n_asks, lists, 1, same, k), k)
    if len(lists.table) < 2:
        return first
    first = stage(first, "first")
    kth = first.groupBy("a", "win").agg(F.count("*").alias("n"), F.min("score").alias("score")).filter(F.col("n") == k)
    kth = kth.groupBy("a").agg(F.map_from_entries(F.collect_list(F.struct("win", "score"))).alias("kth"))  # an entry for each window of a search
    wins = F.transform("wins", lambda w: w.withField("kth", F.element_at("kth", w["win"])))
    rest = _search(asks.join(kth, "a", "left").withColumn("wins", wins).drop("kth"), n_asks, lists, 2, same, k)
    return _ranked(first.drop("rank").union(rest), k)


def mine(
    vectors: DataFrame, is_anchor: Column, *, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are inner products of components floor(``scale`` * x), exact whole numbers. An anchor (``is_anchor``, a condition on
    column ``id``) has as positives its ``positives`` best other rows of its label; each positive has the ``negatives`` best
    rows of other labels whose score lies between ``least`` and ``most`` per cent of its own; ties go to the smaller id.

    Rows without id or label take no part, nor do vectors that are null, empty or hold null or non-finite components, and only
    vectors of one length meet. Repeated rows are candidates each and one anchor; a row of the anchor's own id is
    neither positive nor negative. Rows of one id with other vectors or labels are anchors each. An empty table gives
    no row. Only a score among the best that a long can't hold is an error.
    """
    lists = InvertedLists(_rows(vectors, vec_id, embedding, label), scale)
    none = F.lit(None).cast("long")
    # what a search wants: a window's number, its lowest and highest score, the kth score found so far
    window = lambda win, low, high: F.struct(win.cast("int").alias("win"), low.alias("low"), high.alias("high"), none.alias("kth"))
    anchors = stage(lists.rows.filter(is_anchor).groupBy("d", "id", "label", "v").agg(F.min("at").alias("a")), "anchors")
    n_asks = anchors.count()
    found = stage(_both_waves(anchors.withColumn("wins", F.array(window(F.lit(1), none, none))), n_asks, lists, True, positives), "positives")
    share = lambda f, cents: f(F.col("score").cast("decimal(20,0)") * cents / 100).cast("long")
    wanted = found.select("a", "rank", share(F.ceil, least).alias("low"), share(F.floor, most).alias("high")).filter("low <= high")
    wanted = wanted.groupBy("a").agg(F.collect_list(window(F.col("rank"), F.col("low"), F.col("high"))).alias("wins"))
    hard = _both_waves(anchors.join(wanted, "a"), n_asks, lists, False, negatives)
    hard = hard.select("a", "win", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = found.select("a", F.col("rank").alias("win"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).join(anchors.select("a", F.col("id").alias("anchor_id")), "a")
    return named.join(hard, ["a", "win"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
