"""Exact n-gram Jaccard join by parity sketches.

A document's set of word shingles becomes a bit sketch: each shingle flips one bit of a very wide vector, so the
Hamming distance of two sketches never exceeds the symmetric difference of the sets. Two sets of sizes a and b with
Jaccard similarity 0.8 differ in at most D = (a + b) / 9 shingles. A sketch is cut into parts, 0.8 for each shingle of the
least set of its size band (sizes from 2^c to 2^(c+1)), 64 at least, and by the pigeonhole principle one of any D + 1
parts is equal where at most D bits differ. A part's key is the XOR of random codes of its set bits.

A part is *good* if it holds two shingles or more (in bands below 64 shingles: one or more); a document emits its good
parts in order until it has D + 1 of them, else all parts that aren't empty. Goodness depends on a part's content alone, so
the first D + 1 good parts of the document that stops earlier hold one that the other document has, and emits, as
well: no link is lost, and empty parts and single shared shingles make no candidates. Where fewer than D + 1 parts hold
anything, an empty part may be the one that is equal; such a document emits a key of its band for that. A set joins
the next lower band too if a set there can be large enough.

Buckets of the same members are one bucket from then on, and copies of one set are one member. Candidates are verified on
the words themselves. Groups of copies are never expanded to pairs: in each bucket all members are first held against
the one that shares most buckets overall, and of these pairs each document verifies that with most shared buckets.
Only buckets that then hold more than one component have the rest compared, outliers against all, in blocks of
bounded size, by compact sketches: what the Hamming distance can't exclude is verified, or, where that is much,
an outlier's nearest members first, to begin with in its largest bucket, and the rest after these have merged components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import stage, unstage, words_of
from genoweave.llm.components import connected

#: Similarity as a fraction, the number of words in a shingle, the least number of parts of a sketch.
NUMERATOR, DENOMINATOR, WIDTH, PARTS = 4, 5, 5, 64
#: Rows of a block of either kind, members of a bucket that are held at once, documents verified against one in a task,
#: candidate pairs for each outlier that are verified without trying its nearest first.
BLOCK, HELD, STAR, MANY = 2048, 4096, 512, 8
FIRST, NEAREST, WHOLE = range(3)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; with fewer words than ``width`` the whole sequence is one."""
    words = words_of(text) if text else []
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter((digest(w) for w in words), np.uint64, len(words))
    odd = _mixed(np.arange(1, width + 1, dtype=np.uint64) * _ODD[0]) | np.uint64(1)
    if len(words) < width:
        return _mixed(np.array([(h * odd[: len(h)]).sum(dtype=np.uint64) + np.uint64(len(h))]))
    n = len(words) - width + 1
    total = h[:n] * odd[0]
    for j in range(1, width):
        total = total + h[j : j + n] * odd[j]
    return np.unique(_mixed(total))


def shingle_set(text: str | None, width: int = WIDTH) -> set:
    """The shingles themselves, for verification."""
    words = words_of(text) if text else []
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*[words[j:] for j in range(width)], strict=False))


def most_apart(a, b):
    """Largest symmetric difference of sets of sizes a and b that still link: (a + b) / 9 at 0.8."""
    return (a + b) * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)


def _band_keys(h: np.ndarray, code: np.ndarray, c: int, bound: int) -> np.ndarray:
    """Keys of the parts that a set emits in size band c if linked sets differ in at most ``bound`` shingles."""
    parts = np.uint64(max(PARTS, (4 << c) // 5))
    part = ((h >> np.uint64(32)) * parts) >> np.uint64(32)  # monotone in h, which is sorted
    first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    good = np.diff(np.append(first, len(h))) >= (2 if 1 << c >= PARTS else 1)
    chosen = np.flatnonzero(good)[: bound + 1] if good.sum() > bound else np.arange(len(first))
    key = np.bitwise_xor.reduceat(code, first)[chosen] ^ _mixed(part[first[chosen]] * np.uint64(64) + np.uint64(c))
    if len(first) <= bound:  # then an empty part may be all that a linked set shares
        key = np.append(key, np.uint64(c))
    return _mixed(key) >> np.uint64(24)


def keys_of(h: np.ndarray) -> np.ndarray:
    """All bucket keys of a set: its own size band's, and the next lower one's if a set there may link with it."""
    n = len(h)
    if not n:
        return np.empty(0, np.int64)
    c, code = n.bit_length() - 1, _mixed(h ^ _ODD[1])
    keys = [_band_keys(h, code, c, most_apart(n, n * DENOMINATOR // NUMERATOR))]
    below = (1 << c) - 1
    if n * NUMERATOR <= below * DENOMINATOR:
        keys.append(_band_keys(h, code, c - 1, most_apart(n, below)))
    return np.concatenate(keys).astype(np.int64)


def compact_sketch(h: np.ndarray) -> bytes:
    """A parity sketch of 2^(c+2) bits, two to four a shingle; XOR of its halves is the sketch of half the width."""
    bits = max(64, 4 << (len(h).bit_length() - 1)) if len(h) else 64
    odd = np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches as rows of 64-bit words, all folded to ``size`` bytes."""
    out = np.empty((len(sketches), size // 8), np.uint64)
    for i, s in enumerate(sketches):
        x = np.frombuffer(s, np.uint64)
        while len(x) > size // 8:
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        out[i] = x
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """A row per document: node (row id, final once staged), doc_id, hash of the text, set size, set fingerprint, compact
    sketch, bucket keys. A set that the same task has met before has no keys but that row as ``leader``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = (TaskContext.get().partitionId() << 33) - 1
        seen: dict[bytes, int] = {}
        for b in batches:
            nodes, sizes, prints, dense, leaders, keys, ends = [], [], [], [], [], [], [0]
            for text in b.column(2):
                node += 1
                h = shingle_hashes(text.as_py())
                mark = xxhash.xxh3_128_digest(h.tobytes())
                leader = seen.get(mark) if len(h) else None
                if leader is None and len(h):
                    if len(seen) >= 500_000:
                        seen.clear()
                    seen[mark] = node
                own = keys_of(h) if leader is None else np.empty(0, np.int64)
                nodes.append(node)
                sizes.append(len(h))
                prints.append(mark)
                dense.append(compact_sketch(h))
                leaders.append(leader)
                keys.append(own)
                ends.append(ends[-1] + len(own))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys) if keys else [], pa.int64()))
            columns = [pa.array(nodes, pa.int64()), b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(dense, pa.binary()), pa.array(leaders, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "doc_id", "text_hash", "n", "print", "dense", "leader", "keys"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, f"node long, doc_id {kind}, text_hash long, n long, print binary, dense binary, leader long, keys array<long>")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of several rows, from rows sorted by key: two sums that tell sets of members apart, the key, the members.

    Memory is that of a batch and ``HELD`` rows; a larger bucket comes in several pieces, which all have its key. Buckets
    with the members of one that the task has met lately are left out.
    """
    seen: set[tuple[int, int]] = set()
    pieces, open_ = 0, None  # pieces so far; the key of the bucket that they are from, if it may go on

    def rows(m: np.ndarray, m2: np.ndarray, key: np.ndarray, size: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        members = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(node, pa.int64()))
        return pa.RecordBatch.from_arrays([*[pa.array(x.astype(np.int64)) for x in (m, m2, key)], members], names=["m", "m2", "key", "nodes"])

    def piece(node: np.ndarray) -> pa.RecordBatch:
        nonlocal pieces
        pieces += 1
        return rows(np.array([open_]), np.array([-pieces]), np.array([open_]), np.array([len(node)]), node)

    def buckets(key: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
        size = np.diff(np.append(first, len(key)))
        node, first, size = node[np.repeat(size > 1, size)], first[size > 1], size[size > 1]
        start = np.cumsum(size) - size
        m, m2 = (np.add.reduceat(_mixed(node.astype(np.uint64) ^ o), start) if len(start) else np.empty(0, np.uint64) for o in _ODD[:2])
        if len(seen) > 500_000:
            seen.clear()
        new = np.array([not (x in seen or seen.add(x)) for x in zip(m.tolist(), m2.tolist(), strict=True)], bool)
        return rows(m[new], m2[new], key[first[new]], size[new], node[np.repeat(new, size)])

    key = node = np.empty(0, np.int64)  # the last bucket, while it is small
    for b in batches:
        k, x = b.column(0).to_numpy(), b.column(1).to_numpy()
        if open_ is not None and len(k):
            more = int(np.searchsorted(k, open_, "right"))
            if more:
                yield piece(x[:more])
            k, x, open_ = k[more:], x[more:], open_ if more == len(k) else None
        key, node = np.append(key, k), np.append(node, x)
        last = int(np.searchsorted(key, key[-1])) if len(key) else 0
        yield buckets(key[:last], node[:last])
        key, node = key[last:], node[last:]
        if len(key) > HELD:
            open_ = int(key[0])
            yield piece(node)
            key, node = key[:0], node[:0]
    yield buckets(key, node)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Those pairs (a, b, a_n, b_n, a_dense, b_dense) whose compact sketches don't exclude a link."""
    for batch in batches:
        keep = []
        for na, nb, sa, sb in zip(*[batch.column(i).to_pylist() for i in range(2, 6)], strict=True):
            u, v = folded([sa, sb], min(len(sa), len(sb)))
            keep.append(int(np.bitwise_count(u ^ v).sum()) <= most_apart(na, nb))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of rows (a, part, other, node, text) sorted by these: the text of a, then those to hold against it."""
    held, own = None, set()
    for batch in batches:
        a, b = [], []
        x = [batch.column(i).to_pylist() for i in range(4)]
        for hub, part, other, node, text in zip(*x, batch.column(4), strict=True):
            if not other:
                if held != (hub, part):
                    held, own = (hub, part), shingle_set(text.as_py())
                continue
            s = shingle_set(text.as_py())
            both = len(own & s)
            if both and both * DENOMINATOR >= NUMERATOR * (len(own) + len(s) - both):
                a.append(hub)
                b.append(node)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the distinct pairs (a, b) whose texts link, decided on their words.

    Texts move once, to the node ``a`` that they are held against; one with many others meets them in several tasks.
    """
    tasks = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).alias("tasks"))
    dealt = pairs.join(tasks, "a").select("a", F.pmod(F.xxhash64("b"), "tasks").cast("int").alias("part"), "b")
    need = dealt.select("a", "part", F.lit(True).alias("other"), F.col("b").alias("node"))
    need = need.union(dealt.select("a", "part", F.lit(False), "a").distinct())
    rows = texts.join(need, "node").select("a", "part", "other", "node", "text").repartition("a", "part").sortWithinPartitions("a", "part", "other", "node")
    return stage(rows.mapInArrow(_verified, "a long, b long").distinct(), "links")


def _outliers(whole: bool):
    """Blocks sorted by (key, i, j): outliers (kind 1) against members (kind 0); emits pairs that sketches don't exclude, as
    (outlier, member, Hamming distance), and for a block with such pairs a row of its key that says if these are all.

    They are all with ``whole``, or if there are at most two for each outlier; else an outlier's nearest member of the
    bucket's major component and its nearest other one come. A block has about ``BLOCK`` rows of either kind at most, so
    it is held in memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def compare() -> pa.RecordBatch:
            found = [(np.empty(0, np.int64),) * 4]
            u, v = ([r for r in held if r[3] == k] for k in (1, 0))
            if u and v:
                size = min(len(r[7]) for r in held)
                (nu, mu, cu), (nv, mv, cv) = ([np.array([r[k] for r in x]) for k in (4, 6, 5)] for x in (u, v))
                su, sv = folded([r[7] for r in u], size), folded([r[7] for r in v], size)
                step = max(1, 2_000_000 // (len(v) * su.shape[1]))
                for i in range(0, len(u), step):
                    k = slice(i, i + step)
                    apart = np.bitwise_count(su[k, None, :] ^ sv[None, :, :]).sum(-1, dtype=np.int64)
                    near = (apart <= most_apart(mu[k, None], mv[None, :])) & (cu[k, None] != cv[None, :])
                    near &= DENOMINATOR * np.minimum(mu[k, None], mv[None, :]) >= NUMERATOR * np.maximum(mu[k, None], mv[None, :])
                    x, y = np.nonzero(near)
                    found.append((nu[k][x], nv[y], apart[x, y], cv[y] == held[0][8]))
            a, b, d, major = (np.concatenate(x) for x in zip(*found, strict=True))
            complete = whole or len(a) <= 2 * len(u)
            if not complete:
                order = np.lexsort((b, d, major, a))
                a, b, d, major = (x[order] for x in (a, b, d, major))
                first = np.append(True, (a[1:] != a[:-1]) | (major[1:] != major[:-1]))
                a, b, d = a[first], b[first], d[first]
            keys = [held[0][0]] if len(a) else []
            held.clear()
            rows = [pa.concat_arrays([pa.array(x, pa.int64()), pa.nulls(len(keys), pa.int64())]) for x in (a, b, d)]
            rows += [pa.concat_arrays([pa.nulls(len(a), t), pa.array(x, t)]) for x, t in ((keys, pa.int64()), ([complete] * len(keys), pa.bool_()))]
            return pa.RecordBatch.from_arrays(rows, names=["a", "b", "d", "key", "complete"])

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and held[0][:3] != row[:3]:
                    yield compare()
                held.append(row)
        yield compare()

    return run


def _blocks(shared: DataFrame, comps: DataFrame, met: DataFrame, mode: int, only: DataFrame | None) -> DataFrame:
    """Staged rows (a, b, d) of pairs across components that share a bucket and that compact sketches don't exclude, and rows
    (key, complete) of the buckets that they are from. An outlier is compared in its largest bucket (mode FIRST), or in all,
    or in those with a key in ``only``."""
    rows = shared.join(comps, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    by_comp = rows.groupBy("key", "comp").agg(F.count("*").alias("c"))
    top = by_comp.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("m")).filter("m > top.c")  # of buckets with several components
    top = top.select("key", "m", F.col("top.comp").alias("major"), F.ceil(F.col("m") / BLOCK).cast("int").alias("is"), F.ceil((F.col("m") - F.col("top.c")) / BLOCK).cast("int").alias("js"))
    if only is not None:
        top = top.join(only, "key", "left_semi")
    outliers = rows.join(top, "key").filter("comp <> major")
    if mode == FIRST:
        largest = outliers.groupBy("node").agg(F.max(F.struct("m", "key", "comp", "major", "is", "js")).alias("x"))
        outliers = stage(largest.select("node", "x.*"), "largest")
        top = top.join(outliers.select("key").distinct(), "key", "left_semi")
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    order = ["key", "i", "j", "kind", "node", "comp", "major"]
    members = rows.join(top, "key").withColumn("i", place("is")).withColumn("j", each("js")).withColumn("kind", F.lit(0))
    outliers = outliers.withColumn("j", place("js")).withColumn("i", each("is")).withColumn("kind", F.lit(1))
    both = members.select(*order).union(outliers.select(*order)).join(met.select("node", "n", "dense"), "node").select("key", "i", "j", "kind", "node", "comp", "n", "dense", "major")
    both = both.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "kind")
    return stage(both.mapInArrow(_outliers(mode == WHOLE), "a long, b long, d long, key long, complete boolean").distinct(), "cross")


def components(docs: DataFrame) -> DataFrame:
    """A row per document (``doc_id``, ``text``): node, doc_id, text_hash, n_shingles, comp (a node of its component).

    A null text, or one without words, has no shingles and links with nothing. A null ``doc_id`` takes part like any
    other. Repeated rows are documents that link with each other. An empty table gives no row.
    """
    known = stage(sketches(docs), "sketches")
    bands = known.select(F.explode("keys").alias("key"), "node").repartition("key").sortWithinPartitions("key")
    sets = bands.mapInArrow(_shared, "m long, m2 long, key long, nodes array<long>").repartition("m", "m2").dropDuplicates(["m", "m2"])
    sets = stage(sets.select("key", F.explode("nodes").alias("node")), "sets")
    # copies of a set are one node from here on, their root: the first of each task, and of these the least
    lead = known.filter("leader IS NULL AND n > 0")
    first = lead.groupBy("print").agg(F.min("node").alias("rep"), F.count("*").alias("times")).filter("times > 1")
    apart = lead.select(F.col("node").alias("own"), "print").join(first, "print").filter("own <> rep").select("own", "rep")
    found = known.select("node", "doc_id", "text_hash", "n", F.coalesce("leader", "node").alias("own")).join(apart, "own", "left")
    found = stage(found.select("node", "doc_id", "text_hash", "n", F.coalesce("rep", "own").alias("root")), "documents")
    shared = stage(sets.join(found.select("node", "root"), "node").select("key", F.col("root").alias("node")).distinct(), "shared")
    met = stage(known.select("node", "doc_id", "text_hash", "n", "dense").join(shared.select("node").distinct(), "node", "left_semi"), "met")
    unstage(known, sets)
    ids = met.select(F.col("node"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    texts = hashed.join(ids, (F.col("text_hash") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("id"))).groupBy("node").agg(F.first("text").alias("text"))
    texts = stage(texts, "texts")

    degree = shared.groupBy("node").agg(F.count("*").alias("d"))
    hubs = shared.join(degree, "node").groupBy("key").agg(F.max(F.struct("d", (-F.col("node")).alias("h"))).alias("top")).select("key", (-F.col("top.h")).alias("hub"))
    stars = shared.join(hubs, "key").filter("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("c"))
    best = stars.groupBy("node").agg(F.max(F.struct("c", (-F.col("hub")).alias("h"))).alias("best")).select((-F.col("best.h")).alias("a"), F.col("node").alias("b"))
    side = lambda x: met.select(F.col("node").alias(x), F.col("n").alias(f"{x}_n"), F.col("dense").alias(f"{x}_dense"))
    full = best.join(side("a"), "a").join(side("b"), "b").filter(f"{DENOMINATOR} * least(a_n, b_n) >= {NUMERATOR} * greatest(a_n, b_n)")
    near = stage(full.select("a", "b", "a_n", "b_n", "a_dense", "b_dense").mapInArrow(_near, "a long, b long"), "near")
    links = _links(near, texts)
    comps, only, mode = connected(links), None, FIRST
    while True:
        cross = _blocks(shared, comps, met, mode, only)
        all_, by = cross.filter("a IS NOT NULL"), cross.filter("key IS NOT NULL")
        n = all_.agg(F.count("*").alias("pairs"), F.count_distinct("a").alias("outliers")).first()
        last = mode == WHOLE or mode == NEAREST and (not n.pairs or n.pairs <= MANY * n.outliers and by.filter("NOT complete").isEmpty())
        merged = 0
        if n.pairs:
            # all of them, or an outlier's nearest, which may merge components and so make others needless
            some = all_.groupBy("a").agg(F.min(F.struct("d", "b")).alias("m")).select("a", "m.b") if mode == NEAREST and not last else all_
            more = _links(some.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), texts)
            merged = more.count()
        if merged:
            links = links.union(more)
            comps = connected(links)
        if last:
            break
        if mode == NEAREST:
            only = by.select("key").distinct()
        mode = NEAREST if mode == FIRST or 2 * merged >= n.outliers and n.pairs > 64 * n.outliers else WHOLE
    comps = comps.withColumnRenamed("node", "root")
    out = found.join(comps, "root", "left").select("node", "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.coalesce("comp", "root").alias("comp"))
    unstage(shared, met, texts, near)
    return out


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id, the least doc_id of the document's component (null if it has none)."""
    found = components(docs)
    least = found.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return found.join(least, "comp").select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, that of the least doc_id; rows that repeat wholly are one document."""
    names = docs.columns
    inner = [c if c in ("doc_id", "text") else f"own{i}" for i, c in enumerate(names)]  # so that no name can clash
    docs = docs.toDF(*inner)
    found = stage(components(docs), "components")
    kept = found.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node", "text_hash")).alias("k")).select(F.col("k.doc_id").alias("id"), F.col("k.text_hash").alias("hash"))
    kept = kept.groupBy("id", "hash").agg(F.count("*").alias("groups"))
    times = found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("times"))
    kept = stage(kept.join(times, (F.col("hash") == F.col("text_hash")) & F.col("id").eqNullSafe(F.col("doc_id"))).select("id", "hash", "times"), "kept")
    unstage(found)

    def rows(which: str) -> DataFrame:
        some = kept.filter(which)
        return docs.withColumn("_hash", F.xxhash64("text")).join(some, (F.col("_hash") == some["hash"]) & F.col("doc_id").eqNullSafe(some["id"]), "left_semi")

    # only rows that repeat, if there are any, are moved with their texts to be made one
    one = rows("times = 1")
    if not kept.filter("times > 1").isEmpty():
        one = one.union(rows("times > 1").dropDuplicates(["doc_id", "_hash"]))
    return one.select(*[F.col(i).alias(c) for i, c in zip(inner, names, strict=True)])
