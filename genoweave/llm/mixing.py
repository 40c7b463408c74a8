"""Mixing sources to target weights by systematic sampling.

Within a source the documents lie in a fixed order, and their expected copies have a prefix sum. One random offset per source is
added, and a document is emitted once per integer boundary that its interval crosses. The order is that of size class and a
hash of the id, so neighbours have near-equal sizes, and which of them is taken hardly matters.

What does matter is whether the few documents are taken that hold much of a small source. So the order begins with these: it
has three levels, documents above 1/32 of their source's size, above 1/1024, and all others. A document of the first level expects
target over size copies. What the first level then takes above or below its share is made good by the next: its documents
expect what is left of the target over what is left of the source, and so again for the last. As what is made good is 0 on
average, every document's chance is that of its source's rate, and the words taken come as close to the target as a document of
the last level is long. In a large source all documents are of the last level.

A source may hold most of the rows, so ranks are not taken in one window over a source: documents are counted by
(source, level, size class, hash bucket), the counts have a prefix sum within the level, and only the rank inside a bucket
comes from a window. The table of counts is bounded by classes x buckets for each source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.llm.common import n_words, stage

CAP, WEIGHTS, SEED = 3, (1, 2, 3), 42
#: A document above these parts of its source is of level 0, 1, ...; others of the last.
LEVELS = (32, 1024)


def _sized(docs: DataFrame) -> DataFrame:
    """Adds the size, its class of 16 steps an octave, the hash bucket, a tie-break and a source key without nulls."""
    df = docs.withColumn("_size", n_words(F.col("text")))
    df = df.withColumn("_cls", F.expr("CASE WHEN _size < 16 THEN _size ELSE 16L * (length(bin(_size)) - 1) + shiftright(_size, length(bin(_size)) - 5) END"))
    df = df.withColumn("_bucket", F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 2)).withColumn("_tie", F.xxhash64("text"))
    return df.withColumn("_key", F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source")))


def targets(totals: DataFrame, *, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds each source's target to (_key, source, source_size).

    Sources are in code-point order, null last; weights repeat over them. Targets share the sum of all sizes by weight;
    those above ``cap`` times their size stop there, and the rest is shared anew. Sorted by cap over weight, a source
    stops exactly if its ratio isn't above what is then left for each unit of weight, so one pass of prefix sums finds
    the level. There is a row for each source here, however many documents there are.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    array = F.array(*[F.lit(w) for w in weights])
    df = totals.withColumn("_w", F.element_at(array, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    df = df.withColumn("_cap", F.col("source_size") * cap)
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    df = df.withColumn("_all", F.sum("source_size").over(everything))
    df = df.withColumn("_left", F.col("_all") - F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_cap"))
    df = df.withColumn("_weight", F.sum("_w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
    df = df.withColumn("_full", F.col("_cap") * F.col("_weight") <= F.col("_left") * F.col("_w"))
    df = df.withColumn("_rest", F.col("_all") - F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0)).over(everything)).withColumn("_open", F.sum(F.when(F.col("_full"), 0).otherwise(F.col("_w"))).over(everything))
    share = F.col("_rest").cast("double") * F.col("_w") / F.col("_open")
    return df.withColumn("target", F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(share)).select("_key", "source", "source_size", "target")


def _levelled(sized: DataFrame) -> DataFrame:
    level = F.lit(len(LEVELS))
    for i, part in reversed(list(enumerate(LEVELS))):
        level = F.when(F.col("_size") * part > F.col("source_size"), i).otherwise(level)
    return sized.withColumn("_level", level)


def _crossed() -> Column:
    """Integer boundaries that a document's interval crosses: ``_rate`` long, it ends at ``_start`` plus its rank times the rate."""
    edge = lambda rank: F.floor(F.col("_start") + rank.cast("double") * F.col("_rate"))
    n = edge(F.col("_rank")) - edge(F.col("_rank") - 1)
    return F.greatest(F.floor("_rate"), F.least(F.ceil("_rate"), n))  # whatever the last bit of a sum


def copies(docs: DataFrame, *, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """Adds ``size``, ``source_size``, ``target`` and ``copies`` to all documents (``doc_id``, ``text``, ``source``).

    A null text has size 0, and documents of size 0 are copied like others of their source; a source of size 0 has
    target 0 and no copies. A null source is a source of its own, the last. Rows that repeat are sampled one by one.
    Extra columns are kept; those named as the added ones are replaced. An empty table stays empty.
    """
    given = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    needed = ("doc_id", "text", "source")
    inner = {c: c if c in needed else f"given{i}" for i, c in enumerate(given)}  # so that no name can clash
    docs = docs.select(*[F.col(f"`{c}`").alias(inner[c]) for c in given])
    cell = ["_key", "_level", "_cls", "_bucket"]
    narrow = stage(_sized(docs.select(*needed)).drop("text"), "sizes")
    totals = narrow.groupBy("_key").agg(F.first("source").alias("source"), F.sum("_size").alias("source_size"))
    goals = stage(targets(totals, cap=cap, weights=weights).drop("source"), "targets")
    narrow = _levelled(narrow.join(goals.select("_key", "source_size"), "_key")).drop("source", "source_size")
    counts = narrow.groupBy(*cell).agg(F.count("*").alias("_n"), F.sum("_size").alias("_words"))
    before = Window.partitionBy("_key", "_level").orderBy("_cls", "_bucket").rowsBetween(Window.unboundedPreceding, 0)
    places = stage(counts.withColumn("_before", F.sum("_n").over(before) - F.col("_n")), "places")
    held = lambda x, i: F.coalesce(F.sum(F.when(F.col("_level") == i, F.col(x))), F.lit(0)).alias(f"{x}{i}")
    last = len(LEVELS)
    goals = goals.join(places.groupBy("_key").agg(*[held(x, i) for x in ("_n", "_words") for i in range(last + 1)]), "_key")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), "_key")), 1, 8), 16, 10).cast("double") / 4294967296.0
    goals = goals.withColumns({"_start0": offset, "_due": F.col("target"), "_open": F.col("source_size")})
    rank = F.col("_before") + F.row_number().over(Window.partitionBy(*cell).orderBy("_size", "doc_id", "_tie"))
    for i in range(last + 1):
        share = F.when(F.col("_open") > 0, F.greatest(F.lit(0.0), F.least(F.lit(float(cap)), F.col("_due") / F.col("_open")))).otherwise(0.0)
        goals = goals.withColumn(f"_rate{i}", share)
        if i < last:  # what this level takes is few documents' words
            own = narrow.filter(F.col("_level") == i).join(places, cell).withColumn("_rank", rank).join(goals.select("_key", F.col(f"_start{i}").alias("_start"), F.col(f"_rate{i}").alias("_rate")), "_key")
            took = own.groupBy("_key").agg(F.sum(F.col("_size") * _crossed()).alias("_took"))
            goals = goals.join(took, "_key", "left").na.fill(0, ["_took"])
            goals = goals.withColumns({"_due": F.col("_due") - F.col("_took"), "_open": F.col("_open") - F.col(f"_words{i}"), f"_start{i + 1}": F.col(f"_start{i}") + F.col(f"_n{i}") * F.col(f"_rate{i}")}).drop("_took")
            goals = stage(goals, "goals")
    rates = goals.select("_key", "source_size", "target", F.explode(F.array(*[F.struct(F.lit(i).alias("_level"), F.col(f"_start{i}").alias("_start"), F.col(f"_rate{i}").alias("_rate")) for i in range(last + 1)])).alias("_l")).select("_key", "source_size", "target", "_l.*")
    places = stage(places.join(rates, ["_key", "_level"]).drop("_n", "_words"), "places")
    df = _levelled(_sized(docs).join(rates.filter("_level = 0").select("_key", "source_size"), "_key")).drop("source_size")
    df = df.join(places, cell).withColumn("_rank", rank).withColumn("copies", _crossed()).withColumn("size", F.col("_size"))
    return df.select(*[F.col(inner[c]).alias(c) for c in given], "size", "source_size", "target", "copies")


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus itself: each document repeated as often as it is copied, with its own columns.

    Columns named as those that ``copies`` adds are kept as well.
    """
    names = docs.columns
    inner = [c if c in ("doc_id", "text", "source") else f"own{i}" for i, c in enumerate(names)]
    found = copies(docs.toDF(*inner), **how)
    rows = found.select(*inner, F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int"))).alias("_copy"))
    return rows.select(*[F.col(i).alias(c) for i, c in zip(inner, names, strict=True)])
