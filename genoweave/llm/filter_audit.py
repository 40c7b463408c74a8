"""Filter interaction audit: what each filter removes in every order of the filters, from one pass over the documents.

The pass aggregates joint-failure counts: for each set of filters, how many documents fail all of them, a sum of products
of flags. The rest is arithmetic on 32 numbers. Inclusion-exclusion gives the documents that no filter of a set removes
(the survivors of any prefix of any order), Möbius inversion those that fail a set exactly (unique failures), and the
same counts with their signs are the Harsanyi dividends of the game "removed by a set", whose equal shares are the
Shapley values. No order is ever run over documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.llm.common import WORD


def _signed(joint: str, sets: Iterable[tuple[int, int]]) -> str:
    """SQL for a sum of joint counts (set, factor)."""
    return " + ".join(f"{joint}[{s}] * {x}L" for s, x in sets) or "0L"


def joint_counts(rows: DataFrame, flags: Sequence[str], measures: Mapping[str, str], by: Sequence[str]) -> DataFrame:
    """For each key, a column a measure (an expression by name): an array with, at place s, the measure summed over rows
    that fail all filters of the set s (bit i is filter i); place 0 has all rows. ``flags`` are columns of 0 and 1."""
    sets = range(1 << len(flags))
    product = lambda s, m: " * ".join([f"({m})", *[f for i, f in enumerate(flags) if s >> i & 1]])
    sums = [F.expr(f"sum({product(s, m)}) AS _{name}{s}") for name, m in measures.items() for s in sets]
    return rows.groupBy(*by).agg(*sums).select(*by, *[F.array(*[f"_{name}{s}" for s in sets]).alias(name) for name in measures])


def survivors(joint: str, n: int) -> Column:
    """An array with, at place s, the rows that fail no filter of the set s: joint counts of its subsets, signs by size."""
    subsets = lambda s: ((t, (-1) ** t.bit_count()) for t in range(1 << n) if t & s == t)
    return F.expr(f"array({', '.join(_signed(joint, subsets(s)) for s in range(1 << n))})")


def exactly(joint: str, n: int) -> Column:
    """An array with, at place s, the rows that fail just the filters of the set s: the Möbius inverse over supersets."""
    supersets = lambda s: ((t, (-1) ** (t ^ s).bit_count()) for t in range(1 << n) if t & s == s)
    return F.expr(f"array({', '.join(_signed(joint, supersets(s)) for s in range(1 << n))})")


def shapley_sums(joint: str, n: int) -> Column:
    """An array with, for each filter, what it removes summed over all n! orders.

    The dividend of a set is its joint count, positive for odd sizes. A filter's Shapley value has an equal share of the
    dividend of every set that it is in, and n! is a multiple of each set's size.
    """
    shares = lambda i: ((t, factorial(n) // t.bit_count() * (-1) ** (t.bit_count() + 1)) for t in range(1 << n) if t >> i & 1)
    return F.expr(f"array({', '.join(_signed(joint, shares(i)) for i in range(n))})")


def report(joint: DataFrame, letters: str, by: Sequence[str], *, total: str = "n", lost: Mapping[str, str] | None = None) -> DataFrame:
    """A row for each key, each order of the filters and each step, from ``joint_counts``.

    ``letters`` name the filters. Counts are kept (after the step), removed (by it), redundant (failing its filter,
    removed earlier), unique_fails (failing its filter only), a column for each of ``lost`` (removed by the step, of the
    measure that it names), and shapley (removed by the step's filter, summed over all orders).
    """
    lost, n = dict(lost or {}), len(letters)
    orders = F.explode(F.array(*[F.lit("".join(p)) for p in permutations(letters)])).alias("filter_order")
    df = joint.select(
        *by, F.col(total).alias("_joint"), exactly(total, n).alias("_exactly"), shapley_sums(total, n).alias("_shapley"), survivors(total, n).alias("_kept"),
        *[survivors(m, n).alias(f"_kept_{name}") for name, m in lost.items()], orders,
    )
    df = df.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    of = lambda which, value: sum((F.when(which(x), value(i)).otherwise(0) for i, x in enumerate(letters)), F.lit(0))
    own, prefix = F.substring("filter_order", F.col("step"), F.lit(1)), F.substring("filter_order", F.lit(1), F.col("step"))
    df = df.withColumns({"_own": of(lambda x: own == x, lambda i: i), "_bit": of(lambda x: own == x, lambda i: 1 << i), "_after": of(lambda x: F.contains(prefix, F.lit(x)), lambda i: 1 << i)})
    df = df.withColumn("_before", F.col("_after") - F.col("_bit"))
    at = lambda name, place: F.col(name)[F.col(place)]
    removed = at("_kept", "_before") - at("_kept", "_after")
    return df.select(
        *by, "filter_order", "step", at("_kept", "_after").alias("kept"), removed.alias("removed"), (at("_joint", "_bit") - removed).alias("redundant"), at("_exactly", "_bit").alias("unique_fails"),
        *[(at(f"_kept_{name}", "_before") - at(f"_kept_{name}", "_after")).alias(name) for name in lost], at("_shapley", "_own").alias("shapley"),
    )


def text_flags(text: Column, words: Column) -> dict[str, Column]:
    """What fails by a text alone: A, under 200 words; B, fewer than half of the words distinct; C, more than 3 % of all
    characters A to Z; D, any of ``#$%&*|``."""
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    found = {"A": F.size(words) < 200, "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words), "C": 100 * capitals > 3 * F.length(text), "D": text.rlike("[#$%&*|]")}
    return {k: v.cast("int") for k, v in found.items()}


def failures(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Counts ``n`` of documents by part, flags A to E, and label (``good``, ``toxic``: 0 or 1), pre-aggregated by text.

    E: the text is that of a smaller id, table-wide. Texts meet as SHA-256 values. Copies are counted before they are
    dealt by text, so a group of copies of any size is a few rows when its least id is looked up. A row without an id has
    no smaller one, and none is smaller than it. Repeated rows are documents each and no copies of one another. A null text is
    empty, a null part the empty string; of several labels for an id the largest counts.
    """
    df = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    df = df.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    flags = text_flags(F.col("text"), F.col("words"))
    spread = F.when(F.col("id").isNull(), F.monotonically_increasing_id()).otherwise(-1)  # rows without an id don't meet in one task
    df = df.select("id", spread.alias("apart"), "part", F.unhex(F.sha2("text", 256)).alias("key"), *[v.alias(k) for k, v in flags.items()])
    marks = labels.groupBy(F.col(doc_id).alias("id")).agg(*[F.max((F.col(c) == 1).cast("int")).alias(m) for c, m in (("quality", "good"), ("toxic", "toxic"))])
    df = df.join(marks.withColumn("apart", F.lit(-1).cast("long")), ["id", "apart"], "left").na.fill(0, ["good", "toxic"])
    same = ["part", "key", *flags, "good", "toxic"]
    each = df.groupBy("id", "apart", *same).agg(F.count("*").alias("n"))
    named = F.col("id").isNotNull()
    texts = each.groupBy(*same).agg(F.sum("n").alias("n"), F.min(F.when(named, F.struct("id", "n"))).alias("first"), F.sum(F.when(named, 0).otherwise(F.col("n"))).alias("nameless"))
    least = F.min("first.id").over(Window.partitionBy("key"))  # a row for each part and label that the text has
    stays = F.col("nameless") + F.when(F.col("first.id") == least, F.col("first.n")).otherwise(0)
    both = F.explode(F.array(F.struct(F.lit(0).alias("E"), F.col("stays").alias("n")), F.struct(F.lit(1).alias("E"), (F.col("n") - F.col("stays")).alias("n"))))
    return texts.withColumn("stays", stays).withColumn("_x", both).select("part", *flags, "_x.E", "good", "toxic", "_x.n").filter("n > 0")


def audit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """For each part, each of the 120 orders of the filters A to E, and each step: the counts of ``report``, with good_lost
    and toxic_lost. An empty table gives no row; columns of other names are not looked at."""
    rows = failures(docs, labels, doc_id=doc_id, text=text, part=part)
    return report(joint_counts(rows, "ABCDE", {"n": "n", "good": "n * good", "toxic": "n * toxic"}, ["part"]), "ABCDE", ["part"], lost={"good_lost": "good", "toxic_lost": "toxic"})
