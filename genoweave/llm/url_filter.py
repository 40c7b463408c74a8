"""URL filter: rules first, then a ratio of two character language models. DataFrame functions only, no Python on executors.

Both models are variable-order Markov models over a folded alphabet of 36 symbols with Witten-Bell smoothing: a context
of up to three symbols gives way to the next shorter one by the share of new symbols that followed it. One model is counted on
accepted URLs, the other on rejected ones; the rules say which is which. A URL's score is the mean, per symbol, of
the log-likelihood difference. It is rejected below a threshold that is calibrated on a tenth of the ruled URLs, by hash, which
the models don't count: where two normal laws with the classes' means and spreads cross in equal shares.

Counts and the models are tables of at most 36^4 windows of four symbols, whatever the number of URLs, so the final table
may be broadcast; each URL's symbols are summed where they were made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import stage

#: Symbols that stand for themselves; a digit counts as 0 and anything else as *. The context starts with ^.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0./-_?=&*^"
ORDER = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The standard rules: verdict, host and path. The longest that fits wins.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def parsed(urls: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; both empty for null and where there is no ``://``."""
    at = F.coalesce(F.locate("://", F.col(url)), F.lit(0))
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return urls.withColumn("host", F.translate(host, _UPPER, _LOWER)).withColumn("path", path)


def ruled(df: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``rule`` (host and path of the longest rule that fits, else null) and ``ruling`` (its verdict)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return df.withColumn("rule", rule).withColumn("ruling", verdict)


def symbols(url: Column) -> Column:
    """What the models read: the URL from its host on, folded to the alphabet."""
    text = F.translate(F.regexp_replace(F.coalesce(url, F.lit("")), r"^(?s).*?://", ""), _UPPER, _LOWER)
    return F.regexp_replace(F.regexp_replace(text, "[0-9]", "0"), r"[^a-z0./\-_?=&]", "*")


def windows(text: Column) -> Column:
    """Every symbol with the three before it."""
    padded = F.concat(F.lit("^" * (ORDER - 1)), text)
    return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(padded, i, F.lit(ORDER)))).otherwise(F.array().cast("array<string>"))


def model(samples: DataFrame, all_windows: DataFrame) -> DataFrame:
    """(window, gain) for all windows asked for: the log of accepted over rejected probability of the last symbol.

    ``samples`` has windows (``w``), ``accepted`` and how often (``n``). Probabilities are interpolated from the uniform one upwards.
    """
    of = lambda accepted: F.sum(F.when(F.col("accepted") == accepted, F.col("n")).otherwise(0))
    counts = samples.groupBy("w").agg(of(True).alias("n1"), of(False).alias("n0"))
    grams = None
    for k in range(1, ORDER + 1):  # a window's last k symbols
        at = counts.select(F.expr(f"right(w, {k})").alias("g"), "n1", "n0")
        at = at.groupBy("g").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).withColumn("c", F.expr(f"substring(g, 1, {k - 1})"))
        grams = at if grams is None else grams.union(at)
    grams = stage(grams.withColumn("k", F.length("g")), "grams")
    contexts = grams.groupBy("k", "c").agg(*[f(i) for i in (1, 0) for f in (lambda i: F.sum(f"n{i}").alias(f"t{i}"), lambda i: F.count_if(F.col(f"n{i}") > 0).alias(f"d{i}"))])
    df = all_windows
    p = {1: F.lit(1.0 / len(ALPHABET)), 0: F.lit(1.0 / len(ALPHABET))}
    for k in range(1, ORDER + 1):
        g = grams.filter(F.col("k") == k).select(F.col("g").alias(f"g{k}"), *[F.col(f"n{i}").alias(f"n{i}_{k}") for i in (1, 0)])
        c = contexts.filter(F.col("k") == k).select(F.col("c").alias(f"c{k}"), *[F.col(f"{x}{i}").alias(f"{x}{i}_{k}") for x in "td" for i in (1, 0)])
        df = df.withColumn(f"g{k}", F.expr(f"right(w, {k})")).withColumn(f"c{k}", F.expr(f"substring(right(w, {k}), 1, {k - 1})"))
        df = df.join(g, f"g{k}", "left").join(c, f"c{k}", "left").drop(f"g{k}", f"c{k}")
        for i in (1, 0):
            n, t, d = (F.coalesce(F.col(f"{x}{i}_{k}"), F.lit(0)) for x in "ntd")
            p[i] = F.when(t + d > 0, (n + d * p[i]) / (t + d)).otherwise(p[i])
        df = df.withColumns({f"p{i}": p[i] for i in (1, 0)}).select("w", "p1", "p0")
        p = {1: F.col("p1"), 0: F.col("p0")}
    return df.select("w", F.log(F.col("p1") / F.col("p0")).alias("gain"))


def judge(urls: DataFrame, *, url: str = "url", rules=RULES) -> DataFrame:
    """Adds host, path, rule, score (null for an empty URL) and verdict (allow or block) to all rows.

    A null or empty URL has no score and is allowed unless a rule says otherwise, as are all URLs if the rules accept or
    reject none to learn from. Repeated rows are judged alike; an empty table stays empty. Columns of the added names
    are replaced.
    """
    given = [c for c in urls.columns if c not in ("host", "path", "rule", "score", "verdict")]
    kept = [f"given{i}" for i in range(len(given))]  # so that no name can clash
    url = kept[given.index(url)]
    base = ruled(parsed(urls.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(given, kept, strict=True)]), url), rules)
    held = F.pmod(F.xxhash64(url), F.lit(10)) == 0
    each = base.select(F.explode(windows(symbols(F.col(url)))).alias("w"), "ruling", held.alias("held"))
    each = stage(each.groupBy("w", "ruling", "held").agg(F.count("*").alias("n")), "windows")
    seen = each.filter("ruling IS NOT NULL AND NOT held").select("w", (F.col("ruling") == "allow").alias("accepted"), "n")
    gains = stage(model(seen, each.select("w").distinct()), "gains")
    scored = base.withColumn("_id", F.monotonically_increasing_id()).withColumn("_held", held)
    sums = scored.select("*", F.explode_outer(windows(symbols(F.col(url)))).alias("w")).join(F.broadcast(gains), "w", "left")
    sums = sums.groupBy("_id").agg(*[F.first(c).alias(c) for c in [*kept, "host", "path", "rule", "ruling", "_held"]], F.avg("gain").alias("score"))
    sums = stage(sums, "scores")
    laws = sums.filter("_held AND ruling IS NOT NULL").groupBy("ruling").agg(F.avg("score").alias("m"), F.coalesce(F.stddev("score"), F.lit(0.0)).alias("s")).collect()  # two rows
    law = {r.ruling: (r.m, r.s + 1e-9) for r in laws if r.m is not None}
    (a, sa), (b, sb) = law.get("allow", (0.0, 1.0)), law.get("block", (0.0, 1.0))
    least = (a * sb + b * sa) / (sa + sb) if len(law) == 2 else float("-inf")
    verdict = F.coalesce("ruling", F.when(F.col("score") < least, "block").otherwise("allow"))
    return sums.select(*[F.col(k).alias(c) for c, k in zip(given, kept, strict=True)], "host", "path", "rule", "score", verdict.alias("verdict"))
