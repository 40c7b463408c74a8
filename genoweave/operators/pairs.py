"""Similar windows: profiles of tracks, inverse-frequency weights, weighted Jaccard neighbours.

Neighbours come from a prefix-filtered self-join: each profile's tracks are ordered by falling weight, and only those
before the rest weighs less than the threshold of the whole are joined, so tracks that most windows have, whose
pairs would grow with the square, hardly ever take part. Candidates are then measured exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genoweave.functions.names import log_weight
from genoweave.operators.intervals import tiles

#: Shares of a window's tracks of one weight that are dealt apart.
SHARES = 64
MIN_P, MIN_TRACKS, THRESHOLD, MAX_PAIRS, DISQUALIFY, SEPARATION, SEED = 1e-4, 2, 0.5, 64, 4096, 1_000_000, 0


def window_ids(windows: DataFrame) -> DataFrame:
    """(window_id, chrom, start, end, split) of distinct loci, numbered from 0 in order of chrom and start.

    Numbers are counted for each chromosome and shifted by those ahead, so no task sees more than one chromosome.
    """
    loci = windows.groupBy("chrom", "start").agg(F.min("end").alias("end"), F.min("split").alias("split"))
    ahead = loci.groupBy("chrom").agg(F.count("*").alias("_n"))
    ahead = ahead.select("chrom", (F.sum("_n").over(Window.orderBy("chrom").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_base"))
    rank = F.row_number().over(Window.partitionBy("chrom").orderBy("start")) - 1
    return loci.withColumn("_r", rank).join(ahead, "chrom").select((F.col("_base") + F.col("_r")).cast("long").alias("window_id"), "chrom", "start", "end", "split")


def profiles(ids: DataFrame, runs: DataFrame, *, track: str = "feature", tile: int = 8192) -> DataFrame:
    """Distinct (window_id, track) where a run of any tissue overlaps the window, whichever windows were kept.

    Runs meet the windows of their tile where they lie; each task drops its repeats, so a track that many tissues have at a place
    leaves it once, and pairs alone are dealt. ``ids`` should be a stored table: where Spark knows that windows are few, it deals no
    run by tile, and few tiles would be few tasks.
    """
    left = tiles(ids, tile).select("window_id", "chrom", "tile", F.col("start").alias("_s"), F.col("end").alias("_e"))
    right = tiles(runs.select("chrom", "start", "end", F.col(track).alias("track")), tile).select("chrom", "tile", "track", F.col("start").alias("_rs"), F.col("end").alias("_re"))
    return left.join(right, ["chrom", "tile"]).filter("_re > _s AND _rs < _e").select("window_id", "track").distinct()


def idf_weights(profile: DataFrame, ids: DataFrame, tracks: DataFrame | None = None, min_p: float = MIN_P) -> DataFrame:
    """(track, p, weight) from training windows; of ``tracks``, one that none has gets the largest weight.

    Without ``tracks`` only those that a training window has get one. That is all that pairs need, and costs no scan of all runs for their names.
    """
    train = ids.filter("split = 'train'")
    hits = profile.join(train.select("window_id"), "window_id", "left_semi").groupBy("track").agg(F.count("*").alias("_n"))
    total = train.agg(F.count("*").alias("_all"))
    df = (hits if tracks is None else tracks.join(hits, "track", "left")).crossJoin(F.broadcast(total))  # one row
    share = F.when(F.col("_all") > 0, F.coalesce("_n", F.lit(0)) / F.col("_all")).otherwise(0.0)
    return df.select("track", share.alias("p"), log_weight(share, min_p).alias("weight"))


def _ranked(held: DataFrame, shares: int = SHARES) -> DataFrame:
    """Adds to rows (window_id, track, weight, ...) their window's rows ``_n`` and weight ``size``, and the weight ``_ahead`` of the tracks before.

    Tracks are ordered by falling weight, then by a share that their hash gives, then by name. Within tracks of one weight and share a row's
    number says what lies ahead, to which come the sums of whole shares, a row each; so no task sorts or holds all tracks of a window.
    """
    at = ["window_id", "weight", "_share"]
    held = held.withColumn("_share", F.pmod(F.hash("track"), F.lit(shares)))
    per = Window.partitionBy("window_id")
    sums = held.groupBy(*at).agg(F.count("*").alias("_rows"))
    whole = F.col("_rows") * F.col("weight")
    before = F.sum(whole).over(per.orderBy(F.desc("weight"), "_share").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(*at, F.sum("_rows").over(per).alias("_n"), F.sum(whole).over(per).alias("size"), F.coalesce(before, F.lit(0.0)).alias("_at"))
    nth = F.row_number().over(Window.partitionBy(*at).orderBy("track")) - 1
    return held.withColumn("_nth", nth).join(sums, at).withColumn("_ahead", F.col("_at") + F.col("_nth") * F.col("weight")).drop("_share", "_nth", "_at")


def similar_pairs(
    profile: DataFrame, ids: DataFrame, weights: DataFrame, *, threshold: float = THRESHOLD, max_pairs: int = MAX_PAIRS, min_tracks: int = MIN_TRACKS, disqualify_above: int = DISQUALIFY, min_separation: int = SEPARATION, seed: int = SEED
) -> DataFrame:
    """(src, dst, score, rank): for each eligible training window its most similar ones of at least the threshold.

    Eligible are training windows with enough tracks. Windows of one chromosome whose starts are no further apart than the
    separation don't pair. A window with more than ``disqualify_above`` partners is too generic to be a source but
    stays a neighbour. Ties go by a seeded hash. Tracks of weight 0 count for eligibility alone.
    """
    train = ids.filter("split = 'train'").select("window_id", "chrom", "start")
    held = profile.join(train, "window_id").join(weights.select("track", "weight"), "track")
    held = _ranked(held).filter((F.col("_n") >= min_tracks) & (F.col("size") > 0) & (F.col("weight") > 0))
    # what weighs from here on reaches the threshold; a hair less, for sums that differ in the last bit
    keys = held.filter(F.col("size") - F.col("_ahead") >= F.col("size") * threshold * (1 - 1e-9)).select("window_id", "chrom", "start", "size", "track")
    side = lambda df, x: df.select(*[F.col(c).alias(f"{x}_{c}" if c != "track" else c) for c in df.columns])
    apart = (F.col("a_chrom") != F.col("b_chrom")) | (F.abs(F.col("a_start") - F.col("b_start")) > min_separation)
    near_size = (F.col("a_size") >= F.col("b_size") * threshold * (1 - 1e-9)) & (F.col("b_size") >= F.col("a_size") * threshold * (1 - 1e-9))
    met = side(keys, "a").join(side(keys, "b"), "track").filter((F.col("a_window_id") < F.col("b_window_id")) & apart & near_size)
    met = met.select(F.col("a_window_id").alias("a"), F.col("b_window_id").alias("b")).distinct()
    one = met.join(held.select(F.col("window_id").alias("a"), F.col("size").alias("sa"), "track", "weight"), "a")
    both = one.join(held.select(F.col("window_id").alias("b"), F.col("size").alias("sb"), "track"), ["b", "track"]).groupBy("a", "b", "sa", "sb").agg(F.sum("weight").alias("i"))
    scored = both.select("a", "b", F.round(F.col("i") / (F.col("sa") + F.col("sb") - F.col("i")), 6).alias("score")).filter(F.col("score") >= threshold)
    each = scored.select(F.col("a").alias("src"), F.col("b").alias("dst"), "score").union(scored.select("b", "a", "score"))
    per = Window.partitionBy("src")
    tie = F.md5(F.concat(F.lit(f"{seed}:"), F.col("src").cast("string"), F.lit(":"), F.col("dst").cast("string")))
    ranked = each.withColumn("_all", F.count("*").over(per)).filter(F.col("_all") <= disqualify_above).withColumn("rank", F.row_number().over(per.orderBy(F.desc("score"), tie)))
    return ranked.filter(F.col("rank") <= max_pairs).select("src", "dst", "score", "rank")


def pairs_csr(pairs: DataFrame) -> DataFrame:
    """(src, indices, scores): each source's neighbours by rank, at most ``max_pairs`` of them."""
    rows = F.array_sort(F.collect_list(F.struct("rank", "dst", "score")))
    return pairs.groupBy("src").agg(rows.alias("r")).select("src", F.col("r.dst").alias("indices"), F.col("r.score").alias("scores"))


def csr(pairs: DataFrame, sources: DataFrame | None = None, block: int = 65536) -> tuple[DataFrame, DataFrame]:
    """Compressed rows: indptr (row, window_id, begin, end) and values (position, window_id, score).

    Rows are numbered by source; all of ``sources`` (window_id) have one, even without neighbours (by default those that have
    some). A row's neighbours by rank lie at positions begin to end - 1. Numbers and positions are prefix sums within blocks
    of window ids, to which come those of whole blocks, a row each.
    """
    n = pairs.groupBy(F.col("src").alias("window_id")).agg(F.count("*").alias("n"))
    if sources is not None:
        n = sources.select("window_id").distinct().join(n, "window_id", "left").na.fill(0, ["n"])
    n = n.withColumn("_b", F.floor(F.col("window_id") / block))
    ahead = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    blocks = n.groupBy("_b").agg(F.count("*").alias("_rows"), F.sum("n").alias("_n"))
    blocks = blocks.select("_b", (F.sum("_rows").over(ahead) - F.col("_rows")).alias("_row0"), (F.sum("_n").over(ahead) - F.col("_n")).alias("_at0"))
    inside = Window.partitionBy("_b").orderBy("window_id")
    end = F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    rows = n.withColumns({"_row": F.row_number().over(inside) - 1, "_end": end}).join(blocks, "_b")
    indptr = rows.select((F.col("_row0") + F.col("_row")).alias("row"), "window_id", (F.col("_at0") + F.col("_end") - F.col("n")).alias("begin"), (F.col("_at0") + F.col("_end")).alias("end"))
    values = pairs.join(indptr.select(F.col("window_id").alias("src"), "begin"), "src").select((F.col("begin") + F.col("rank") - 1).alias("position"), F.col("dst").alias("window_id"), "score")
    return indptr, values


class PairIndex:
    """Reads a pair table: neighbours of a window, a window's interval, all sources."""

    def __init__(self, pairs: DataFrame, ids: DataFrame):
        self.pairs, self.ids = pairs, ids

    @classmethod
    def of_csr(cls, indptr: DataFrame, values: DataFrame, ids: DataFrame) -> PairIndex:
        """The same over compressed rows."""
        spans = indptr.filter(F.col("end") > F.col("begin")).select(F.col("window_id").alias("src"), F.explode(F.sequence("begin", F.col("end") - 1)).alias("position"), "begin")
        return cls(spans.join(values, "position").select("src", F.col("window_id").alias("dst"), "score", (F.col("position") - F.col("begin") + 1).cast("int").alias("rank")), ids)

    def neighbours(self, window_id: int) -> DataFrame:
        return self.pairs.filter(F.col("src") == window_id).select("dst", "score", "rank").orderBy("rank")

    def interval(self, window_id: int) -> DataFrame:
        return self.ids.filter(F.col("window_id") == window_id).select("chrom", "start", "end", "split")

    def sources(self) -> DataFrame:
        return self.pairs.select("src").distinct()
