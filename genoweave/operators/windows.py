"""Grids, training windows and leak-free splits over chromosomes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.operators.intervals import overlap_bp

CHUNK, WINDOWS, BLOCK, VAL_CHROMS, TEST_SHARE, SEED, STRANDS, MAX_N = 65536, (8192, 65536, 1048576), 1048576, ("chr8", "chr9"), 0.1, 42, ("+", "-"), 0.5


def chunk_grid(sizes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(chrom, start, end) of the chunks that tile each chromosome of (chrom, len); the last may be short."""
    starts = sizes.filter("len > 0").select("chrom", "len", F.explode(F.sequence(F.lit(0).cast("long"), F.col("len") - 1, F.lit(chunk).cast("long"))).alias("start"))
    return starts.select("chrom", "start", F.least(F.col("start") + chunk, "len").alias("end"))


def window_starts(sizes: DataFrame, window: int) -> DataFrame:
    """(chrom, start, end) of aligned windows; the last is pulled back to the end, a short chromosome has one window."""
    last = F.greatest(F.col("len") - window, F.lit(0))
    starts = F.array_distinct(F.transform(F.sequence(F.lit(0).cast("long"), F.col("len") - 1, F.lit(window).cast("long")), lambda x: F.least(x, last)))
    df = sizes.filter("len > 0").select("chrom", "len", F.explode(starts).alias("start"))
    return df.select("chrom", "start", F.least(F.col("start") + window, "len").alias("end"))


def block_hash(seed: int, chrom: Column, block: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), chrom, F.lit(":"), block.cast("string")))


def assign_blocks(sizes: DataFrame, *, block: int = BLOCK, val: Sequence[str] = VAL_CHROMS, share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """(chrom, block, split): validation chromosomes whole; of the pool of all other blocks a seeded share tests.

    The share is rounded half to even. A chromosome has len // block + 1 blocks. The order is that of a hash of seed,
    chromosome and block, so it is the same everywhere.
    """
    blocks = sizes.select("chrom", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("len") / block))).alias("block"))
    held = F.col("chrom").isin(*val)
    pool = Window.partitionBy(held)  # thousands of blocks even for a large genome
    rank = F.row_number().over(pool.orderBy(block_hash(seed, F.col("chrom"), F.col("block"))))
    tests = F.bround(F.count("*").over(pool) * F.lit(share), 0)
    return blocks.select("chrom", "block", F.when(held, "val").when(rank <= tests, "test").otherwise("train").alias("split"))


def label_windows(windows: DataFrame, blocks: DataFrame, block: int = BLOCK) -> DataFrame:
    """Adds each window's split, that of the block in which its middle lies (the chromosome's last block at most)."""
    last = blocks.groupBy("chrom").agg(F.max("block").alias("_last"))
    at = F.least(F.floor(F.floor((F.col("start") + F.col("end")) / 2) / block), F.col("_last"))
    return windows.join(last, "chrom").withColumn("block", at).join(blocks, ["chrom", "block"]).drop("_last", "block")


def measured(windows: DataFrame, n_runs: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Windows with the positions that N runs and the blacklist cover (both disjoint)."""
    return overlap_bp(overlap_bp(windows, n_runs, out="n_bp"), blacklist, out="blacklist_bp")


def _dropped(max_n: float) -> tuple[Column, Column]:
    by_n = F.col("n_bp") > (F.col("end") - F.col("start")) * max_n
    return by_n, ~by_n & (F.col("blacklist_bp") > 0)


def kept_windows(measured_windows: DataFrame, max_n: float = MAX_N) -> DataFrame:
    """Windows that aren't mostly N and don't touch the blacklist."""
    by_n, by_list = _dropped(max_n)
    return measured_windows.filter(~by_n & ~by_list).drop("n_bp", "blacklist_bp")


def window_stats(measured_windows: DataFrame, max_n: float = MAX_N) -> DataFrame:
    """Windows, kept, dropped for N, and dropped for the blacklist alone."""
    by_n, by_list = _dropped(max_n)
    return measured_windows.agg(F.count("*").alias("windows"), F.count_if(~by_n & ~by_list).alias("kept"), F.count_if(by_n).alias("dropped_n"), F.count_if(by_list).alias("dropped_blacklist"))


def materialised(windows: DataFrame, tissues: DataFrame, strands: Sequence[str] = STRANDS) -> DataFrame:
    """Each window on each strand for each tissue. Both factors are small vocabularies, so a literal array is exploded."""
    names = sorted(r[0] for r in tissues.select("tissue").distinct().collect())  # tens of tissues
    pair = F.array(*[F.struct(F.lit(s).alias("strand"), F.lit(t).alias("tissue")) for s in strands for t in names]) if names else F.array().cast("array<struct<strand:string,tissue:string>>")
    return windows.withColumn("_p", F.explode(pair)).select(*windows.columns, "_p.strand", "_p.tissue")


def split_counts(windows: DataFrame) -> DataFrame:
    """Windows of each split, zero-filled, in one row."""
    return windows.agg(*[F.count_if(F.col("split") == s).alias(s) for s in ("train", "val", "test")])


def build_windows(sizes: DataFrame, n_runs: DataFrame, blacklist: DataFrame, tissues: DataFrame, window: int, *, block: int = BLOCK, val: Sequence[str] = VAL_CHROMS, share: float = TEST_SHARE, seed: int = SEED, max_n: float = MAX_N) -> DataFrame:
    """(chrom, start, end, strand, tissue, split) of all windows kept."""
    kept = kept_windows(measured(window_starts(sizes, window), n_runs, blacklist), max_n)
    return materialised(label_windows(kept, assign_blocks(sizes, block=block, val=val, share=share, seed=seed), block), tissues).select("chrom", "start", "end", "strand", "tissue", "split")


def split_clashes(windows: DataFrame) -> DataFrame:
    """Loci that lie in more than one split; there must be none."""
    return windows.groupBy("chrom", "start").agg(F.countDistinct("split").alias("n_splits")).filter("n_splits > 1")
