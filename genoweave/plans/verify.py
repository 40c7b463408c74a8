"""Checks of a release as queries; each gives the rows that break it, or counts of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genoweave.functions.names import slugify
from genoweave.operators.intervals import clipped, explode_to_chunks, min_over


def round_trip(peaks: DataFrame, runs: DataFrame, keys: Sequence[str], *, value: str = "score") -> DataFrame:
    """Peaks of each key, and those that the stored runs don't reach everywhere."""
    spans = peaks.groupBy(*keys, "start", "end", F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    held = min_over(spans, runs, keys)
    return held.groupBy(*keys).agg(F.sum("_n").alias("peaks"), F.sum(F.when(F.col("least") < F.col("_v"), F.col("_n")).otherwise(0)).alias("lost"))


def pan_dominance(runs: DataFrame, pan: DataFrame, by: Sequence[str]) -> DataFrame:
    """Runs of tissues, and those above the pan track at any of their positions."""
    keys = [*by, "chrom"]
    spans = runs.groupBy(*keys, "start", "end", F.col("value").alias("_v")).agg(F.count("*").alias("_n"))
    held = min_over(spans, pan, keys)
    return held.groupBy(*by).agg(F.sum("_n").alias("runs"), F.sum(F.when(F.col("least") < F.col("_v"), F.col("_n")).otherwise(0)).alias("above_pan"))


def disjoint(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Runs that begin before the one ahead of them ends, that are empty, or that aren't positive.

    Two runs that overlap share a tile, and some two neighbours in it overlap, so no more than a tile is sorted.
    """
    cut = clipped(runs.withColumns({"_start": F.col("start"), "_end": F.col("end")}), 65536)
    reach = F.lag("end").over(Window.partitionBy(*keys, "tile").orderBy("start", "end"))
    late = cut.withColumn("_reach", reach).filter(F.col("start") < F.col("_reach")).withColumns({"start": F.col("_start"), "end": F.col("_end")}).select(*runs.columns)
    return late.distinct().union(runs.filter((F.col("end") <= F.col("start")) | (F.col("value") <= 0)))


def missing_chunks(omics: DataFrame, grid: DataFrame, tissues: DataFrame, chunk: int) -> DataFrame:
    """Chunks of the grid without rows, for each tissue of a small vocabulary."""
    each = F.array(*[F.lit(r.tissue) for r in tissues.select("tissue").distinct().orderBy("tissue").collect()])  # tens of tissues
    wanted = grid.select(F.explode(each).alias("tissue"), "chrom", "start", "end", F.floor(F.col("start") / chunk).alias("chunk"))
    return wanted.join(omics.select("tissue", "chrom", "chunk").distinct(), ["tissue", "chrom", "chunk"], "left_anti").select("tissue", "chrom", "start", "end")


def misplaced_rows(omics: DataFrame, chunk: int) -> DataFrame:
    """Stored rows that don't touch the chunk they are in."""
    return omics.filter((F.col("Start") >= (F.col("chunk") + 1) * chunk) | (F.greatest(F.col("End"), F.col("Start") + 1) <= F.col("chunk") * chunk))


def rederived(omics: DataFrame, runs: DataFrame, chunk: int) -> DataFrame:
    """Rows that are stored and shouldn't be, or should be and aren't, as multisets; exhaustive, not sampled."""
    cols = ["tissue", "chrom", "chunk", "start", "end", "value", "feature"]
    stored = omics.select("tissue", "chrom", "chunk", F.col("Start").alias("start"), F.col("End").alias("end"), F.col("Name").alias("value"), F.col("feature_name").alias("feature"))
    wanted = explode_to_chunks(runs, chunk).select(*cols).withColumn("value", F.col("value").cast("int"))
    return stored.exceptAll(wanted).withColumn("fault", F.lit("extra")).union(wanted.exceptAll(stored).withColumn("fault", F.lit("missing")))


def footer_faults(footers: DataFrame, expected: DataFrame, chunk: int) -> DataFrame:
    """(tissue, chrom, chunk, fault) of the exact layout, from footers alone, against ``expected`` (tissue, chrom, chunk; a null
    chunk asks for a file only).

    A file has one row group for each chunk that it lists; each is confined to its chunk; no chunk is listed twice; every
    expected chunk is listed, and none else; every expected chromosome has a file.
    """
    null = F.lit(None).cast("long")
    uneven = footers.filter(F.size("listed") != F.size("groups")).select("tissue", "chrom", null.alias("chunk"), F.lit("row groups differ from the footer's list").alias("fault"))
    each = footers.select("tissue", "chrom", F.explode(F.arrays_zip("listed", "groups")).alias("g")).select("tissue", "chrom", F.col("g.listed").alias("chunk"), "g.groups.*")
    inside = (F.col("first_chunk") == F.col("chunk")) & (F.col("last_chunk") == F.col("chunk")) & (F.col("most_end") > F.col("chunk") * chunk) & (F.col("least_start") < (F.col("chunk") + 1) * chunk)
    strays = each.filter(~F.coalesce(inside | (F.col("least_start") == F.col("chunk") * chunk), F.lit(False))).select("tissue", "chrom", "chunk", F.lit("rows outside the chunk").alias("fault"))
    listed = footers.select("tissue", "chrom", F.explode("listed").alias("chunk"))
    twice = listed.groupBy("tissue", "chrom", "chunk").agg(F.count("*").alias("_n")).filter("_n > 1").select("tissue", "chrom", "chunk", F.lit("listed twice").alias("fault"))
    keys = ["tissue", "chrom", "chunk"]
    wanted = expected.select(*keys).filter("chunk IS NOT NULL").distinct()
    missing = wanted.join(listed, keys, "left_anti").withColumn("fault", F.lit("missing chunk"))
    extra = listed.distinct().join(wanted, keys, "left_anti").withColumn("fault", F.lit("chunk that no run touches"))
    unwritten = expected.select("tissue", "chrom").distinct().join(footers.select("tissue", "chrom"), ["tissue", "chrom"], "left_anti").select("tissue", "chrom", null.alias("chunk"), F.lit("missing file").alias("fault"))
    return uneven.union(strays).union(twice).union(missing).union(extra).union(unwritten)


def unbacked_vocabulary(pairs: DataFrame, omics: DataFrame) -> DataFrame:
    """(tissue, antigen) of the vocabulary without a stored row."""
    return pairs.join(omics.select("tissue", F.col("feature_name").alias("antigen")).distinct(), ["tissue", "antigen"], "left_anti")


def missing_omics(omics: DataFrame, runs: DataFrame) -> DataFrame:
    """(tissue, chrom) with runs and without a stored row. Chunks and chromosomes that no run touches may be empty."""
    return runs.select("tissue", "chrom").distinct().join(omics.select("tissue", "chrom").distinct(), ["tissue", "chrom"], "left_anti")


def unreachable_features(pairs: DataFrame, files: DataFrame) -> DataFrame:
    """(tissue, antigen) that no file's stem (tissue, stem) reaches by slug."""
    return pairs.withColumn("stem", slugify(F.col("antigen"))).join(files.select("tissue", "stem"), ["tissue", "stem"], "left_anti").drop("stem")


def dna_faults(chunks: DataFrame, grid: DataFrame) -> DataFrame:
    """Grid chunks whose sequence is missing or has another length."""
    have = chunks.select("chrom", "start", F.length("dna").alias("have"))
    return grid.join(have, ["chrom", "start"], "left").filter(F.col("have").isNull() | (F.col("have") != F.col("end") - F.col("start")))


def window_faults(windows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Windows that are empty or leave their chromosome."""
    return windows.join(sizes, "chrom", "left").filter(F.col("len").isNull() | (F.col("start") < 0) | (F.col("end") > F.col("len")) | (F.col("end") <= F.col("start"))).select(*windows.columns)


def report(checks: dict[str, DataFrame]) -> list[tuple[str, int, bool]]:
    """(check, faults, ok) of checks that give faulty rows; all run, whatever the first ones find."""
    return [(name, n, n == 0) for name, df in checks.items() for n in [df.count()]]
