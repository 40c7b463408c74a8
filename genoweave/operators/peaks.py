"""Peaks and experiments: groups, accession lookup, resolution of peaks, conservation counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genoweave.functions.names import group_path, normalise
from genoweave.operators.intervals import max_runs

GROUP_BY = ("ag_class", "antigen", "ct_class")


def experiments_of(experiments: DataFrame, org: str, group_by: Sequence[str] = GROUP_BY) -> DataFrame:
    """An assembly's experiments with normalised group fields; an assembly without any is an error."""
    df = experiments.filter(F.col("org") == org).withColumns({c: normalise(F.col(c)) for c in group_by})
    if df.isEmpty():
        raise ValueError(f"no experiment of {org}")
    return df


def group_table(experiments: DataFrame, group_by: Sequence[str] = GROUP_BY) -> DataFrame:
    """group_id (0-based, in the order of the fields), the fields, n_experiments (repeated accessions count) and path."""
    path_order = [c for c in group_by if c != "antigen"] + [c for c in group_by if c == "antigen"]
    df = experiments.groupBy("org", *group_by).agg(F.count("*").alias("n_experiments"))
    # one row for each group here
    df = df.withColumn("group_id", (F.row_number().over(Window.partitionBy("org").orderBy(*group_by)) - 1).cast("int"))
    return df.withColumn("path", group_path(F.col("org"), *[F.col(c) for c in path_order])).select("group_id", *group_by, "n_experiments", "path")


def path_collisions(groups: DataFrame) -> DataFrame:
    """Paths that more than one group would write; publishing refuses them."""
    return groups.groupBy("path").agg(F.count("*").alias("n_groups"), F.sort_array(F.collect_list("group_id")).alias("group_ids")).filter("n_groups > 1")


def accession_lookup(experiments: DataFrame, groups: DataFrame, group_by: Sequence[str] = GROUP_BY, line: str = "line_no") -> DataFrame:
    """(srx, group_id): of an accession's rows the first counts."""
    first = Window.partitionBy("srx").orderBy(line)
    once = experiments.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    return once.join(groups.select("group_id", *group_by), list(group_by)).select("srx", "group_id")


def resolve(peaks: DataFrame, lookup: DataFrame) -> DataFrame:
    """Peaks with the group of their accession, null if it has none. Spark broadcasts the lookup if its size allows."""
    return peaks.join(lookup, "srx", "left")


def resolve_fields(peaks: DataFrame, experiments: DataFrame, fields: Sequence[str] = GROUP_BY) -> DataFrame:
    """Mapped peaks with fields of their experiment."""
    return peaks.join(experiments.select("srx", *fields), "srx")


def conservation(resolved: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """rows_in, unmapped and rows_out (their difference), and the share unmapped in per cent, for each key."""
    counts = resolved.groupBy(*keys).agg(F.count("*").alias("rows_in"), F.count_if(F.col("group_id").isNull()).alias("unmapped"))
    return counts.withColumns({"rows_out": F.col("rows_in") - F.col("unmapped"), "unmapped_pct": F.round(100.0 * F.col("unmapped") / F.col("rows_in"), 6)})


def group_summary(resolved: DataFrame) -> DataFrame:
    """Peaks, accessions, covered extent and score range of each group."""
    mapped = resolved.filter("group_id IS NOT NULL")
    return mapped.groupBy("group_id").agg(
        F.count("*").alias("n_peaks"), F.countDistinct("srx").alias("n_accessions"), F.min("start").alias("first_start"), F.max("end").alias("last_end"), F.min("score").alias("min_score"), F.max("score").alias("max_score")
    )


def tracks(resolved: DataFrame, keys: Sequence[str], **how) -> DataFrame:
    """The maximum-score runs of each group's peaks on each chromosome."""
    return max_runs(resolved, [*keys, "chrom"], value="score", **how)


def pan_tissue(runs: DataFrame, *, tissue: str = "ct_class", pan: str = "All cell types", chroms: DataFrame | None = None, **how) -> DataFrame:
    """The maximum over all tissues but the pan one, for each class and antigen; on the given chromosomes only."""
    runs = runs.filter(F.col(tissue) != pan)
    if chroms is not None:
        runs = runs.join(chroms.select("chrom"), "chrom", "left_semi")
    return max_runs(runs, ["ag_class", "antigen", "chrom"], **how).withColumn(tissue, F.lit(pan))
