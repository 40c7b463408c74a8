"""Tissue and feature vocabularies: threshold fixed point, freezing, aliases, availability, class codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genoweave.functions.names import canonical, slugify
from genoweave.session import checkpointed

MIN_ANTIGENS, MIN_TISSUES = 50, 3
#: What never enters the vocabulary, and the tissue of all tissues.
EXCLUDED_ANTIGENS, EXCLUDED_CLASSES, PAN = ("Epitope_tags",), ("Input control", "Annotation tracks"), "All cell types"


def candidate_pairs(groups: DataFrame) -> DataFrame:
    """Distinct (tissue, antigen) of groups that may enter the vocabulary; a blank class is an error."""
    blank = groups.filter(F.col("ag_class").isNull() | (F.trim("ag_class") == "")).limit(1)
    if not blank.isEmpty():
        raise ValueError("a group has a blank class")
    kept = groups.filter(~F.col("ag_class").isin(*EXCLUDED_CLASSES) & ~F.col("antigen").isin(*EXCLUDED_ANTIGENS))
    return kept.select(F.col("ct_class").alias("tissue"), "antigen").distinct()


def select(pairs: DataFrame, min_antigens: int = MIN_ANTIGENS, min_tissues: int = MIN_TISSUES) -> tuple[DataFrame, int]:
    """The largest set of pairs where every tissue has enough antigens and every antigen enough tissues; and the rounds.

    Each round keeps tissues first, then antigens of what is left, until a round changes nothing. The vocabulary is
    small (thousands of pairs), so each round is checkpointed in the shared folder.
    """
    kept = checkpointed(pairs.distinct())
    count, rounds = kept.count(), 0
    while True:
        rounds += 1
        for key, least in (("tissue", min_antigens), ("antigen", min_tissues)):
            n = F.count("*").over(Window.partitionBy(key))
            kept = kept.withColumn("_n", n).filter(F.col("_n") >= least).drop("_n")
        kept = checkpointed(kept)
        now = kept.count()
        if now == count:
            return kept, rounds
        count = now


def with_pan(pairs: DataFrame, pan: str = PAN) -> DataFrame:
    """The pairs, and every antigen for the tissue of all tissues."""
    return pairs.union(pairs.select(F.lit(pan).alias("tissue"), "antigen")).distinct()


def resolve_aliases(frozen: DataFrame, present: DataFrame) -> DataFrame:
    """(name, alias, n) of frozen names that the data spell otherwise; alias is null if several spellings agree (n > 1).

    Names that are present as they are need no alias; ``frozen`` has ``name``, ``present`` has ``antigen``.
    """
    spelled = present.select("antigen").distinct()
    missing = frozen.select("name").join(spelled, F.col("name") == F.col("antigen"), "left_anti").withColumn("_c", canonical(F.col("name")))
    found = missing.join(spelled.withColumn("_c", canonical(F.col("antigen"))), "_c").groupBy("name").agg(F.count("*").alias("n"), F.min("antigen").alias("alias"))
    return found.select("name", F.when(F.col("n") == 1, F.col("alias")).alias("alias"), "n")


def apply_freeze(pairs: DataFrame, frozen: DataFrame, aliases: DataFrame, min_antigens: int = MIN_ANTIGENS) -> dict[str, DataFrame]:
    """A frozen feature list (idx, name) applied to new data.

    ``availability`` (tissue, idx, name) of tissues with enough frozen features, ``thin`` tissues with fewer, ``vanished``
    names that no pair has, in frozen order, ``appeared`` antigens that aren't frozen, sorted. The threshold of tissues
    for an antigen isn't applied again.
    """
    names = frozen.join(aliases.filter("alias IS NOT NULL").select("name", "alias"), "name", "left").select("idx", "name", F.coalesce("alias", "name").alias("antigen"))
    available = pairs.join(names, "antigen").select("tissue", "idx", "name").distinct()
    counted = available.withColumn("n_features", F.count("*").over(Window.partitionBy("tissue")))
    return {
        "availability": counted.filter(F.col("n_features") >= min_antigens).drop("n_features"),
        "thin": pairs.select("tissue").distinct().join(counted.groupBy("tissue").agg(F.first("n_features").alias("n_features")), "tissue", "left").na.fill(0, ["n_features"]).filter(F.col("n_features") < min_antigens),
        "vanished": names.join(pairs.select("antigen").distinct(), "antigen", "left_anti").select("idx", "name").orderBy("idx"),
        "appeared": pairs.select("antigen").distinct().join(names.select("antigen"), "antigen", "left_anti").orderBy("antigen"),
    }


def features(pairs: DataFrame) -> DataFrame:
    """(idx, name): features in name order, 0-based. One row for each antigen."""
    return pairs.select(F.col("antigen").alias("name")).distinct().withColumn("idx", (F.row_number().over(Window.orderBy("name")) - 1).cast("int"))


def tissue_table(pairs: DataFrame, codes: DataFrame) -> DataFrame:
    """(tissue, code, n_features); a class without a code keeps its own name."""
    counted = pairs.groupBy("tissue").agg(F.countDistinct("antigen").alias("n_features"))
    return counted.join(codes.select(F.col("name").alias("tissue"), "code"), "tissue", "left").select("tissue", F.coalesce("code", "tissue").alias("code"), "n_features")


def availability_map(pairs: DataFrame) -> DataFrame:
    """(tissue, features): the sorted features of each tissue as an array."""
    return pairs.groupBy("tissue").agg(F.sort_array(F.collect_set("antigen")).alias("features"))


def class_codes(lines: DataFrame, line: str = "line_no", value: str = "value") -> DataFrame:
    """(kind, name, code) from a file list: three-letter codes of antigen and cell type classes, the first for a name.

    A line's first field reads ``ag.ct.threshold.AllAg.AllCell``; fields 3 and 5 are the classes' names.
    """
    f = F.split(value, "\t", 6)
    parts = F.split(f[0], r"\.")
    df = lines.filter(F.size(f) >= 5).filter((F.size(parts) >= 5) & (parts[3] == "AllAg") & (parts[4] == "AllCell"))
    both = df.select(line, F.explode(F.array(F.struct(F.lit("antigen").alias("kind"), f[2].alias("name"), parts[0].alias("code")), F.struct(F.lit("tissue").alias("kind"), f[4].alias("name"), parts[1].alias("code")))).alias("c"))
    return both.select(line, "c.*").groupBy("kind", "name").agg(F.min_by("code", line).alias("code"))


def signal_files(catalog: DataFrame, names: DataFrame, tissues: DataFrame | None = None) -> DataFrame:
    """Joins vocabulary names (name, alias) with catalog files (stem, ag_class, path, with ``tissues`` tissue too) by slug, as neither
    spelling of a name need survive as a file's; of several classes the first counts.

    With ``tissues`` (tissue) the folders' tissues are matched by slug too, and each tissue has its own files. Two names, or
    two tissues, with one slug are an error: a track would be filed under the wrong one.
    """
    slugs = names.select("name", F.explode(F.array("name", F.coalesce("alias", "name"))).alias("_n")).select("name", slugify(F.col("_n")).alias("slug")).distinct()
    _refuse_shared(slugs, "name")
    files = catalog.withColumn("slug", slugify(F.col("stem")))
    keys = []
    if tissues is not None:
        places = tissues.select("tissue").distinct().withColumn("_place", slugify(F.col("tissue")))
        _refuse_shared(places.withColumnRenamed("_place", "slug"), "tissue")
        files, keys = files.withColumn("_place", slugify(F.col("tissue"))).drop("tissue").join(places, "_place"), ["tissue"]
    files = files.groupBy(*keys, "slug").agg(F.min_by("path", F.struct("ag_class", "path")).alias("path"), F.min("ag_class").alias("ag_class"))
    found = slugs.join(files, "slug").groupBy(*keys, "name")
    return found.agg(F.min_by("path", F.struct("ag_class", "slug")).alias("path"), F.min("ag_class").alias("ag_class"))


def _refuse_shared(slugs: DataFrame, column: str) -> None:
    clash = slugs.groupBy("slug").agg(F.sort_array(F.collect_set(column)).alias("n")).filter(F.size("n") > 1).first()
    if clash:
        raise ValueError(f"{column}s share a slug: {', '.join(clash.n)} are all {clash.slug}")


def rename_codes(df: DataFrame, codes: DataFrame, column: str, kind: str) -> DataFrame:
    """Codes in a column become class names; unknown ones stay."""
    known = codes.filter(F.col("kind") == kind).groupBy("code").agg(F.min("name").alias("_name"))
    return df.join(known.withColumnRenamed("code", column), column, "left").withColumn(column, F.coalesce("_name", column)).select(*df.columns)


def ordered(names: Sequence[str]) -> list[tuple[int, str]]:
    """A feature list as rows (idx, name)."""
    return list(enumerate(names))
