"""Moves a legacy tree, with codes for names, into a release: a plan as a table, checked by queries, carried out by tasks.

The tree is listed, never read. Codes of classes and tissues become names by a join; what the rules don't know stays where it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.functions.names import check_release_id, signal_file_parts, slugify
from genoweave.plans.release import Release
from genoweave.sources import readers
from genoweave.sources.files import filesystem, listing

#: Names of window files, and of other files that an index keeps.
INTERVAL_FILE = r"^(full|train|test)_intervals(_\d+)?(_ALL|_subset)?\.pkl$"
INDEX_FILES = ("all_intervals.pkl", "omics_pairs.npz", "track_weights.npz")


def plan(spark: SparkSession, legacy: str, target: str, org: str, release: str, codes: DataFrame) -> DataFrame:
    """(kind, threshold, old, new): where each file of the tree goes; new is null for one that stays.

    ``codes`` are (kind, name, code) of ``vocab.class_codes``; unknown codes stay as they are. A release that exists, signal
    files of several thresholds, and two files that would share a name are refused.
    """
    check_release_id(release)
    folder = f"{target.rstrip('/')}/{org}/{release}"
    if readers._exists(spark, folder):
        raise FileExistsError(f"{folder} exists")
    rel = F.regexp_extract("path", re.escape(legacy.rstrip("/")).replace("\\-", "-") + "/(.*)$", 1)
    df = listing(spark, legacy).select(F.col("path").alias("old"), rel.alias("rel")).withColumn("p", F.split("rel", "/"))
    part = lambda i: F.get("p", F.lit(i))
    of = lambda kind: codes.filter(F.col("kind") == kind).groupBy("code").agg(F.min("name").alias("name"))
    top, second, leaf = part(0), part(1), F.element_at("p", -1)
    signal = (top == "OMICS") & (F.size("p") == 4)
    df = df.withColumns({"cls": F.when(signal, second), "tis": F.when(signal, part(2)).when((top == "Subtables") & (second == "omics") & (F.size("p") > 3), part(2))})
    for column, kind in (("cls", "antigen"), ("tis", "tissue")):
        df = df.join(of(kind).withColumnsRenamed({"code": column, "name": f"{column}_name"}), column, "left").withColumn(column, F.coalesce(f"{column}_name", column))
    f = signal_file_parts(leaf)
    rest = lambda n: F.array_join(F.slice("p", n + 1, F.size("p")), "/")
    rules = [
        ("signal", signal & f.isNotNull(), F.concat_ws("/", F.lit("signal"), slugify(F.col("cls")), slugify(F.col("tis")), F.concat(slugify(f["antigen"]), F.lit(".bed")))),
        ("genome", (top == "DNA") & (F.size("p") == 2) & second.isin(f"{org}.fa", f"{org}-blacklist.v2.bed"), F.concat(F.lit("genome/"), second)),
        ("genome", (top == "SupportFiles") & (second == f"{org}_DNA_seq.pkl"), F.concat(F.lit("genome/"), second)),
        ("dna", top == "DNA", F.concat(F.lit("dna/"), rest(1))),
        ("dna", (top == "Subtables") & (second == "dna"), F.concat(F.lit("dna/"), rest(2))),
        ("chunks", (top == "Subtables") & (second == "omics") & (F.size("p") > 3), F.concat_ws("/", F.lit("chunks/omics"), slugify(F.col("tis")), rest(3))),
        ("index", (top == "SupportFiles") & (leaf.rlike(INTERVAL_FILE) | leaf.isin(*INDEX_FILES)), F.concat(F.lit("index/"), leaf)),
    ]
    kind, new = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, fits, to in reversed(rules):
        kind, new = F.when(fits, name).otherwise(kind), F.when(fits, to).otherwise(new)
    df = df.select(kind.alias("kind"), F.when(signal, f["threshold"]).alias("threshold"), "old", F.when(new.isNotNull(), F.concat(F.lit(f"{folder}/"), new)).alias("new"))
    thresholds = sorted(r[0] for r in df.select("threshold").distinct().dropna().limit(3).collect())
    if len(thresholds) > 1:
        raise ValueError(f"files of several thresholds: {', '.join(thresholds)}")
    clash = df.filter("new IS NOT NULL").groupBy("new").agg(F.count("*").alias("n")).filter("n > 1").first()
    if clash:
        raise ValueError(f"two files would share a name: {clash.new}")
    return df


def execute(moves: DataFrame) -> int:
    """Renames all files of a plan, by tasks, and says how many. A task that runs again passes over what is done.

    Trees on two file systems are refused, as each rename would be a copy.
    """

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for old, new in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                (a, source), (c, goal) = filesystem(old), filesystem(new)
                if not a.equals(c):
                    raise OSError("source and target lie on different file systems")
                gone = a.get_file_info(source).type == pa.fs.FileType.NotFound
                if gone and c.get_file_info(goal).type != pa.fs.FileType.NotFound:
                    continue
                c.create_dir(goal.rpartition("/")[0], recursive=True)
                c.move(source, goal)
            yield pa.RecordBatch.from_arrays([pa.array([len(b)], pa.int64())], names=["n"])

    wanted = moves.filter("new IS NOT NULL").select("old", "new")
    return wanted.repartition(wanted.sparkSession.sparkContext.defaultParallelism).mapInArrow(move, "n long").agg(F.sum("n")).first()[0] or 0


def migrate(spark: SparkSession, legacy: str, target: str, org: str, release: str, codes: DataFrame) -> Release:
    """Plans and moves, and makes a release of what came of it, with chromosome sizes from the names of its sequence chunks."""
    moves = plan(spark, legacy, target, org, release, codes).persist()
    threshold = moves.agg(F.max("threshold")).first()[0]
    n = execute(moves)
    left = moves.filter("new IS NULL").count()
    moves.unpersist()
    made = Release.create(spark, target, org, release, source_threshold=threshold)
    sizes = readers.sizes_from_names(spark, f"{made.folder}/dna") if readers._exists(spark, f"{made.folder}/dna") else None
    made.manifest["chrom_sizes"] = {r.chrom: r.len for r in sizes.orderBy("chrom").collect()} if sizes is not None else {}  # a row for each chromosome
    made.record("migrate", moved=n, left=left)
    return made
