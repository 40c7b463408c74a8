"""Queries of what a release stores and checks: vocabularies, codes, compressed pairs, and faults planted for the checks to find."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.fixtures import CHUNK, Tables
from genoweave.operators import intervals, omics, pairs, vocab, windows
from genoweave.plans import verify
from genoweave.queries import ALL_WINDOWS, BASES, CANDIDATES, CHROM_RUNS, CHUNKED, IDS, JACCARD, MAPPED, PIECES, PROFILE, RUNS, WEIGHTS, _candidates, _fasta, _labelled, _named, _omics, _pairs, _profile, _runs, query
from genoweave.session import checkpointed, scratch
from genoweave.sources import readers, sinks


@query("SELECT 'antigen' AS kind, ag_class AS name, arg_min(substr(md5(srx), 1, 3), line_no) AS code FROM experiments GROUP BY ag_class UNION ALL SELECT 'tissue', ct_class, arg_min(substr(md5(srx), 4, 3), line_no) FROM experiments GROUP BY ct_class", "experiments")
def class_codes(t: Tables) -> DataFrame:
    """A list of files, each line with other codes for its classes: a name's first line counts."""
    path, x = scratch(t.spark, "file-list"), t.experiments()
    of = lambda at: F.substring(F.md5("srx"), at, 3)
    whole = F.concat_ws("\t", F.concat_ws(".", of(1), of(4), F.lit("05"), F.lit("AllAg"), F.lit("AllCell")), "org", "ag_class", F.lit("-"), "ct_class", F.lit("-"))
    one = F.concat_ws("\t", F.concat_ws(".", of(7), of(4), F.lit("05"), F.lit("CTCF"), F.lit("AllCell")), "org", "ag_class", F.lit("-"), "ct_class", F.lit("-"))  # of one antigen; it doesn't count
    lines = x.select("line_no", F.posexplode(F.array(one, whole)).alias("i", "value"))
    lines.repartitionByRange("line_no").sortWithinPartitions("line_no", "i").select("value").write.text(path)
    return vocab.class_codes(readers.read_class_list(t.spark, path))


@query("SELECT (row_number() OVER (ORDER BY antigen) - 1)::INTEGER AS idx, antigen AS name FROM (SELECT DISTINCT antigen FROM r0)", "experiments", CANDIDATES)
def vocabulary_stored(t: Tables) -> DataFrame:
    """The feature list as a release stores it, in order."""
    path, chosen = scratch(t.spark, "vocabulary"), checkpointed(_candidates(t))
    codes = t.spark.createDataFrame([], "kind string, name string, code string")
    sinks.write_vocabulary(t.spark, path, vocab.tissue_table(chosen, codes), vocab.features(chosen), vocab.availability_map(chosen))
    return readers.read_feature_list(t.spark, f"{path}/features.json")


@query("SELECT DISTINCT ct_class AS tissue, antigen FROM experiments WHERE ag_class NOT LIKE 'PROMO%' AND antigen <> 'Brand#11'", "experiments")
def vocab_exclusions(t: Tables) -> DataFrame:
    """Control classes and tag antigens never enter the vocabulary."""
    x = t.experiments().withColumns({"ag_class": F.when(F.col("ag_class").startswith("PROMO"), "Input control").otherwise(F.col("ag_class")), "antigen": F.when(F.col("antigen") == "Brand#11", "Epitope_tags").otherwise(F.col("antigen"))})
    return vocab.candidate_pairs(x)


@query("SELECT chrom AS \"Chromosome\", s AS \"Start\", e AS \"End\", value AS \"Name\", antigen AS feature_name FROM chunked WHERE tissue = 'widget' AND chrom = 'chr3' AND chunk = 5", *MAPPED, RUNS, CHUNKED)
def load_chunk(t: Tables) -> DataFrame:
    """One chunk of one chromosome, from stored files: a folder, and one row group."""
    path = scratch(t.spark, "omics")
    sinks.write_omics(_omics(t), path)
    return omics.load_chunk(readers.read_omics(t.spark, path), "widget", "chr3", 5)


FEW = "few := SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY src) AS n FROM top) WHERE n <= 30"


@query("SELECT src, dst, score, rank FROM few WHERE rank <= 8", *MAPPED, *ALL_WINDOWS[1:], IDS, PROFILE, WEIGHTS, *JACCARD, FEW)
def pairs_without_generic(t: Tables) -> DataFrame:
    """Windows with more than thirty partners are too generic to be a source, but stay partners of others."""
    return _pairs(t, disqualify_above=30)


@query("SELECT src, dst, score, rank FROM top WHERE rank <= 8", *MAPPED, *ALL_WINDOWS[1:], IDS, PROFILE, WEIGHTS, *JACCARD)
def pairs_csr_stored(t: Tables) -> DataFrame:
    """Neighbours as read from compressed rows."""
    path, profile = scratch(t.spark, "csr"), _profile(t)
    sinks.write_csr(checkpointed(_pairs(t, profile)), path, profile[1].filter("split = 'train'"))
    return pairs.PairIndex.of_csr(t.spark.read.parquet(f"{path}/indptr"), t.spark.read.parquet(f"{path}/values"), profile[1]).pairs


def _signal(t: Tables) -> DataFrame:
    return _runs(t).withColumnsRenamed({"ct_class": "tissue", "antigen": "feature"})


@query("SELECT tissue, chrom, chunk, s, e, value, antigen AS feature, 'missing' AS fault FROM chunked WHERE chunk % 5 = 2 UNION ALL SELECT tissue, chrom, chunk, s, e, value + 1, antigen, 'extra' FROM chunked WHERE chunk % 5 = 3 UNION ALL SELECT tissue, chrom, chunk, s, e, value, antigen, 'missing' FROM chunked WHERE chunk % 5 = 3", *MAPPED, RUNS, CHUNKED)
def rederived_faults(t: Tables) -> DataFrame:
    """Stored signal that lacks some chunks and has other values in some: all rows that differ."""
    signal = checkpointed(_signal(t))
    stored = omics.omics_chunks(signal, CHUNK).filter("chunk % 5 <> 2").withColumn("Name", (F.col("Name") + (F.col("chunk") % 5 == 3).cast("int")).cast("int"))
    return _named(verify.rederived(stored, signal, CHUNK))


@query(f"SELECT tissue, chrom, chunk, s, e, value, antigen AS feature FROM (SELECT * REPLACE (CASE WHEN chunk % 4 = 1 THEN chunk + 3 ELSE chunk END AS chunk) FROM chunked) WHERE s >= (chunk + 1) * {CHUNK} OR greatest(e, s + 1) <= chunk * {CHUNK}", *MAPPED, RUNS, CHUNKED)
def misplaced_rows(t: Tables) -> DataFrame:
    """Rows that were put three chunks further on."""
    moved = _omics(t).withColumn("chunk", F.when(F.col("chunk") % 4 == 1, F.col("chunk") + 3).otherwise(F.col("chunk")))
    return verify.misplaced_rows(moved, CHUNK).select("tissue", "chrom", "chunk", F.col("Start").alias("s"), F.col("End").alias("e"), F.col("Name").alias("value"), F.col("feature_name").alias("feature"))


@query("SELECT chrom, s, e, CASE WHEN s % 3 = 0 THEN NULL ELSE (e - s - 1) END::INTEGER AS have FROM pieces WHERE s % 3 = 0 OR s % 5 = 1", BASES, PIECES)
def dna_faults(t: Tables) -> DataFrame:
    """Sequence chunks of which some are missing and some lack a letter."""
    pieces = checkpointed(omics.dna_chunks(_fasta(t).pieces, 256))
    grid = windows.chunk_grid(pieces.groupBy("chrom").agg(F.max("end").alias("len")), 256)
    return _named(verify.dna_faults(pieces.filter("start % 3 <> 0").withColumn("dna", F.when(F.col("start") % 5 == 1, F.expr("substring(dna, 2)")).otherwise(F.col("dna"))), grid))


@query("SELECT l.chrom, l.s, l.e + 50000 AS e, l.split FROM labelled l JOIN sizes z ON z.chrom = l.chrom WHERE l.s % 3 = 0 AND l.e + 50000 > z.len", *ALL_WINDOWS)
def window_faults(t: Tables) -> DataFrame:
    """Windows that were moved beyond the ends of their chromosomes."""
    moved = _labelled(t).withColumn("end", F.col("end") + F.when(F.col("start") % 3 == 0, 50000).otherwise(0))
    return _named(verify.window_faults(moved, t.sizes()))


@query("SELECT DISTINCT ct_class AS tissue, antigen FROM experiments x WHERE antigen = 'Brand#11' OR NOT EXISTS (SELECT 1 FROM mapped m WHERE m.ct_class = x.ct_class AND m.antigen = x.antigen)", *MAPPED)
def unbacked_vocabulary(t: Tables) -> DataFrame:
    """A vocabulary whose antigen of one brand has no stored row."""
    x = t.experiments()
    return verify.unbacked_vocabulary(vocab.candidate_pairs(x), _omics(t).filter("feature_name <> 'Brand#11'"))


@query("SELECT DISTINCT ct_class AS tissue, chrom FROM mapped WHERE ct_class < 'h' AND chrom = 'chr2'", *MAPPED)
def missing_omics(t: Tables) -> DataFrame:
    """Stored signal that lacks a chromosome of some tissues."""
    signal = checkpointed(_signal(t))
    return verify.missing_omics(omics.omics_chunks(signal, CHUNK).filter("NOT (tissue < 'h' AND chrom = 'chr2')"), signal)


@query("SELECT DISTINCT ct_class AS tissue, antigen FROM experiments WHERE ct_class < 'h' AND antigen > 'Brand#3'", "experiments")
def unreachable_features(t: Tables) -> DataFrame:
    """Files by slug that lack some antigens of some tissues."""
    chosen = checkpointed(vocab.candidate_pairs(t.experiments()))
    files = chosen.filter("NOT (tissue < 'h' AND antigen > 'Brand#3')").select("tissue", F.regexp_replace("antigen", "#", "_").alias("stem"))
    return verify.unreachable_features(chosen, files)


@query("SELECT chrom, s, e, value FROM (SELECT *, s < lag(e) OVER (PARTITION BY chrom ORDER BY s, e) AS late FROM (SELECT chrom, s, e + CASE WHEN s % 4 = 0 THEN 1 ELSE 0 END AS e, value FROM chrom_runs)) WHERE late", *MAPPED, CHROM_RUNS)
def overlapping_runs(t: Tables) -> DataFrame:
    """Runs of which some were made to reach into the next."""
    runs = checkpointed(intervals.max_runs(t.mapped(), ["chrom"], value="score"))
    return _named(verify.disjoint(runs.withColumn("end", F.col("end") + (F.col("start") % 4 == 0).cast("int")), ["chrom"]))
