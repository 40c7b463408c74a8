"""Signal and sequence by chunk, and what a reader asks of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.operators.intervals import chunk_numbers

CHUNK = 65536
#: The columns of stored signal.
SCHEMA = "Chromosome string, Start long, End long, Name int, feature_name string"


def omics_chunks(runs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """tissue, chrom, chunk and the row of ``SCHEMA`` for every chunk that a run touches; runs stay uncut."""
    each = F.explode(chunk_numbers(F.col("start"), F.col("end"), chunk)).alias("chunk")
    return runs.select("tissue", "chrom", each, F.col("chrom").alias("Chromosome"), F.col("start").cast("long").alias("Start"), F.col("end").cast("long").alias("End"), F.col("value").cast("int").alias("Name"), F.col("feature").alias("feature_name"))


def chunk_row_counts(omics: DataFrame) -> DataFrame:
    """Rows and extent of each chunk that has any."""
    return omics.groupBy("tissue", "chrom", "chunk").agg(F.count("*").alias("rows"), F.min("Start").alias("first_start"), F.max("End").alias("last_end"))


def load_chunk(omics: DataFrame, tissue: str, chrom: str, chunk: int) -> DataFrame:
    """The rows of one chunk; partitions and row groups are pruned by the three conditions."""
    return omics.filter((F.col("tissue") == tissue) & (F.col("chrom") == chrom) & (F.col("chunk") == chunk)).select("Chromosome", "Start", "End", "Name", "feature_name")


def load_window(omics: DataFrame, tissue: str, chrom: str, begin: int, end: int, chunk: int = CHUNK) -> DataFrame:
    """Whole rows of all chunks that a window touches, neither clipped nor without repeats across chunks."""
    first, last = begin // chunk, max(end - 1, begin) // chunk
    rows = omics.filter((F.col("tissue") == tissue) & (F.col("chrom") == chrom) & F.col("chunk").between(first, last))
    return rows.select("Chromosome", "Start", "End", "Name", "feature_name")


def dna_chunks(sequences: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(chrom, start, end, dna) of whole sequences (chrom, seq) or of pieces of any length (chrom, start, seq), in upper case.

    Whole sequences are cut in their rows. Pieces are dealt by chunk and joined there, so no task holds more than chunks.
    """
    cut = F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    if "start" not in sequences.columns:
        df = sequences.select("chrom", F.posexplode(cut).alias("k", "dna")).withColumn("start", F.col("k").cast("long") * chunk)
        return df.select("chrom", "start", (F.col("start") + F.length("dna")).cast("long").alias("end"), F.upper("dna").alias("dna"))
    return _joined(_parts(sequences, chunk), chunk)


def _parts(pieces: DataFrame, chunk: int) -> DataFrame:
    """(chrom, k, at, x): pieces (chrom, start, seq) cut at the borders of chunks k."""
    cut = F.posexplode(F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))).alias("_i", "seq")
    df = pieces.select("chrom", "start", cut).withColumn("start", F.col("start") + F.col("_i").cast("long") * chunk)
    df = df.select("chrom", "start", "seq", F.explode(F.sequence(F.floor(F.col("start") / chunk), F.floor((F.col("start") + F.length("seq") - 1) / chunk))).alias("k"))
    low = F.greatest(F.col("k") * chunk - F.col("start"), F.lit(0))
    size = F.least((F.col("k") + 1) * chunk - F.col("start"), F.length("seq")) - low
    return df.select("chrom", "k", (F.col("start") + low).alias("at"), F.substring("seq", (low + 1).cast("int"), size.cast("int")).alias("x"))


def _joined(parts: DataFrame, chunk: int) -> DataFrame:
    """(chrom, start, end, dna): the parts of each chunk, at most a chunk's letters, in order."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda p: p["x"]), "")
    df = parts.groupBy("chrom", "k").agg(text.alias("dna")).withColumn("start", F.col("k") * chunk)
    return df.select("chrom", "start", (F.col("start") + F.length("dna")).alias("end"), F.upper("dna").alias("dna"))


def dna_with_donor(sequences: DataFrame, grid: DataFrame, donor: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(chrom, start, end, dna, adopted): the grid's chunks; those that the donor (chrom, start, end, dna) has, under the same name and
    whole, are taken from it, and only the others are cut from the sequences. Other donor pieces don't count."""
    names = ["chrom", "start", "end"]
    whole = donor.filter(F.length("dna") == F.col("end") - F.col("start"))
    taken = whole.join(grid.select(*names), names, "left_semi").dropDuplicates(names).select(*names, "dna")
    missing = grid.join(taken, names, "left_anti").select("chrom", F.floor(F.col("start") / chunk).alias("k"))
    pieces = sequences if "start" in sequences.columns else sequences.withColumn("start", F.lit(0).cast("long"))
    cut = _joined(_parts(pieces, chunk).join(missing, ["chrom", "k"], "left_semi"), chunk)
    return taken.withColumn("adopted", F.lit(True)).unionByName(cut.withColumn("adopted", F.lit(False)))


def dna_window(chunks: DataFrame, chrom: str, begin: int, end: int) -> DataFrame:
    """(chrom, start, end, dna) of one stretch, joined across chunks."""
    parts = chunks.filter((F.col("chrom") == chrom) & (F.col("start") < end) & (F.col("end") > begin))
    cut = F.expr(f"substring(dna, cast(greatest({begin} - start, 0) AS int) + 1, cast(least(end, {end}) - greatest(start, {begin}) AS int))")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", cut.alias("x")))), lambda p: p["x"]), "")
    return parts.groupBy("chrom").agg(text.alias("dna")).select("chrom", F.lit(begin).cast("long").alias("start"), F.lit(end).cast("long").alias("end"), "dna")
