"""The two halves of a build: peaks to tracks, tracks to a release. Each stage records itself in the manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from genoweave.functions.names import is_primary, slugify
from genoweave.operators import intervals, omics, pairs, peaks, vocab, windows
from genoweave.plans import verify
from genoweave.plans.release import Release, adopt
from genoweave.session import stored
from genoweave.sources import files, readers, sinks


class PeakCounts:
    """Counts of peaks taken while they pass on their way to the tracks; they cost no scan of their own.

    They are there once the first action over the tracks has ended: rows_in, bad_rows, unmapped, rows_out.
    """

    def __init__(self) -> None:
        self._seen = {x: Observation() for x in ("read", "resolved", "mapped")}

    def read(self, df: DataFrame) -> DataFrame:
        bad = F.count_if("bad") if "bad" in df.columns else F.lit(0).cast("long") + F.count_if(F.lit(False))
        return df.observe(self._seen["read"], F.count("*").alias("rows_in"), bad.alias("bad_rows"))

    def resolved(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen["resolved"], F.count_if(F.col("group_id").isNull()).alias("unmapped"))

    def mapped(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen["mapped"], F.count("*").alias("rows_out"))

    def result(self) -> dict[str, int]:
        found = {k: v for o in self._seen.values() for k, v in o.get.items()}
        return found | {"lost": found["rows_in"] - found["bad_rows"] - found["unmapped"] - found["rows_out"]}


def build_tracks(
    peak_rows: DataFrame, experiments: DataFrame, org: str, *, group_by: Sequence[str] = peaks.GROUP_BY, bin_size: int = 1, counts: PeakCounts | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """groups, resolved peaks and tracks; two groups with one path are refused. Peaks may come with ``bad`` lines among them;
    ``counts`` are filled when the tracks are written."""
    known = peaks.experiments_of(experiments, org, group_by)
    groups = peaks.group_table(known, group_by)
    clash = peaks.path_collisions(groups).first()
    if clash:
        raise ValueError(f"groups {clash.group_ids} would share {clash.path}")
    good = lambda df: df.filter(~F.col("bad")).drop("bad") if "bad" in df.columns else df
    lookup = peaks.accession_lookup(known, groups, group_by)
    resolved = peaks.resolve(good(peak_rows), lookup)
    passing = counts.resolved(peaks.resolve(good(counts.read(peak_rows)), lookup)) if counts else resolved
    mapped = passing.filter("group_id IS NOT NULL").join(groups.select("group_id", *group_by), "group_id")
    return groups, resolved, peaks.tracks(counts.mapped(mapped) if counts else mapped, group_by, bin_size=bin_size)


def build_release(
    release: Release, groups: DataFrame, tracks: DataFrame, sequences: DataFrame, blacklist: DataFrame, *, sizes: Sequence[int] = windows.WINDOWS, chunk: int = windows.CHUNK, block: int = windows.BLOCK, val: Sequence[str] = windows.VAL_CHROMS,
    min_antigens: int = vocab.MIN_ANTIGENS, min_tissues: int = vocab.MIN_TISSUES, keep_chroms: Sequence[str] | None = None, codes: DataFrame | None = None, pair_window: int | None = None, pair_options: dict | None = None,
    peak_counts: dict[str, int] | None = None, donor: DataFrame | None = None,
) -> list[tuple[str, int, bool]]:
    """All stages in order: adopt, genome, pan tissue, vocabulary, intervals, chunks, pairs, verify. Returns the checks.

    Sequences are whole (chrom, seq) or in pieces (chrom, start, seq). ``peak_counts`` are those of the tracks' build, which
    the manifest keeps; peaks lost on the way keep the release from being promoted. ``donor`` has sequence chunks to adopt.
    """
    spark = release.spark
    adopt(release, groups, tracks)
    if peak_counts is not None:
        release.record("peaks", **peak_counts)
    tracks = release.table("tracks")

    lens = readers.chrom_sizes(sequences)
    lens = lens.filter(F.col("chrom").isin(*keep_chroms)) if keep_chroms else lens.filter(is_primary(F.col("chrom")))
    sinks.write_chrom_sizes(lens, release.path("sizes"))
    release.record("genome", chroms=lens.count())
    lens = readers.read_chrom_sizes(spark, release.path("sizes"))
    sequences = sequences.join(lens, "chrom", "left_semi")

    sinks.write_tracks(peaks.pan_tissue(tracks, chroms=lens), release.path("pan"), ("ag_class", "antigen"))
    pan = release.table("pan")
    release.record("pantissue", tissue=vocab.PAN)

    chosen, rounds = vocab.select(vocab.candidate_pairs(groups), min_antigens, min_tissues)
    chosen = vocab.with_pan(chosen)
    names = vocab.features(chosen)
    codes = codes if codes is not None else spark.createDataFrame([], "kind string, name string, code string")
    sinks.write_vocabulary(spark, release.path("vocabulary"), vocab.tissue_table(chosen, codes.filter("kind = 'tissue'")), names, vocab.availability_map(chosen))
    release.record("vocab", rounds=rounds, features=names.count())

    whole = "start" not in sequences.columns
    n_runs, black = intervals.n_runs(sequences, ["chrom"]) if whole else intervals.n_runs_of_pieces(sequences), intervals.merge_runs(blacklist, ["chrom"])
    tissues = chosen.select("tissue")
    for size in sizes:
        made = windows.build_windows(lens, n_runs, black, tissues, size, block=block, val=val)
        sinks.write_windows(made, release.path("windows", window=size))
    grid = windows.chunk_grid(lens, chunk)
    sinks.write_windows(grid, release.path("grid"))
    release.manifest["chunk_size"] = chunk
    release.record("intervals", windows=list(sizes))

    signal = _signal(tracks, pan, chosen, lens)
    chunked = omics.omics_chunks(signal, chunk)
    sinks.write_omics(chunked, release.path("omics"), _wanted_files(spark, chosen, lens))
    adopted = 0
    if donor is None:
        sinks.write_dna(omics.dna_chunks(sequences, chunk), release.path("dna"))
    else:
        sinks.write_dna(omics.dna_with_donor(sequences, grid, donor, chunk).drop("adopted"), release.path("dna"))
        whole_ones = donor.filter(F.length("dna") == F.col("end") - F.col("start"))
        adopted = grid.join(whole_ones, ["chrom", "start", "end"], "left_semi").count()
    release.record("chunks", dna_adopted=adopted, dna_cut=grid.count() - adopted)

    size = pair_window or sizes[0]
    ids = stored(pairs.window_ids(release.windows(size)), "window-ids")
    profile = pairs.profiles(ids, signal.filter(F.col("tissue") != vocab.PAN))
    weights = pairs.idf_weights(profile, ids, names.select(F.col("name").alias("track")))
    sinks.write_pairs(pairs.similar_pairs(profile, ids, weights, **(pair_options or {})), weights, release.path("pairs"))
    sinks.write_csr(spark.read.parquet(f"{release.path('pairs')}/pairs"), f"{release.path('pairs')}/csr")
    release.record("pairs", window=size)

    return verify_release(release)


def _signal(tracks: DataFrame, pan: DataFrame, chosen: DataFrame, lens: DataFrame) -> DataFrame:
    """(tissue, feature, chrom, start, end, value) of the vocabulary's tracks."""
    every = tracks.select("ct_class", "antigen", "chrom", "start", "end", "value").unionByName(pan.select("ct_class", "antigen", "chrom", "start", "end", "value"))
    every = every.join(chosen.select(F.col("tissue").alias("ct_class"), "antigen"), ["ct_class", "antigen"]).join(lens, "chrom", "left_semi")
    return every.select(F.col("ct_class").alias("tissue"), F.col("antigen").alias("feature"), "chrom", "start", "end", "value")


def _wanted_files(spark, chosen: DataFrame, lens: DataFrame) -> DataFrame:
    """(tissue, chrom) that must have a file of signal."""
    chroms = F.array(*[F.lit(r.chrom) for r in lens.select("chrom").collect()])  # tens of chromosomes
    return chosen.select("tissue").distinct().select("tissue", F.explode(chroms).alias("chrom"))


def verify_release(release: Release) -> list[tuple[str, int, bool]]:
    """All checks of a release from what it stores. If all pass, the manifest says so, and it may be promoted."""
    spark, chunk = release.spark, release.manifest["chunk_size"]
    release.require("adopt", "genome", "pantissue", "vocab", "intervals", "chunks")
    sizes, peak_counts = release.manifest["stages"]["intervals"]["windows"], release.manifest["stages"].get("peaks")
    lens = readers.read_chrom_sizes(spark, release.path("sizes"))
    tracks, pan, grid = release.table("tracks"), release.table("pan"), release.table("grid")
    chosen = spark.createDataFrame([(t, f) for t, names in release.availability().items() for f in names], "tissue string, antigen string")
    signal = _signal(tracks, pan, chosen, lens)
    stored = release.table("omics")
    asked = omics.omics_chunks(signal, chunk).select("tissue", "chrom", "chunk").distinct().unionByName(_wanted_files(spark, chosen, lens), allowMissingColumns=True)
    on_disk = tracks.select("ct_class", "antigen").unionByName(pan.select("ct_class", "antigen")).distinct()
    stems = on_disk.select(F.col("ct_class").alias("tissue"), slugify(F.col("antigen")).alias("stem")).distinct()
    below = tracks.filter(F.col("ct_class") != vocab.PAN).join(lens, "chrom", "left_semi")
    checks = verify.report(
        {
            "tissues and chromosomes with signal have rows": verify.missing_omics(stored, signal),
            "row groups are those of the footers and the signal": verify.footer_faults(files.footers(spark, release.path("omics")), asked, chunk),
            "rows lie in their chunk": verify.misplaced_rows(stored, chunk),
            "rows are those of the tracks": verify.rederived(stored, signal, chunk),
            "the vocabulary has rows": verify.unbacked_vocabulary(chosen, stored),
            "every feature is reachable": verify.unreachable_features(chosen, stems),
            "sequence chunks are whole": verify.dna_faults(release.table("dna"), grid),
            "pan runs are disjoint": verify.disjoint(pan, ["ag_class", "antigen", "chrom"]),
            "pan runs reach those of all tissues": verify.pan_dominance(below, pan, ["ag_class", "antigen"]).filter("above_pan > 0"),
        }
        | {f"windows of {n} lie in their chromosome": verify.window_faults(release.windows(n), lens) for n in sizes}
        | {f"a locus of {n} has one split": windows.split_clashes(release.windows(n)) for n in sizes}
    )
    if peak_counts is not None:
        checks.append(("peaks read are malformed, unmapped or in a track", abs(peak_counts["lost"]), peak_counts["lost"] == 0))
    if all(ok for _, _, ok in checks):
        release.record("verify", checks=len(checks))
    return checks
