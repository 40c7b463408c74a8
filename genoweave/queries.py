"""All queries over the standard tables by name, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave import fixtures as fx
from genoweave.fixtures import BIN, BLOCK, CHUNK, VAL, WINDOW, Tables
from genoweave.functions import names
from genoweave.operators import intervals as iv
from genoweave.operators import omics, pairs, peaks, vocab, windows
from genoweave.plans import build, verify
from genoweave.session import checkpointed, scratch, stored
from genoweave.sources import files, readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, *uses: str):
    """Registers a function of ``Tables``; ``uses`` are derived tables that its SQL reads, in order of need."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ctes = ", ".join(f"{u.split(' := ')[0]} AS ({u.split(' := ')[1] if ' := ' in u else fx.SQL[u]})" for u in uses)
            ORACLE_SQL[f.__name__] = (f"WITH {ctes} " if ctes else "") + sql
        return f

    return register


def _named(df: DataFrame) -> DataFrame:
    """start and end as s and e, which both engines take as names."""
    return df.withColumnsRenamed({"start": "s", "end": "e"})


MERGED_N, MERGED_BLACK = f"n_runs := {fx.merged_sql('n_intervals')}", f"black := {fx.merged_sql('blacklist')}"
WINDOWS, MEASURED = f"windows := {fx.windows_sql(WINDOW)}", "measured := " + fx.overlap_sql("(" + fx.overlap_sql("windows", "n_runs", "n_bp") + ")", "black", "blacklist_bp")
KEPT, BLOCKS = "kept := SELECT chrom, s, e FROM measured WHERE NOT (n_bp > (e - s) * 0.5) AND blacklist_bp = 0", f"blocks := {fx.BLOCKS_SQL}"
LABELLED = f"labelled := SELECT k.chrom, k.s, k.e, b.split FROM kept k JOIN blocks b ON b.chrom = k.chrom AND b.block = least(((k.s + k.e) // 2) // {BLOCK}, (SELECT max(block) FROM blocks c WHERE c.chrom = k.chrom))"
ALL_WINDOWS = ("peaks", "sizes", "n_intervals", "blacklist", MERGED_N, MERGED_BLACK, WINDOWS, MEASURED, KEPT, BLOCKS, LABELLED)
RUNS = "tissue_runs := " + fx.max_runs_sql("mapped", "ct_class, antigen, chrom")
MAPPED = ("peaks", "experiments", "mapped")
GROUPS = "groups := SELECT (row_number() OVER (ORDER BY ag_class, antigen, ct_class) - 1)::INTEGER AS group_id, ag_class, antigen, ct_class, count(*) AS n_experiments FROM experiments GROUP BY ag_class, antigen, ct_class"
LOOKUP = "lookup := SELECT x.srx, g.group_id FROM (SELECT *, row_number() OVER (PARTITION BY srx ORDER BY line_no) AS n FROM experiments) x JOIN groups g USING (ag_class, antigen, ct_class) WHERE n = 1"
RESOLVED = "resolved := SELECT p.*, l.group_id FROM peaks p LEFT JOIN lookup l USING (srx)"
PROFILE = "profile := SELECT DISTINCT i.window_id, m.srx AS track FROM ids i JOIN mapped m ON m.chrom = i.chrom AND m.e > i.s AND m.s < i.e"
IDS = "ids := SELECT row_number() OVER (ORDER BY chrom, s) - 1 AS window_id, chrom, s, e, split FROM labelled"
WEIGHTS = "weights := SELECT t.track, coalesce(n, 0)::DOUBLE / (SELECT count(*) FROM ids WHERE split = 'train') AS p, ln(1 / greatest(least(coalesce(n, 0)::DOUBLE / (SELECT count(*) FROM ids WHERE split = 'train'), 1), 0.0001)) AS weight FROM (SELECT DISTINCT srx AS track FROM mapped) t LEFT JOIN (SELECT track, count(*) AS n FROM profile JOIN ids USING (window_id) WHERE split = 'train' GROUP BY track) USING (track)"


def _resolved(t: Tables) -> DataFrame:
    x = t.experiments()
    return peaks.resolve(t.peaks(), peaks.accession_lookup(x, peaks.group_table(x)))


def _labelled(t: Tables) -> DataFrame:
    kept = windows.kept_windows(_measured(t))
    return windows.label_windows(kept, windows.assign_blocks(t.sizes(), block=BLOCK, val=VAL), BLOCK)


def _measured(t: Tables) -> DataFrame:
    return windows.measured(windows.window_starts(t.sizes(), WINDOW), iv.merge_runs(t.n_intervals(), ["chrom"]), iv.merge_runs(t.blacklist(), ["chrom"]))


def _runs(t: Tables) -> DataFrame:
    return iv.max_runs(t.mapped(), ["ct_class", "antigen", "chrom"], value="score")


def _omics(t: Tables) -> DataFrame:
    return omics.omics_chunks(_runs(t).withColumnsRenamed({"ct_class": "tissue", "antigen": "feature"}), CHUNK)


def _profile(t: Tables) -> tuple[DataFrame, DataFrame]:
    ids = stored(pairs.window_ids(_labelled(t)), "window-ids")  # a release stores both
    known = t.experiments().select(F.col("srx").alias("track"))  # dealt with the pairs, as a broadcast table of all accessions grows in each task
    return checkpointed(pairs.profiles(ids, t.peaks(), track="srx").join(known.hint("merge"), "track", "left_semi").select("window_id", "track")), ids


@query(fx.max_runs_sql("mapped", "antigen, chrom").replace("WITH iv", ", iv", 1), *MAPPED)
def max_runs(t: Tables) -> DataFrame:
    return _named(iv.max_runs(t.mapped(), ["antigen", "chrom"], value="score"))


@query(fx.max_runs_sql("mapped", "antigen, chrom", step=128).replace("WITH iv", ", iv", 1), *MAPPED)
def max_runs_binned(t: Tables) -> DataFrame:
    return _named(iv.max_runs(t.mapped(), ["antigen", "chrom"], value="score", bin_size=128))


@query(fx.max_runs_sql("mapped", "ag_class, antigen, ct_class, chrom").replace("WITH iv", ", iv", 1), *MAPPED)
def group_tracks(t: Tables) -> DataFrame:
    return _named(peaks.tracks(t.mapped(), peaks.GROUP_BY))


@query("SELECT ag_class, antigen, chrom, s, e, value, 'All cell types' AS ct_class FROM (" + fx.max_runs_sql("group_runs", "ag_class, antigen, chrom", "value") + ")", *MAPPED, "group_runs := " + fx.max_runs_sql("mapped", "ag_class, antigen, ct_class, chrom"))
def pan_tissue_runs(t: Tables) -> DataFrame:
    return _named(peaks.pan_tissue(peaks.tracks(t.mapped(), peaks.GROUP_BY), chroms=t.sizes()))


@query("SELECT chrom, count(*) AS n, min(s) AS first_s, max(e) AS last_e, sum(score)::BIGINT AS total FROM peaks GROUP BY chrom", "peaks")
def peak_scan_typed(t: Tables) -> DataFrame:
    path, p = scratch(t.spark, "bed5"), t.peaks()
    wrong = F.concat_ws("\t", "chrom", "start", "end", "srx", "score", "srx")  # lines of another width, which the reader sets apart
    p.select(F.explode(F.array(F.concat_ws("\t", *p.columns), wrong)).alias("value")).write.option("compression", "gzip").text(path)
    found = readers.good_peaks(readers.read_peaks(t.spark, path))
    return found.groupBy("chrom").agg(F.count("*").alias("n"), F.min("start").alias("first_s"), F.max("end").alias("last_e"), F.sum("score").alias("total"))


@query("SELECT *, 'hg38/' || k(ag_class) || '/' || k(ct_class) || '/' || k(antigen) || '.bed' AS path FROM groups".replace("k(", "regexp_replace(").replace("_class)", "_class, '[^A-Za-z0-9._+-]+', '_', 'g')").replace("(antigen)", "(antigen, '[^A-Za-z0-9._+-]+', '_', 'g')"), "experiments", GROUPS)
def experiment_groups(t: Tables) -> DataFrame:
    return peaks.group_table(peaks.experiments_of(t.experiments(), "hg38"))


@query("SELECT srx, group_id FROM lookup", "experiments", GROUPS, LOOKUP)
def dedupe_first_accession(t: Tables) -> DataFrame:
    x = t.experiments()
    return peaks.accession_lookup(x.union(x.withColumn("line_no", F.col("line_no") + 1_000_000).withColumn("antigen", F.lit("Brand#1"))), peaks.group_table(x))


@query("SELECT chrom, s, e, srx, score, group_id FROM resolved", "peaks", "experiments", GROUPS, LOOKUP, RESOLVED)
def peak_group_join(t: Tables) -> DataFrame:
    return _named(_resolved(t))


@query("SELECT count(*) AS rows_in, count(*) FILTER (group_id IS NULL) AS unmapped, count(group_id) AS rows_out, round(100.0 * count(*) FILTER (group_id IS NULL) / count(*), 6) AS unmapped_pct, chrom FROM resolved GROUP BY chrom", "peaks", "experiments", GROUPS, LOOKUP, RESOLVED)
def unmapped_counts(t: Tables) -> DataFrame:
    return peaks.conservation(_resolved(t), ["chrom"])


@query("SELECT group_id, count(*) AS n_peaks, count(DISTINCT srx) AS n_accessions, min(s) AS first_start, max(e) AS last_end, min(score) AS min_score, max(score) AS max_score FROM resolved WHERE group_id IS NOT NULL GROUP BY group_id", "peaks", "experiments", GROUPS, LOOKUP, RESOLVED)
def group_summary(t: Tables) -> DataFrame:
    return peaks.group_summary(_resolved(t))


NAMES = "raw := SELECT DISTINCT x FROM (SELECT p_brand || ' (' || p_name || ')' AS x FROM part UNION ALL SELECT '  ' || left(replace(p_type, 'A', '/'), 3) || ' ' FROM part UNION ALL SELECT unnest(['', '-', 'N/A', '   ', 'Unclassified', '._x_.', 'H2APERIODX', 'RNA_polymerase_II']))"


def _names(t: Tables) -> DataFrame:
    p = t.read("part")
    odd = t.spark.createDataFrame([(x,) for x in ("", "-", "N/A", "   ", "Unclassified", "._x_.", "H2APERIODX", "RNA_polymerase_II")], "x string")
    return p.select(F.concat("p_brand", F.lit(" ("), "p_name", F.lit(")")).alias("x")).union(p.select(F.concat(F.lit("  "), F.left(F.replace("p_type", F.lit("A"), F.lit("/")), F.lit(3)), F.lit(" ")))).union(odd).distinct()


@query(r"SELECT x, CASE WHEN y = '' THEN 'NA' ELSE y END AS slug FROM (SELECT x, trim(regexp_replace(regexp_replace(x, '^\s+|\s+$', '', 'g'), '[^A-Za-z0-9._+-]+', '_', 'g'), '_.') AS y FROM raw)", NAMES)
def slug_ascii(t: Tables) -> DataFrame:
    return _names(t).select("x", names.slug_ascii(F.col("x")).alias("slug"))


@query(None)
def slug_nfkd(t: Tables) -> DataFrame:
    return t.read("documents").select("doc_id", names.slugify(F.col("text")).alias("slug"))


@query(r"SELECT x, CASE WHEN y IN ('', '-', 'N/A') THEN 'NA' ELSE y END AS field FROM (SELECT x, regexp_replace(x, '^\s+|\s+$', '', 'g') AS y FROM raw)", NAMES)
def normalise_na(t: Tables) -> DataFrame:
    return _names(t).select("x", names.normalise(F.col("x")).alias("field"))


@query("SELECT x, lower(trim(replace(replace(x, 'PERIOD', '.'), '_', ' '))) AS canonical FROM raw", NAMES)
def canonical_alias(t: Tables) -> DataFrame:
    return _names(t).select("x", names.canonical(F.col("x")).alias("canonical"))


@query("SELECT chrom, regexp_matches(chrom, '^chr([0-9]+|X|Y|M|MT)$') AS is_main, count(*) AS n FROM (SELECT chrom FROM peaks UNION ALL SELECT 'chrUn_' || chrom FROM peaks) GROUP BY chrom", "peaks")
def primary_chroms(t: Tables) -> DataFrame:
    p = t.peaks().select("chrom")
    return p.union(p.select(F.concat(F.lit("chrUn_"), "chrom"))).groupBy("chrom").agg(F.count("*").alias("n")).select("chrom", names.is_primary(F.col("chrom")).alias("is_main"), "n")


@query("SELECT chrom, s, e FROM n_runs", "n_intervals", MERGED_N)
def merge_runs(t: Tables) -> DataFrame:
    return _named(iv.merge_runs(t.n_intervals(), ["chrom"]))


@query("""SELECT doc_id, min(i) - 1 AS s, max(i) AS e FROM (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS g FROM (
    SELECT doc_id, generate_subscripts(c, 1) AS i, unnest(c) AS ch FROM (SELECT doc_id, string_split(text, '') AS c FROM documents)) WHERE ch IN ('n', 'N')) GROUP BY doc_id, g""")
def n_runs(t: Tables) -> DataFrame:
    return _named(iv.n_runs(t.read("documents"), ["doc_id"], seq="text"))


@query("SELECT chrom, s, e, n_bp FROM (" + fx.overlap_sql("windows", "n_runs", "n_bp") + ")", "peaks", "sizes", "n_intervals", MERGED_N, WINDOWS)
def overlap_bp(t: Tables) -> DataFrame:
    return _named(iv.overlap_bp(windows.window_starts(t.sizes(), WINDOW), iv.merge_runs(t.n_intervals(), ["chrom"]), out="n_bp"))


@query("SELECT p.chrom, p.pos, coalesce((SELECT sum(least(r.e, p.pos) - r.s) FROM n_runs r WHERE r.chrom = p.chrom AND r.s < p.pos), 0)::BIGINT AS covered FROM (SELECT DISTINCT chrom, s AS pos FROM peaks) p", "peaks", "n_intervals", MERGED_N)
def covered_before(t: Tables) -> DataFrame:
    return iv.covered_before(t.peaks().select("chrom", F.col("start").alias("pos")).distinct(), iv.merge_runs(t.n_intervals(), ["chrom"]))


@query(f"SELECT chrom, x AS s, least(x + {CHUNK}, len) AS e FROM (SELECT *, unnest(range(0, len, {CHUNK})) AS x FROM sizes)", "peaks", "sizes")
def chunk_grid(t: Tables) -> DataFrame:
    return _named(windows.chunk_grid(t.sizes(), CHUNK))


@query(f"SELECT chrom, s, e, srx, score, unnest(range(s // {CHUNK}, (greatest(e - 1, s)) // {CHUNK} + 1)) AS chunk FROM peaks", "peaks")
def explode_chunks(t: Tables) -> DataFrame:
    return _named(iv.explode_to_chunks(t.peaks(), CHUNK))


CHUNKED = f"chunked := SELECT ct_class AS tissue, chrom, unnest(range(s // {CHUNK}, (e - 1) // {CHUNK} + 1)) AS chunk, s, e, value, antigen FROM tissue_runs"


@query("SELECT tissue, chrom, chunk, count(*) AS rows, min(s) AS first_start, max(e) AS last_end FROM chunked GROUP BY tissue, chrom, chunk", *MAPPED, RUNS, CHUNKED)
def chunk_row_counts(t: Tables) -> DataFrame:
    return omics.chunk_row_counts(_omics(t))


@query("SELECT chrom AS \"Chromosome\", s AS \"Start\", e AS \"End\", value AS \"Name\", antigen AS feature_name FROM chunked WHERE tissue = 'widget' AND chrom = 'chr2' AND chunk BETWEEN 2 AND 4", *MAPPED, RUNS, CHUNKED)
def load_window(t: Tables) -> DataFrame:
    return omics.load_window(_omics(t), "widget", "chr2", 2 * CHUNK + 10, 4 * CHUNK + 1, CHUNK)


@query("SELECT chrom, s, e FROM windows", "peaks", "sizes", WINDOWS)
def window_starts(t: Tables) -> DataFrame:
    return _named(windows.window_starts(t.sizes(), WINDOW))


@query("SELECT chrom, block, split FROM blocks", "peaks", "sizes", BLOCKS)
def block_split(t: Tables) -> DataFrame:
    return windows.assign_blocks(t.sizes(), block=BLOCK, val=VAL)


@query("SELECT chrom, s, e, split FROM labelled", *ALL_WINDOWS)
def windows_labelled(t: Tables) -> DataFrame:
    return _named(_labelled(t))


@query("SELECT count(*) AS windows, count(*) FILTER (NOT n AND NOT b) AS kept, count(*) FILTER (n) AS dropped_n, count(*) FILTER (b AND NOT n) AS dropped_blacklist FROM (SELECT n_bp > (e - s) * 0.5 AS n, blacklist_bp > 0 AS b FROM measured)", *ALL_WINDOWS[:8])
def window_stats(t: Tables) -> DataFrame:
    return windows.window_stats(_measured(t))


TISSUES = "tissues := SELECT DISTINCT ct_class AS tissue FROM experiments"


@query("SELECT chrom, s, e, strand, tissue, split FROM labelled, (SELECT unnest(['+', '-']) AS strand), tissues", "experiments", TISSUES, *ALL_WINDOWS)
def windows_materialised(t: Tables) -> DataFrame:
    tissues = t.experiments().select(F.col("ct_class").alias("tissue"))
    return _named(windows.build_windows(t.sizes(), iv.merge_runs(t.n_intervals(), ["chrom"]), iv.merge_runs(t.blacklist(), ["chrom"]), tissues, WINDOW, block=BLOCK, val=VAL))


@query("SELECT count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test FROM labelled", *ALL_WINDOWS)
def split_counts(t: Tables) -> DataFrame:
    return windows.split_counts(_labelled(t))


OTHER_BLOCKS = "others := " + fx.BLOCKS_SQL.replace("md5('42:'", "md5('43:'")
OTHER = "moved := SELECT l.chrom, l.s, b.split FROM labelled l JOIN others b ON b.chrom = l.chrom AND b.block = least(((l.s + l.e) // 2) // {0}, (SELECT max(block) FROM others c WHERE c.chrom = l.chrom))".format(BLOCK)


@query("SELECT chrom, s AS start, count(DISTINCT split) AS n_splits FROM (SELECT chrom, s, split FROM labelled UNION ALL SELECT chrom, s, split FROM moved) GROUP BY chrom, s HAVING count(DISTINCT split) > 1", *ALL_WINDOWS, OTHER_BLOCKS, OTHER)
def locus_split_clash(t: Tables) -> DataFrame:
    """The windows once more, split under another seed: loci that this moves are found."""
    kept = windows.kept_windows(_measured(t))
    of = lambda seed: windows.label_windows(kept, windows.assign_blocks(t.sizes(), block=BLOCK, val=VAL, seed=seed), BLOCK)
    return windows.split_clashes(of(42).union(of(43)))


CANDIDATES = "r0 := SELECT DISTINCT celltype || ' ' || ct_class AS tissue, antigen || ' ' || ag_class AS antigen FROM experiments"


#: Antigens of a tissue and tissues of an antigen at least.
ENOUGH = (24, 6)


def _rounds(n: int) -> list[str]:
    out = []
    for i in range(n):
        out += [f"t{i} := SELECT * FROM r{i} WHERE tissue IN (SELECT tissue FROM r{i} GROUP BY tissue HAVING count(*) >= {ENOUGH[0]})", f"r{i + 1} := SELECT * FROM t{i} WHERE antigen IN (SELECT antigen FROM t{i} GROUP BY antigen HAVING count(*) >= {ENOUGH[1]})"]
    return out


def _candidates(t: Tables) -> DataFrame:
    return vocab.candidate_pairs(t.experiments().withColumns({"ct_class": F.concat_ws(" ", "celltype", "ct_class"), "antigen": F.concat_ws(" ", "antigen", "ag_class")}))


@query("SELECT tissue, antigen FROM r12", "experiments", CANDIDATES, *_rounds(12))
def vocab_select(t: Tables) -> DataFrame:
    return vocab.select(_candidates(t), *ENOUGH)[0]


@query("SELECT tissue, list_sort(list(antigen)) AS features FROM r0 GROUP BY tissue", "experiments", CANDIDATES)
def feature_availability(t: Tables) -> DataFrame:
    return vocab.availability_map(_candidates(t))


FROZEN = "frozen := SELECT i::INTEGER AS idx, 'brand#' || (i + 1)::VARCHAR || CASE WHEN i % 4 = 0 THEN '_' ELSE ' ' END || 'economy' AS name FROM range(0, 30) t(i)"
ALIASES = "aliases := SELECT name, min(antigen) AS alias, count(*) AS n FROM frozen JOIN (SELECT DISTINCT antigen FROM r0) ON lower(trim(replace(name, '_', ' '))) = lower(antigen) GROUP BY name"


def _frozen(t: Tables) -> DataFrame:
    i = F.col("id")
    return t.spark.range(30).select(i.cast("int").alias("idx"), F.concat(F.lit("brand#"), (i + 1).cast("string"), F.when(i % 4 == 0, "_").otherwise(" "), F.lit("economy")).alias("name"))


@query("SELECT name, alias, n FROM aliases", "experiments", CANDIDATES, FROZEN, ALIASES)
def vocab_aliases(t: Tables) -> DataFrame:
    return vocab.resolve_aliases(_frozen(t), _candidates(t))


@query("SELECT DISTINCT tissue, idx, name FROM (SELECT *, count(*) OVER (PARTITION BY tissue) AS n FROM (SELECT r.tissue, f.idx, f.name FROM r0 r JOIN aliases a ON r.antigen = a.alias JOIN frozen f USING (name))) WHERE n >= 5", "experiments", CANDIDATES, FROZEN, ALIASES)
def vocab_freeze(t: Tables) -> DataFrame:
    p, f = _candidates(t), _frozen(t)
    return vocab.apply_freeze(p, f, vocab.resolve_aliases(f, p), 5)["availability"]


@query("SELECT tissue, antigen FROM r0 UNION SELECT 'All cell types', antigen FROM r0", "experiments", CANDIDATES)
def vocab_with_pan(t: Tables) -> DataFrame:
    return vocab.with_pan(_candidates(t))


@query("SELECT doc_id::VARCHAR AS chrom, x AS s, least(x + 64, len(text))::BIGINT AS e, upper(substring(text, x + 1, 64)) AS dna FROM (SELECT *, unnest(range(0, len(text), 64)) AS x FROM (SELECT doc_id, replace(text, 'ß', 's') AS text FROM documents))")
def dna_chunks(t: Tables) -> DataFrame:
    return _named(omics.dna_chunks(t.read("documents").select(F.col("doc_id").cast("string").alias("chrom"), F.replace("text", F.lit("ß"), F.lit("s")).alias("seq")), 64))


@query("SELECT '3' AS chrom, 100::BIGINT AS s, 300::BIGINT AS e, upper(substring(replace(text, 'ß', 's'), 101, 200)) AS dna FROM documents WHERE doc_id = 3")
def dna_window(t: Tables) -> DataFrame:
    seq = t.read("documents").select(F.col("doc_id").cast("string").alias("chrom"), F.replace("text", F.lit("ß"), F.lit("s")).alias("seq"))
    return _named(omics.dna_window(omics.dna_chunks(seq, 64), "3", 100, 300))


@query("SELECT window_id, track FROM profile", *MAPPED, *ALL_WINDOWS[1:], IDS, PROFILE)
def profiles(t: Tables) -> DataFrame:
    return _profile(t)[0]


@query("SELECT track, round(p, 6) AS p, round(weight, 6) AS weight FROM weights", *MAPPED, *ALL_WINDOWS[1:], IDS, PROFILE, WEIGHTS)
def idf_weights(t: Tables) -> DataFrame:
    p, ids = _profile(t)
    return pairs.idf_weights(p, ids, t.mapped().select(F.col("srx").alias("track")).distinct()).select("track", F.round("p", 6).alias("p"), F.round("weight", 6).alias("weight"))


JACCARD = (
    "held := SELECT window_id, chrom, s, track, weight FROM profile JOIN ids USING (window_id) JOIN weights USING (track) WHERE split = 'train'",
    "sizes_of := SELECT window_id, chrom, s, sum(weight) AS size FROM held GROUP BY window_id, chrom, s HAVING count(*) >= 2",
    "met := SELECT a.window_id AS src, b.window_id AS dst, sum(a.weight) AS i FROM held a JOIN held b ON a.track = b.track AND a.window_id <> b.window_id GROUP BY a.window_id, b.window_id",
    "scored := SELECT src, dst, round(i / (x.size + y.size - i), 6) AS score FROM met JOIN sizes_of x ON x.window_id = src JOIN sizes_of y ON y.window_id = dst WHERE x.chrom <> y.chrom OR abs(x.s - y.s) > 20000",
    "top := SELECT src, dst, score, row_number() OVER (PARTITION BY src ORDER BY score DESC, md5('0:' || src::VARCHAR || ':' || dst::VARCHAR))::INTEGER AS rank FROM scored WHERE score >= 0.12",
)


def _pairs(t: Tables, profile: tuple[DataFrame, DataFrame] | None = None, **more: int) -> DataFrame:
    p, ids = profile or _profile(t)
    return pairs.similar_pairs(p, ids, pairs.idf_weights(p, ids), threshold=0.12, max_pairs=8, min_separation=20000, **more)


@query("SELECT src, dst, score, rank FROM top WHERE rank <= 8", *MAPPED, *ALL_WINDOWS[1:], IDS, PROFILE, WEIGHTS, *JACCARD)
def jaccard_pairs_topk(t: Tables) -> DataFrame:
    return _pairs(t)


@query("SELECT src, list(dst ORDER BY rank) AS indices, list(score ORDER BY rank) AS scores FROM top WHERE rank <= 8 GROUP BY src", *MAPPED, *ALL_WINDOWS[1:], IDS, PROFILE, WEIGHTS, *JACCARD)
def pairs_csr(t: Tables) -> DataFrame:
    return pairs.pairs_csr(_pairs(t))


@query("SELECT row_number() OVER (ORDER BY window_id) - 1 AS row, window_id, (sum(n) OVER (ORDER BY window_id) - n)::BIGINT AS begin, (sum(n) OVER (ORDER BY window_id))::BIGINT AS end FROM (SELECT window_id, count(src) AS n FROM ids LEFT JOIN (SELECT src FROM top WHERE rank <= 8) ON src = window_id WHERE split = 'train' GROUP BY window_id)", *MAPPED, *ALL_WINDOWS[1:], IDS, PROFILE, WEIGHTS, *JACCARD)
def pairs_indptr(t: Tables) -> DataFrame:
    """Where each training window's neighbours lie in the compressed pair table, with none for windows without any."""
    profile = _profile(t)
    return pairs.csr(_pairs(t, profile), profile[1].filter("split = 'train'"))[0]


CHROM_RUNS = "chrom_runs := " + fx.max_runs_sql("mapped", "chrom")
LEAST = "SELECT p.chrom, p.s, p.e, CASE WHEN coalesce((SELECT sum(least(p.e, r.e) - greatest(p.s, r.s)) FROM chrom_runs r WHERE r.chrom = p.chrom AND r.s < p.e AND r.e > p.s), 0) = p.e - p.s THEN (SELECT min(value) FROM chrom_runs r WHERE r.chrom = p.chrom AND r.s < p.e AND r.e > p.s) ELSE 0 END AS least FROM (SELECT DISTINCT chrom, s, e FROM peaks) p"


@query(LEAST, *MAPPED, CHROM_RUNS)
def min_over(t: Tables) -> DataFrame:
    return _named(iv.min_over(t.peaks().select("chrom", "start", "end").distinct(), iv.max_runs(t.mapped(), ["chrom"], value="score")))


@query("SELECT m.chrom, count(*) AS peaks, count(*) FILTER (score >= 1900) AS lost FROM mapped m GROUP BY m.chrom", *MAPPED)
def round_trip(t: Tables) -> DataFrame:
    """Tracks that lack the highest peaks: just these are found lost."""
    return verify.round_trip(t.mapped(), iv.max_runs(t.mapped().filter("score < 1900"), ["chrom"], value="score"), ["chrom"])


@query("SELECT antigen, count(*) AS runs, count(*) FILTER (value >= 1900) AS above_pan FROM tissue_runs GROUP BY antigen", *MAPPED, RUNS)
def pan_dominance(t: Tables) -> DataFrame:
    """A pan track that lacks the highest runs: just these are found above it."""
    runs = checkpointed(_runs(t))
    return verify.pan_dominance(runs, iv.max_runs(runs.filter("value < 1900"), ["antigen", "chrom"]), ["antigen"])


@query("SELECT chrom, count(*) FILTER (s < ahead) AS out_of_order, count(*) AS rows FROM (SELECT chrom, s, lag(s) OVER (PARTITION BY chrom ORDER BY srx, s, e, score) AS ahead FROM peaks) GROUP BY chrom", "peaks")
def out_of_order(t: Tables) -> DataFrame:
    return iv.out_of_order(t.peaks(), ["chrom"], ["srx", "start", "end", "score"])


@query("SELECT 'conserved' AS name, (count(*) = count(*) FILTER (group_id IS NULL) + count(group_id)) AS ok, count(*) AS rows_in, count(*) FILTER (group_id IS NULL) AS unmapped, count(group_id) AS rows_out FROM resolved", "peaks", "experiments", GROUPS, LOOKUP, RESOLVED)
def conservation(t: Tables) -> DataFrame:
    c = peaks.conservation(_resolved(t))
    return c.select(F.lit("conserved").alias("name"), (F.col("rows_in") - F.col("unmapped") == F.col("rows_out")).alias("ok"), "rows_in", "unmapped", "rows_out")


@query("SELECT tissue, chrom, s, e FROM (SELECT tissue, chrom, least(x, len) AS s, least(x + 4096, len) AS e, x // 4096 AS chunk FROM tissues, (SELECT *, unnest(range(0, len, 4096)) AS x FROM sizes)) g WHERE NOT EXISTS (SELECT 1 FROM chunked c WHERE c.tissue = g.tissue AND c.chrom = g.chrom AND c.chunk = g.chunk)", *MAPPED, "sizes", RUNS, CHUNKED, TISSUES)
def missing_chunks(t: Tables) -> DataFrame:
    return _named(verify.missing_chunks(_omics(t), windows.chunk_grid(t.sizes(), CHUNK), t.experiments().select(F.col("ct_class").alias("tissue")).distinct(), CHUNK))


# tables written in the engine's formats and read back


@query("SELECT chrom, count(*) AS bad FROM peaks GROUP BY chrom", "peaks")
def bad_peak_lines(t: Tables) -> DataFrame:
    path, p = scratch(t.spark, "bed4"), t.peaks()
    p.select(F.explode(F.array(F.concat_ws("\t", *p.columns), F.concat_ws("\t", "chrom", "start", "end", "srx"))).alias("value"), "chrom").write.partitionBy("chrom").text(path)
    bad = readers.read_peaks(t.spark, path, numbered=True).filter("bad")
    return bad.groupBy(F.regexp_extract("line_no.path", "chrom=([^/]+)", 1).alias("chrom")).agg(F.count("*").alias("bad"))


@query("SELECT srx, org, ag_class, antigen, ct_class, celltype FROM experiments", "experiments")
def live_list_scan(t: Tables) -> DataFrame:
    path, names = scratch(t.spark, "list"), readers.EXPERIMENT
    whole = F.concat_ws("\t", *names, F.lit('a "title'), F.lit("more"))
    t.experiments().select(F.explode(F.array(whole, F.concat_ws("\t", *names[:5]))).alias("value")).write.text(path)  # every second line is too short
    return readers.read_live_list(t.spark, path).drop("line_no")


@query("SELECT ct_class, antigen, chrom, s, e, value FROM tissue_runs WHERE chrom IN ('chr2', 'chr5')", *MAPPED, RUNS)
def track_scan(t: Tables) -> DataFrame:
    path = scratch(t.spark, "tracks")
    sinks.write_tracks(_runs(t), path, ("ct_class", "antigen"), text=f"{path}-text")
    return _named(readers.read_track(t.spark, f"{path}-text", ["chr2", "chr5"]))


@query("SELECT ct_class, antigen, chrom, s, e, value FROM tissue_runs", *MAPPED, RUNS)
def tracks_stored(t: Tables) -> DataFrame:
    path = scratch(t.spark, "tracks")
    sinks.write_tracks(_runs(t), path, ("ct_class", "antigen"))
    return _named(t.spark.read.parquet(path))


@query("SELECT chrom, s, e FROM n_runs", "n_intervals", MERGED_N)
def runs_scan(t: Tables) -> DataFrame:
    path, lines = scratch(t.spark, "bed3"), t.n_intervals().select(F.concat_ws("  ", "chrom", "start", "end", F.lit("label")).alias("value"))
    odd = t.spark.createDataFrame([(x,) for x in ("# chr1 1 60000", "track chr1 1", "browser position chr1", "", "chr1 5")], "value string")
    lines.union(odd).write.text(path)
    return _named(readers.read_runs(t.spark, path))


@query(r"SELECT doc_id::VARCHAR AS chrom, len(regexp_replace(replace(coalesce(text, ''), '>', ''), '[\s\x0B]', '', 'g'))::BIGINT AS len FROM documents")
def fasta_scan(t: Tables) -> DataFrame:
    return _fasta(t).records


def _fasta(t: Tables) -> readers.Fasta:
    """The documents as records of a FASTA file, with the lines that they have."""
    path = scratch(t.spark, "fasta")
    body = F.replace(F.coalesce("text", F.lit("")), F.lit(">"), F.lit(""))
    t.read("documents").select(F.concat(F.lit(">"), F.col("doc_id").cast("string"), F.lit(" a record\n"), F.replace(body, F.lit("ß"), F.lit("s"))).alias("value")).write.text(path)
    return readers.Fasta(t.spark, path)


BASES = r"bases := SELECT doc_id::VARCHAR AS chrom, regexp_replace(replace(replace(coalesce(text, ''), '>', ''), 'ß', 's'), '[\s\x0B]', '', 'g') AS seq FROM documents"
PIECES = "pieces := SELECT chrom, x AS s, least(x + 256, len(seq))::BIGINT AS e, upper(substring(seq, x + 1, 256)) AS dna FROM (SELECT *, unnest(range(0, len(seq), 256)) AS x FROM bases)"


@query("SELECT chrom, s, e, dna FROM pieces", BASES, PIECES)
def fasta_chunks(t: Tables) -> DataFrame:
    """Chunks of sequences that are read line by line."""
    return _named(omics.dna_chunks(_fasta(t).pieces, 256))


@query("""SELECT chrom, min(i) - 1 AS s, max(i) AS e FROM (SELECT chrom, i, i - row_number() OVER (PARTITION BY chrom ORDER BY i) AS g FROM (
    SELECT chrom, generate_subscripts(c, 1) AS i, unnest(c) AS ch FROM (SELECT chrom, string_split(seq, '') AS c FROM bases)) WHERE ch IN ('n', 'N')) GROUP BY chrom, g""", BASES)
def fasta_n_runs(t: Tables) -> DataFrame:
    return _named(iv.n_runs_of_pieces(_fasta(t).pieces))


@query("SELECT chrom, s, e, dna, s % 3 <> 0 AS adopted FROM pieces", BASES, PIECES)
def dna_adopted(t: Tables) -> DataFrame:
    """Chunks of which a donor has two of three; the others are cut."""
    sequences = _fasta(t).pieces
    grid = windows.chunk_grid(readers.chrom_sizes(sequences), 256)
    return _named(omics.dna_with_donor(sequences, grid, checkpointed(omics.dna_chunks(sequences, 256).filter("start % 3 <> 0")), 256))


@query("SELECT chrom, len(seq)::BIGINT AS len FROM bases WHERE seq <> ''", BASES)
def sizes_from_names(t: Tables) -> DataFrame:
    """Lengths from the names of a tree of chunk files, whose bodies are not read."""
    path = scratch(t.spark, "dna-tree")
    sinks.write_dna_tree(omics.dna_chunks(_fasta(t).pieces, 4096), path)
    return readers.sizes_from_names(t.spark, path)


@query("SELECT chrom, s, e, dna FROM (SELECT chrom, x AS s, least(x + 4096, len(seq))::BIGINT AS e, upper(substring(seq, x + 1, 4096)) AS dna FROM (SELECT *, unnest(range(0, len(seq), 4096)) AS x FROM bases))", BASES)
def dna_tree(t: Tables) -> DataFrame:
    path = scratch(t.spark, "dna-tree")
    sinks.write_dna_tree(omics.dna_chunks(_fasta(t).pieces, 4096), path)
    return _named(readers.read_dna_tree(t.spark, path))


SLUG = "regexp_replace({0}, '[^A-Za-z0-9._+-]+', '_', 'g')"


@query(f"SELECT ct_class AS tissue, antigen AS name, min({SLUG.format('ag_class')}) AS ag_class, count(*) AS n_classes FROM (SELECT DISTINCT ag_class, ct_class, antigen FROM mapped) GROUP BY ct_class, antigen", *MAPPED)
def signal_files(t: Tables) -> DataFrame:
    """A tree of track files, found again by tissue and name whatever their spelling on disk; the first class counts."""
    path = scratch(t.spark, "signal")
    sinks.write_signal_tree(t.mapped().groupBy("ag_class", "ct_class", "antigen").agg(F.min("chrom").alias("chrom"), F.min("start").alias("start"), F.max("end").alias("end"), F.max("score").alias("value")), path)
    catalog, x = readers.signal_catalog(t.spark, path), t.experiments()
    found = vocab.signal_files(catalog, x.select(F.col("antigen").alias("name"), F.lit(None).cast("string").alias("alias")).distinct(), x.select(F.col("ct_class").alias("tissue")))
    n = catalog.groupBy("tissue", "stem").agg(F.count("*").alias("n_classes")).withColumnsRenamed({"tissue": "_t", "stem": "_s"})
    return found.join(n, (names.slugify(F.col("tissue")) == F.col("_t")) & (names.slugify(F.col("name")) == F.col("_s"))).select("tissue", "name", "ag_class", "n_classes")


@query("SELECT chrom, count(*) FILTER (s < ahead) AS out_of_order, count(*) AS rows FROM (SELECT chrom, s, lag(s) OVER (PARTITION BY chrom ORDER BY srx, s, e, score) AS ahead FROM peaks) GROUP BY chrom", "peaks")
def stored_order(t: Tables) -> DataFrame:
    """Files in the order of accessions, a chromosome's one after the other, audited as they lie on disk."""
    path, p = scratch(t.spark, "beds"), t.peaks()
    p.withColumn("k", F.col("chrom")).repartitionByRange("k", "srx", "start", "end", "score").sortWithinPartitions("k", "srx", "start", "end", "score").write.partitionBy("k").option("sep", "\t").csv(path)
    found = readers.stored_order(t.spark.read.schema(readers.PEAK).option("sep", "\t").csv(path), folders=True)
    return found.groupBy(F.regexp_extract("path", "k=([^/]+)", 1).alias("chrom")).agg(F.sum("out_of_order").alias("out_of_order"), F.sum("rows").alias("rows"))


@query("SELECT 2 * count(*) AS rows_in, count(*) AS bad_rows, count(*) FILTER (group_id IS NULL) AS unmapped, count(group_id) AS rows_out, 0::BIGINT AS lost FROM resolved", "peaks", "experiments", GROUPS, LOOKUP, RESOLVED)
def build_counts(t: Tables) -> DataFrame:
    """What a build of tracks counts while it writes them: lines of which every second is malformed."""
    path, p, counts = scratch(t.spark, "bed5"), t.peaks(), build.PeakCounts()
    p.select(F.explode(F.array(F.concat_ws("\t", *p.columns), F.concat_ws("\t", "chrom", "start"))).alias("value")).write.text(path)
    runs = build.build_tracks(readers.read_peaks(t.spark, path), t.experiments(), "hg38", counts=counts)[2]
    sinks.write_tracks(runs, scratch(t.spark, "tracks"))
    return t.spark.createDataFrame([counts.result()], "rows_in long, bad_rows long, unmapped long, rows_out long, lost long")


@query("SELECT srx, group_id FROM lookup", "experiments", GROUPS, LOOKUP)
def dedupe_over_files(t: Tables) -> DataFrame:
    """Of a list in several files, whose later ones name other antigens, an accession's first line in the order of files counts."""
    path, x = scratch(t.spark, "lists"), t.experiments()
    line = lambda antigen: F.concat_ws("\t", "srx", "org", "ag_class", antigen, "ct_class", "celltype")
    both = x.select(F.explode(F.array(F.struct(F.lit(1).alias("part"), line("antigen").alias("value")), F.struct(F.lit(2).alias("part"), line(F.lit("Brand#1")).alias("value")))).alias("l")).select("l.*")
    both.write.partitionBy("part").text(path)
    return peaks.accession_lookup(readers.read_live_list(t.spark, path), peaks.group_table(x))


@query("SELECT chrom, s, e, srx, score FROM mapped", *MAPPED)
def group_beds(t: Tables) -> DataFrame:
    path = scratch(t.spark, "beds")
    sinks.write_group_beds(t.mapped(), path, ("ct_class", "antigen"))
    return _named(readers.good_peaks(readers.read_peaks(t.spark, path)))


@query("SELECT group_id, ag_class, antigen, ct_class, n_experiments FROM groups", "experiments", GROUPS)
def groups_stored(t: Tables) -> DataFrame:
    path, columns = scratch(t.spark, "groups"), ["group_id", "ag_class", "antigen", "ct_class", "n_experiments"]
    peaks.group_table(peaks.experiments_of(t.experiments(), "hg38")).select(*columns, "path").write.option("sep", "\t").option("header", True).csv(path)
    return readers.read_groups(t.spark, path).select(*columns)


@query("SELECT srx, group_id FROM lookup", "experiments", GROUPS, LOOKUP)
def lookup_stored(t: Tables) -> DataFrame:
    path, x = scratch(t.spark, "lookup"), t.experiments()
    sinks.write_lookup(peaks.accession_lookup(x, peaks.group_table(x)), path)
    return readers.read_lookup(t.spark, path)


@query('SELECT tissue, chrom, chunk, chrom AS "Chromosome", s AS "Start", e AS "End", value AS "Name", antigen AS feature_name FROM chunked', *MAPPED, RUNS, CHUNKED)
def omics_stored(t: Tables) -> DataFrame:
    path = scratch(t.spark, "omics")
    sinks.write_omics(_omics(t), path)
    return readers.read_omics(t.spark, path)


@query("SELECT tissue, chrom, chunk, count(*) AS rows, min(s) AS least_start, max(e) AS most_end FROM chunked GROUP BY tissue, chrom, chunk", *MAPPED, RUNS, CHUNKED)
def omics_footers(t: Tables) -> DataFrame:
    """The stored signal's row groups, one a chunk, from the files' footers alone."""
    path = scratch(t.spark, "omics")
    sinks.write_omics(_omics(t), path)
    groups = files.footers(t.spark, path).select("tissue", "chrom", F.explode(F.arrays_zip("listed", "groups")).alias("g"))
    return groups.select("tissue", "chrom", F.col("g.listed").alias("chunk"), "g.groups.rows", "g.groups.least_start", "g.groups.most_end")


@query("SELECT tissue, chrom, chunk, 'missing chunk' AS fault FROM (SELECT DISTINCT tissue, chrom, chunk FROM chunked) WHERE chunk % 5 = 2", *MAPPED, RUNS, CHUNKED)
def footer_faults(t: Tables) -> DataFrame:
    """Stored signal that lacks every fifth chunk, checked against the tracks."""
    path, omics_rows = scratch(t.spark, "omics"), checkpointed(_omics(t))
    sinks.write_omics(omics_rows.filter("chunk % 5 <> 2"), path, omics_rows.select("tissue", "chrom").distinct())
    return verify.footer_faults(files.footers(t.spark, path), omics_rows.select("tissue", "chrom", "chunk").distinct(), CHUNK)


@query("SELECT chrom, s, e, split FROM labelled", *ALL_WINDOWS)
def windows_stored(t: Tables) -> DataFrame:
    path = scratch(t.spark, "windows")
    sinks.write_windows(_labelled(t), path)
    return _named(t.spark.read.parquet(path))


@query("SELECT chrom, len FROM sizes", "peaks", "sizes")
def sizes_stored(t: Tables) -> DataFrame:
    path = scratch(t.spark, "sizes")
    sinks.write_chrom_sizes(t.sizes(), path)
    return readers.read_chrom_sizes(t.spark, path)


from genoweave import release_queries  # noqa: E402, F401  registers more, with what is defined above
