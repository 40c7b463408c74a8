"""Files, names, vocabularies and a whole toy release with faults."""

from __future__ import annotations

import gzip
import json
import pickle
import random
import zipfile
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from genoweave.functions import names
from genoweave.operators import omics, pairs, peaks, vocab, windows
from genoweave.plans import build, release, verify
from genoweave.sources import files as stored_files
from genoweave.sources import readers, sinks

LENS = {"chr1": 400_000, "chr8": 300_000, "chr9": 120_000}


def test_names(spark):
    odd = [None, "", "-", "N/A", "   ", " x ", "CD4/CD8", "CD4 CD8", "TF (isoform 2)", "α-tubulin", "a  b", "._x_.", "é à", "ﬁ", "Unclassified", " x "]
    df = spark.createDataFrame([(x,) for x in odd], "x string")
    for r in df.select("x", names.slugify(F.col("x")).alias("s"), names.normalise(F.col("x")).alias("n")).collect():
        assert r.s == names.slug_text(r.x) and r.n == ("NA" if (r.x or "").strip() in ("", "-", "N/A") else r.x.strip())
    assert names.slug_text("CD4/CD8") == names.slug_text("CD4 CD8") == "CD4_CD8" and names.slug_text("α-tubulin") == "-tubulin" and names.slug_text("é à") == "e_a"
    assert names.parse_size("512M") == 512 << 20 and names.parse_size("7") == 7 and [names.check_release_id(x) for x in ("2024-06-01", "v2", "2026Q1")] == ["2024-06-01", "v2", "2026Q1"]
    for bad in ("x", "1.5G", ""):
        with pytest.raises(ValueError):
            names.parse_size(bad)
    for bad in ("../x", ".x", "a/b", "a b", "v2\n", ""):
        with pytest.raises(ValueError):
            names.check_release_id(bad)
    got = df.limit(1).select(names.signal_file_parts(F.lit("05.H3.K27ac.AllCell.bed")).alias("a"), names.signal_file_parts(F.lit("x.bed")).alias("b")).first()
    assert tuple(got.a) == ("05", "H3.K27ac", "AllCell") and got.b is None


def test_readers(spark, tmp_path):
    live = tmp_path / "experimentList.tab"
    live.write_bytes(b"SRX1\thg38\tHistone\tH3K27ac\tBlood\tK562\tt\xe9\x91st\tmore\t\tx\nSRX2\thg38\tHistone\tCTCF\tLiver\tHep\nshort\ta\tb\nSRX3\tmm10\tTFs\t\"q\tNA\t-\t\x92\n")
    df = readers.read_live_list(spark, str(live))
    assert [(r.srx, r.antigen, r.celltype) for r in df.orderBy("line_no").collect()] == [("SRX1", "H3K27ac", "K562"), ("SRX2", "CTCF", "Hep"), ("SRX3", '"q', "-")]
    with zipfile.ZipFile(tmp_path / "experiment_list.zip", "w") as z:
        z.writestr("list.csv", "Experimental ID,a,b,c,d,e,Title\nSRX9,hg38,Histone,NA,Blood,,t\n")
    assert [tuple(r)[1:] for r in readers.read_bundled_zip(spark, str(tmp_path / "experiment_list.zip")).collect()] == [("SRX9", "hg38", "Histone", "NA", "Blood", "")]
    assert readers.read_experiment_list(spark, str(tmp_path)).count() == 3 and readers.read_experiment_list(spark, str(tmp_path), "bundled").count() == 1
    with pytest.raises(ValueError):
        readers.read_experiment_list(spark, str(tmp_path), "other")
    bed = tmp_path / "p.bed.gz"
    bed.write_bytes(gzip.compress(b"chr1\t5\t9\tSRX1\t10\nchr1\t5\t9\tSRX1\nchr1\t\t9\t\t7\nchr1\t1\t2\tx\t3\t4\n"))
    rows = readers.read_peaks(spark, str(bed))
    assert readers.bad_rows(rows) == 2 and sorted(map(tuple, readers.good_peaks(rows).collect()), key=str) == [("chr1", 5, 9, "SRX1", 10), ("chr1", None, 9, "", 7)]
    (tmp_path / "bad.bed").write_text("chr1\tx\t9\tSRX1\t10\n")
    with pytest.raises(Exception, match="not a number"):
        readers.good_peaks(readers.read_peaks(spark, str(tmp_path / "bad.bed"))).collect()
    (tmp_path / "r.bed").write_text("# c\ntrack x\nbrowser y\n\nchr1  5 10 label\nchr1\t10\t12\nchr2 1\nchr2 1 3\n")
    assert sorted(map(tuple, readers.read_runs(spark, str(tmp_path / "r.bed")).collect())) == [("chr1", 5, 12), ("chr2", 1, 3)]
    assert readers.read_runs(spark, str(tmp_path / "r.bed"), ["chr2"]).count() == 1
    (tmp_path / "g.fa").write_text(">chr1 some text\nACGT\nNN\n>chr2\nA\n")
    assert sorted(map(tuple, readers.Fasta(spark, str(tmp_path / "g.fa")).records.collect())) == [("chr1", 6), ("chr2", 1)]
    (tmp_path / "s.pkl").write_bytes(pickle.dumps({"chr1": "ACGTN"}))
    assert readers.chrom_sizes(readers.read_sequence_pickle(spark, str(tmp_path / "s.pkl"), trusted=True)).first().len == 5
    with pytest.raises(ValueError, match="trusted"):
        readers.read_sequence_pickle(spark, str(tmp_path / "s.pkl"))
    (tmp_path / "f.json").write_text(json.dumps({"features": ["b", "a"]}))
    assert [tuple(r) for r in readers.read_feature_list(spark, str(tmp_path / "f.json")).orderBy("idx").collect()] == [(0, "b"), (1, "a")]
    (tmp_path / "groups.tsv").write_text("group_id\tag_class\tantigen\tct_class\tn_experiments\tpath\n0\tHistone\tNA\tBlood\t3\tx\n")
    assert readers.read_groups(spark, str(tmp_path / "groups.tsv")).first().antigen == "NA"
    (tmp_path / "groups.tsv").write_text("group_id\tag_class\tantigen\tct_class\tn_experiments\tpath\n0\t\tNA\tBlood\t3\tx\n")
    with pytest.raises(ValueError):
        readers.read_groups(spark, str(tmp_path / "groups.tsv"))
    (tmp_path / "list.tab").write_text("His.Bld.05.AllAg.AllCell\thg38\tHistone\t-\tBlood\t-\nXXX.Bld.10.AllAg.AllCell\thg38\tHistone\t-\tBlood\t-\nOth.Bld.05.CTCF.AllCell\thg38\tOther\t-\tB\t-\nshort\n")
    codes = vocab.class_codes(readers.read_class_list(spark, str(tmp_path / "list.tab")))
    assert sorted(map(tuple, codes.collect())) == [("antigen", "Histone", "His"), ("tissue", "Blood", "Bld")]


def test_groups_and_beds(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, f"SRX{i}", "hg38", rng.choice(["Histone", "TFs and others"]), rng.choice(["A", "B/C", "N/A"]), rng.choice(["Blood", "Liver"]), "c") for i in range(60)]
    rows += [(60, "SRX1", "hg38", "Histone", "Z", "Liver", "c"), (61, "SRX90", "mm10", "Histone", "A", "Liver", "c")]
    x = peaks.experiments_of(spark.createDataFrame(rows, "line_no long, srx string, org string, ag_class string, antigen string, ct_class string, celltype string"), "hg38")
    groups = peaks.group_table(x)
    assert groups.agg(F.sum("n_experiments")).first()[0] == 61 and groups.filter("antigen = 'NA'").count() > 0 and peaks.path_collisions(groups).isEmpty()
    lookup = peaks.accession_lookup(x, groups)
    assert lookup.count() == 60 and lookup.filter("srx = 'SRX1'").join(groups, "group_id").first().antigen != "Z"
    with pytest.raises(ValueError):
        peaks.experiments_of(x, "rn6")
    both = x.withColumn("antigen", F.when(F.col("line_no") % 2 == 0, "B C").otherwise("B/C"))
    with pytest.raises(ValueError, match="share"):
        build.build_tracks(spark.createDataFrame([], readers.PEAK), both, "hg38")
    found = [("chr%d" % rng.randint(1, 3), s, s + 50, rng.choice([f"SRX{rng.randint(0, 59)}", "SRX9999999"]), 5) for s in (rng.randrange(5000) for _ in range(500))]
    groups, resolved, _ = build.build_tracks(spark.createDataFrame(found, readers.PEAK), x, "hg38")
    counts = peaks.conservation(resolved).first()
    assert counts.rows_in == 500 and counts.unmapped == sum(p[3] == "SRX9999999" for p in found)
    mapped = resolved.filter("group_id IS NOT NULL").join(groups.drop("path", "n_experiments"), "group_id")
    sinks.write_group_beds(mapped, str(tmp_path / "beds"))
    lines = [line for f in sorted((tmp_path / "beds").rglob("*.csv")) for line in [f.read_text().splitlines()]]
    assert sum(map(len, lines)) == counts.rows_out
    for file in lines:
        keys = [(c, int(s)) for c, s, *_ in (line.split("\t") for line in file)]
        assert keys == sorted(keys)


def toy(spark, tmp_path):
    rng = random.Random(7)
    tracks, rows = [], []
    for t in ("Blood", "Liver", "Neural"):
        for a in range(8):
            cls = "Histone" if a % 3 == 0 else "TFs and others"
            rows.append((cls, f"AG{a:03d}", t))
            tracks += [(cls, t, f"AG{a:03d}", c, s, s + rng.randint(200, 2999), rng.randint(50, 3999)) for c in ("chr1", "chr8") for s in (rng.randrange(LENS[c] - 3000) for _ in range(20))]
    rows += [("Input control", "IC", t) for t in ("Blood", "Liver", "Neural")] + [("Histone", "LONELY", "Blood"), ("Histone", "Epitope_tags", "Liver")]
    groups = spark.createDataFrame([(i, *r, 1, "p") for i, r in enumerate(rows)], "group_id int, ag_class string, antigen string, ct_class string, n_experiments long, path string")
    runs = peaks.max_runs(spark.createDataFrame(tracks, "ag_class string, ct_class string, antigen string, chrom string, start long, end long, value int"), ["ag_class", "ct_class", "antigen", "chrom"])
    seq = {c: "".join(rng.choices("ACGT", k=n)) for c, n in LENS.items()}
    seq = {c: s[:50_000] + "N" * 20_000 + s[70_000:] for c, s in seq.items()} | {"chrUn_1": "ACGT"}
    sequences = spark.createDataFrame(list(seq.items()), "chrom string, seq string")
    black = spark.createDataFrame([("chr1", 120_000, 130_000), ("chr8", 10_000, 11_000)], "chrom string, start long, end long")
    made = release.Release.create(spark, str(tmp_path), "hg38", "2024-06-01")
    checks = build.build_release(made, groups, runs, sequences, black, sizes=(8192, 65536), block=65536, min_antigens=5, min_tissues=3, pair_options={"min_separation": 20_000, "threshold": 0.1})
    return made, checks, seq, runs


def test_a_whole_release(spark, tmp_path):
    made, checks, seq, runs = toy(spark, tmp_path)
    assert all(ok for _, _, ok in checks), checks
    opened = release.Release.open(spark, str(tmp_path), "hg38")
    opened.require("adopt", "genome", "vocab", "intervals", "chunks", "pairs", "verify")
    release.promote(spark, str(tmp_path), "hg38", "2024-06-01")
    assert release.resolve_release(spark, str(tmp_path), "hg38") == "2024-06-01"
    with pytest.raises(FileExistsError):
        release.Release.create(spark, str(tmp_path), "hg38", "2024-06-01")
    with pytest.raises(FileNotFoundError):
        release.resolve_release(spark, str(tmp_path), "hg38", "2020-01-01")
    with pytest.raises(RuntimeError):
        opened.require("nothing")
    assert opened.features() == [f"AG{a:03d}" for a in range(8)] and len(opened.tissues()) == 4 and set(opened.availability()) == {"Blood", "Liver", "Neural", "All cell types"}
    assert opened.dna("chr1", 65_000, 140_000).first().dna == seq["chr1"][65_000:140_000]
    w = opened.windows(8192)
    assert {r.split for r in w.filter("chrom IN ('chr8', 'chr9')").select("split").distinct().collect()} == {"val"} and w.filter("chrom = 'chr1' AND start < 130000 AND end > 120000").isEmpty()
    assert opened.windows(8192, split="val", tissue="Blood").count() == w.filter("split = 'val' AND tissue = 'Blood'").count() > 0
    # nested: a small window lies in the split of the large one that holds it
    large, small = opened.windows(65536).select("chrom", "start", "end", "split").distinct(), w.select("chrom", "start", "end", "split").distinct()
    both = small.alias("s").join(large.alias("l"), F.expr("s.chrom = l.chrom AND s.start >= l.start AND s.end <= l.end AND l.start % 65536 = 0"))
    assert both.filter("s.split <> l.split").isEmpty() and both.count() > 0
    rows = opened.load_window("Blood", "chr1", 65_536, 131_073).collect()
    wanted = [r for r in runs.filter("ct_class = 'Blood' AND chrom = 'chr1'").collect() for c in (1, 2) if r.end > c * 65536 and r.start < (c + 1) * 65536]
    assert sorted((r.Start, r.End, r.Name, r.feature_name) for r in rows) == sorted((r.start, r.end, r.value, r.antigen) for r in wanted)
    assert opened.load_chunk("Blood", "chr9", 0).isEmpty() and opened.empty_omics().columns == opened.load_chunk("Blood", "chr9", 0).columns

    # pairs against brute force, with windows dropped in between
    ids = pairs.window_ids(w)
    loci = ids.collect()
    signal = opened.table("omics").filter("tissue <> 'All cell types'").select("chrom", "Start", "End", "feature_name").distinct().collect()
    prof = {i.window_id: {s.feature_name for s in signal if s.chrom == i.chrom and s.End > i.start and s.Start < i.end} for i in loci}
    train = [i for i in loci if i.split == "train"]
    import math

    weight = {f: math.log(1 / max(min(sum(f in prof[i.window_id] for i in train) / len(train), 1), 1e-4)) for f in opened.features()}
    expected = {}
    for a in train:
        for b in train:
            x, y = prof[a.window_id], prof[b.window_id]
            if min(len(x), len(y)) >= 2 and not (a.chrom == b.chrom and abs(a.start - b.start) <= 20_000):
                union = sum(weight[f] for f in x | y)
                s = round(sum(weight[f] for f in x & y) / union, 6) if union else 0
                if s >= 0.1:
                    expected[a.window_id, b.window_id] = s
    stored = {(r.src, r.dst): r.score for r in spark.read.parquet(opened.path("pairs") + "/pairs").collect()}
    assert stored.keys() == expected.keys() and len(stored) > 20 and all(abs(stored[k] - expected[k]) < 2e-6 for k in stored)
    index = pairs.PairIndex(spark.read.parquet(opened.path("pairs") + "/pairs"), ids)
    src = index.sources().first().src
    assert [r.rank for r in index.neighbours(src).collect()] == list(range(1, sum(k[0] == src for k in stored) + 1)) and index.interval(src).count() == 1

    # every fault is found
    table, chunk = opened.table("omics"), 65536
    signal = table.select("tissue", "feature_name", "chrom", "Start", "End", "Name").distinct().select("tissue", F.col("feature_name").alias("feature"), "chrom", F.col("Start").alias("start"), F.col("End").alias("end"), F.col("Name").alias("value"))
    assert verify.rederived(table, signal, chunk).isEmpty()
    assert not verify.rederived(table.filter("NOT (tissue = 'Blood' AND chunk = 0)"), signal, chunk).isEmpty()
    assert not verify.misplaced_rows(table.withColumn("chunk", F.col("chunk") + 2), chunk).isEmpty()
    chosen = spark.createDataFrame([("Blood", "AG001"), ("Blood", "GHOST")], "tissue string, antigen string")
    assert [tuple(r) for r in verify.unbacked_vocabulary(chosen, table).collect()] == [("Blood", "GHOST")]
    files = spark.createDataFrame([("Blood", "AG001")], "tissue string, stem string")
    assert verify.unreachable_features(chosen, files).first().antigen == "GHOST"
    dna, grid = opened.table("dna"), opened.table("grid")
    assert verify.dna_faults(dna, grid).isEmpty() and verify.dna_faults(dna.withColumn("dna", F.expr("substring(dna, 2)")), grid).count() == grid.count()
    assert not windows.split_clashes(w.union(w.limit(1).withColumn("split", F.lit("other")))).isEmpty()
    assert not verify.window_faults(w.withColumn("end", F.col("end") + 10**6), spark.read.schema("chrom string, len long").option("sep", "\t").csv(opened.path("sizes"))).isEmpty()
    pan = table.filter("tissue = 'All cell types'").select(F.col("feature_name").alias("antigen"), "chrom", F.col("Start").alias("start"), F.col("End").alias("end"), F.col("Name").alias("value")).distinct()
    each = runs.select("antigen", "chrom", "start", "end", "value")
    assert verify.pan_dominance(each, pan, ["antigen"]).agg(F.sum("above_pan")).first()[0] == 0
    assert verify.pan_dominance(each, pan.withColumn("value", (F.col("value") - 1).cast("int")), ["antigen"]).agg(F.sum("above_pan")).first()[0] > 0
    assert verify.disjoint(pan, ["antigen", "chrom"]).isEmpty() and not verify.disjoint(pan.withColumn("end", F.col("end") + 5000), ["antigen", "chrom"]).isEmpty()

    # the exact file layout, and faults planted in it
    folder = Path(opened.path("omics"))
    one = sorted((folder / "tissue=Blood" / "chrom=chr1").glob("*.parquet"))
    listed = [c for f in one for c in json.loads(pq.read_metadata(f).metadata[b"genoweave:chunks"])]
    assert listed == sorted(set(listed)) and sum(pq.read_metadata(f).num_row_groups for f in one) == len(listed) > 1
    assert [pq.read_metadata(f).num_rows for f in (folder / "tissue=Blood" / "chrom=chr9").glob("*.parquet")] == [0]
    asked = spark.createDataFrame([*map(tuple, table.select("tissue", "chrom", "chunk").distinct().collect()), ("Blood", "chr9", None)], "tissue string, chrom string, chunk long")
    faults = lambda: sorted(((r.tissue, r.chrom, r.chunk, r.fault) for r in verify.footer_faults(stored_files.footers(spark, str(folder)), asked, chunk).collect()), key=str)
    assert faults() == []
    target = next(f for f in one if pq.read_metadata(f).num_row_groups > 1)
    meta, groups = pq.read_metadata(target).metadata, [pq.ParquetFile(target).read_row_group(i) for i in range(pq.read_metadata(target).num_row_groups)]
    own = json.loads(meta[b"genoweave:chunks"])

    def rewrite(kept, names):
        target.with_name(f".{target.name}.crc").unlink(missing_ok=True)
        with pq.ParquetWriter(target, groups[0].schema.with_metadata(None)) as w:
            for g in kept:
                w.write_table(g, row_group_size=len(g))
            w.add_key_value_metadata({b"genoweave:chunks": json.dumps(names).encode()})

    rewrite([*groups, groups[-1]], own)
    assert ("Blood", "chr1", None, "row groups differ from the footer's list") in faults()
    rewrite(groups[:-1], own[:-1])
    assert faults() == [("Blood", "chr1", own[-1], "missing chunk")]
    rewrite(groups, [c + 1000 for c in own])
    assert {f[3] for f in faults()} == {"rows outside the chunk", "missing chunk", "chunk that no run touches"}
    target.unlink()
    assert {f[3] for f in faults()} <= {"missing chunk", "missing file"} and len(faults()) >= len(own)


def test_faults_of_all_sizes_and_of_pan_runs_are_found(spark, tmp_path, monkeypatch):
    made, lowered = windows.build_windows, peaks.pan_tissue

    def faulty(lens, n_runs, black, tissues, size, **how):
        df = made(lens, n_runs, black, tissues, size, **how)
        if size != 65536:
            return df
        first = df.orderBy("chrom", "start", "strand", "tissue").limit(1)
        return df.union(first.withColumn("split", F.lit("other"))).union(first.withColumns({"start": F.lit(10**7), "end": F.lit(2 * 10**7)}).select(df.columns))

    monkeypatch.setattr(windows, "build_windows", faulty)
    monkeypatch.setattr(peaks, "pan_tissue", lambda *a, **how: lowered(*a, **how).withColumn("value", (F.col("value") - 1).cast("int")))
    found, checks, _, runs = toy(spark, tmp_path)
    assert {name for name, _, ok in checks if not ok} == {"windows of 65536 lie in their chromosome", "a locus of 65536 has one split", "pan runs reach those of all tissues"}
    assert {"every feature is reachable", "tissues and chromosomes with signal have rows"} <= {name for name, _, _ in checks} and not found.has("verify")
    with pytest.raises(RuntimeError):
        release.promote(spark, str(tmp_path), "hg38", "2024-06-01")
    signal = runs.withColumnRenamed("ct_class", "tissue")
    assert [tuple(r) for r in verify.missing_omics(found.table("omics").filter("NOT (tissue = 'Blood' AND chrom = 'chr8')"), signal).collect()] == [("Blood", "chr8")]


def test_vocabulary(spark):
    rng = random.Random(3)
    held = {(f"T{rng.randint(0, 9)}", f"A{rng.randint(0, 19)}") for _ in range(110)}
    kept, rounds = vocab.select(spark.createDataFrame(sorted(held), "tissue string, antigen string"), 6, 4)
    expected, n = set(held), 0
    while True:
        n += 1
        before = len(expected)
        expected = {p for p in expected if sum(q[0] == p[0] for q in expected) >= 6}
        expected = {p for p in expected if sum(q[1] == p[1] for q in expected) >= 4}
        if len(expected) == before:
            break
    assert {tuple(r) for r in kept.collect()} == expected and rounds == n
    present = spark.createDataFrame([("T1", x) for x in ("H2A.X", "RNA polymerase II", "h2b.a", "H2B.A", "new", "AG1")], "tissue string, antigen string")
    frozen = spark.createDataFrame(vocab.ordered(["H2APERIODX", "RNA_polymerase_II", "H2BPERIODA", "AG1", "gone"]), "idx int, name string")
    aliases = vocab.resolve_aliases(frozen, present)
    assert {r.name: (r.alias, r.n) for r in aliases.collect()} == {"H2APERIODX": ("H2A.X", 1), "RNA_polymerase_II": ("RNA polymerase II", 1), "H2BPERIODA": (None, 2)}
    found = vocab.apply_freeze(present, frozen, aliases, 2)
    assert [r.name for r in found["vanished"].collect()] == ["H2BPERIODA", "gone"] and [r.antigen for r in found["appeared"].collect()] == ["H2B.A", "h2b.a", "new"]
    assert sorted(r.idx for r in found["availability"].collect()) == [0, 1, 3] and found["thin"].isEmpty()
    catalog = spark.createDataFrame([("H2A.X", "Histone", "p1"), ("H2A.X", "TFs", "p2"), ("AG1", "TFs", "p3")], "stem string, ag_class string, path string")
    files = vocab.signal_files(catalog, spark.createDataFrame([("H2APERIODX", "H2A.X"), ("AG1", None)], "name string, alias string"))
    assert {r.name: r.path for r in files.collect()} == {"H2APERIODX": "p1", "AG1": "p3"}
    with pytest.raises(ValueError, match="slug"):
        vocab.signal_files(catalog, spark.createDataFrame([("a b", None), ("a/b", None)], "name string, alias string"))
    codes = spark.createDataFrame([("tissue", "Blood", "Bld")], "kind string, name string, code string")
    assert sorted(r.t for r in vocab.rename_codes(spark.createDataFrame([("Bld",), ("Xyz",)], "t string"), codes, "t", "tissue").collect()) == ["Blood", "Xyz"]
    with pytest.raises(ValueError, match="blank"):
        vocab.candidate_pairs(spark.createDataFrame([("", "a", "b")], "ag_class string, antigen string, ct_class string"))


def test_grids(spark):
    for length, size in ((100, 10), (105, 10), (7, 10), (1 << 20, 8192), (248_956_422, 1 << 20)):
        sizes = spark.createDataFrame([("c", length)], "chrom string, len long")
        starts = sorted(r.start for r in windows.window_starts(sizes, size).collect())
        assert starts == (sorted({min(x, length - size) for x in range(0, length, size)}) if length >= size else [0])
        grid = sorted((r.start, r.end) for r in windows.chunk_grid(sizes, size).collect())
        assert grid[0][0] == 0 and grid[-1][1] == length and all(a[1] == b[0] for a, b in zip(grid, grid[1:], strict=False))
    assert omics.dna_chunks(spark.createDataFrame([("c", "acgtnacg")], "chrom string, seq string"), 3).orderBy("start").first().dna == "ACG"
