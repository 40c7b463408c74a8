"""Readers that number lines over files and splits, catalogs, audits, counters, exports and manifests."""

from __future__ import annotations

import json
import random
import threading
from collections import Counter
from contextlib import contextmanager

import pytest

from genoweave.functions.names import slug_text
from genoweave.operators import intervals, omics, pairs, peaks, vocab, windows
from genoweave.plans import build, release
from genoweave.sources import readers, sinks


@contextmanager
def conf(spark, **settings):
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_splits(spark, size: int = 3000):
    return conf(spark, spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes="0", spark__sql__files__minPartitionNum="1")


def test_lines_of_several_files_have_one_order(spark, tmp_path):
    """A later file that is larger, and so is read first, doesn't come first."""
    (tmp_path / "list").mkdir()
    (tmp_path / "list/a.tab").write_text("SRX1\thg38\tHistone\tfirst\tBlood\tx\n")
    more = [f"SRX{i}\thg38\tHistone\tlate\tBlood\tx{'y' * 50}" for i in range(1, 400)]
    (tmp_path / "list/b.tab").write_text("\n".join([*more, "SRX7\thg38\tHistone\tlater\tBlood\tz"]))
    with small_splits(spark):
        df = readers.read_live_list(spark, str(tmp_path / "list"))
        assert df.rdd.getNumPartitions() > 3
        groups = peaks.group_table(df)
        found = peaks.accession_lookup(df, groups).join(groups, "group_id")
        assert {r.srx: r.antigen for r in found.collect()} == {f"SRX{i}": "first" if i == 1 else "late" for i in range(1, 400)}
        lines = df.orderBy("line_no").collect()
    assert [r.srx for r in lines] == ["SRX1", *[f"SRX{i}" for i in range(1, 400)], "SRX7"]


def fasta(path, seed: int = 1) -> dict[str, str]:
    rng = random.Random(seed)
    seqs = {f"chr{k}": "".join(rng.choices("ACGTNnacgt", k=n)) for k, n in enumerate((0, 1, 5000, 61, 60, 12000, 0, 700))}
    seqs["chr5"] = seqs["chr5"][:3000] + "N" * 2500 + seqs["chr5"][5500:]
    text = "stray line\n" + "".join(f">{c} about {c}\r\n" + "".join(s[i : i + 60] + "\n" for i in range(0, len(s), 60)) + ("\n" if n % 2 else "") for n, (c, s) in enumerate(seqs.items()))
    path.write_text(text)
    return seqs


@pytest.mark.parametrize("size", [700, 1 << 27])
def test_fasta_by_lines(spark, tmp_path, size):
    """Records over many splits, and many records in a split."""
    (tmp_path / "fa").mkdir()
    seqs = fasta(tmp_path / "fa/a.fa")
    (tmp_path / "fa/b.fa").write_text(">other x\nACGT" * 1 + "\n" + "AC" * 3000 + "\n")
    seqs["other"] = "ACGT" + "AC" * 3000
    with small_splits(spark, size), conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch="17"):
        found = readers.Fasta(spark, str(tmp_path / "fa"))
        assert {r.chrom: r.len for r in found.records.collect()} == {c: len(s) for c, s in seqs.items()}
        assert "SortMergeJoin" not in found.pieces._jdf.queryExecution().executedPlan().toString()  # lines aren't dealt
        pieces = found.pieces.collect()
        for c, s in seqs.items():
            assert "".join(p.seq for p in sorted((p for p in pieces if p.chrom == c), key=lambda p: p.start)) == s
            assert all(s[p.start : p.start + len(p.seq)] == p.seq for p in pieces if p.chrom == c)
        for chunk in (50, 4096):
            cut = {(r.chrom, r.start, r.end): r.dna for r in omics.dna_chunks(found.pieces, chunk).collect()}
            assert cut == {(c, i, min(i + chunk, len(s))): s[i : i + chunk].upper() for c, s in seqs.items() for i in range(0, len(s), chunk)}
        whole = spark.createDataFrame(list(seqs.items()), "chrom string, seq string")
        assert sorted(map(tuple, intervals.n_runs_of_pieces(found.pieces).collect())) == sorted(map(tuple, intervals.n_runs(whole, ["chrom"]).collect()))
    (tmp_path / "fa/c.fa").write_text(">chr2 again\nA\n")
    with pytest.raises(Exception, match="two records are named chr2"):
        readers.Fasta(spark, str(tmp_path / "fa")).records.collect()


def test_order_of_stored_files(spark, tmp_path):
    rng = random.Random(2)
    (tmp_path / "beds").mkdir()
    expected, stored = {}, []
    for name in ("a", "b", "c"):
        rows = [(f"chr{k}", s) for k in (1, 2) for s in sorted(rng.randrange(10**6) for _ in range(900))]
        if name != "a":
            for _ in range(200 if name == "b" else 1):
                i, j = rng.randrange(len(rows)), rng.randrange(len(rows))
                rows[i], rows[j] = rows[j], rows[i]
        late = sum(x[0] == y[0] and y[1] < x[1] for x, y in zip(rows, rows[1:], strict=False))
        expected[f"{name}.bed"] = (len(rows), late)
        stored.append(rows)
        (tmp_path / f"beds/{name}.bed").write_text("".join(f"{c}\t{s}\t{s + 9}\tSRX1\t5\n" for c, s in rows))
    for size in (700, 1 << 27):
        with small_splits(spark, size), conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch="13"):
            found = readers.stored_order(spark.read.schema(readers.PEAK).option("sep", "\t").csv(str(tmp_path / "beds")))
            assert {r.path.rpartition("/")[2]: (r.rows, r.out_of_order) for r in found.collect()} == expected
            whole = readers.stored_order(spark.read.schema(readers.PEAK).option("sep", "\t").csv(str(tmp_path / "beds")), folders=True)
            seams = sum(a[-1][0] == b[0][0] and b[0][1] < a[-1][1] for a, b in zip(stored, stored[1:], strict=False))
            assert [(r.path.rpartition("/")[2], r.rows, r.out_of_order) for r in whole.collect()] == [("beds", sum(n for n, _ in expected.values()), seams + sum(n for _, n in expected.values()))]


def test_a_large_group_is_written_by_several_tasks(spark, tmp_path):
    rng = random.Random(3)
    rows = [(*(("Histone", "Blood", "A") if rng.random() < 0.9 else ("TFs", "Liver", rng.choice("BC"))), rng.choice(("chr1", "chr2")), s, s + 10, "SRX1", rng.randint(1, 9)) for s in (rng.randrange(10**6) for _ in range(8000))]
    df = spark.createDataFrame(rows, "ag_class string, ct_class string, antigen string, chrom string, start long, end long, srx string, score int")
    with conf(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        sinks.write_group_beds(df, str(tmp_path / "beds"))
        sinks.write_tracks(df.withColumnRenamed("score", "value").drop("srx"), str(tmp_path / "tracks"))
        sinks.write_dna(spark.createDataFrame([("chr1", i * 10, i * 10 + 10, "ACGTACGTAC") for i in range(4000)], "chrom string, start long, end long, dna string"), str(tmp_path / "dna"))
    for part in ("beds", "tracks"):
        files = [f for f in (tmp_path / part).rglob("part-*") if "antigen=A" in str(f)]
        assert len(files) > 1
    assert len(list((tmp_path / "dna").rglob("part-*"))) > 1
    lines = [tuple(line.split("\t")[:2]) for f in sorted((tmp_path / "beds").rglob("part-*")) if "antigen=A" in str(f) for line in f.read_text().splitlines()]
    assert len(lines) == sum(r[0] == "Histone" for r in rows) and lines == sorted(lines, key=lambda x: (x[0], int(x[1]))), "files in name order hold rows in genomic order"


def test_counts_come_without_a_scan(spark, tmp_path):
    x = spark.createDataFrame([(i, f"SRX{i}", "hg38", "Histone", "A", "Blood", "c") for i in range(5)], "line_no long, srx string, org string, ag_class string, antigen string, ct_class string, celltype string")
    rng = random.Random(4)
    lines = [f"chr1\t{s}\t{s + 9}\tSRX{rng.randrange(8)}\t5" + ("\tmore" if rng.random() < 0.1 else "") for s in (rng.randrange(1000) for _ in range(3000))]
    (tmp_path / "p.bed").write_text("\n".join(lines))
    counts = build.PeakCounts()
    _, _, runs = build.build_tracks(readers.read_peaks(spark, str(tmp_path / "p.bed")), x, "hg38", counts=counts)
    assert runs._jdf.queryExecution().executedPlan().toString().count("Scan csv") == 1
    sinks.write_tracks(runs, str(tmp_path / "tracks"))
    good = [line.split("\t")[3] for line in lines if line.count("\t") == 4]
    unmapped = sum(int(srx[3:]) > 4 for srx in good)
    assert counts.result() == {"rows_in": 3000, "bad_rows": 3000 - len(good), "unmapped": unmapped, "rows_out": len(good) - unmapped, "lost": 0}


def test_donor_chunks(spark, tmp_path):
    rng = random.Random(6)
    seqs = {"chr1": "".join(rng.choices("ACGT", k=1050)), "chr2": "".join(rng.choices("acgt", k=300))}
    sequences = spark.createDataFrame(list(seqs.items()), "chrom string, seq string")
    grid = windows.chunk_grid(spark.createDataFrame([(c, len(s)) for c, s in seqs.items()], "chrom string, len long"), 100)
    wanted = {(c, i, min(i + 100, len(s))): s[i : i + 100].upper() for c, s in seqs.items() for i in range(0, len(s), 100)}
    # the last chunk is pulled back in the old tree, one file is cut short, one lies in no chromosome
    old = {k: v for k, v in wanted.items() if k[2] - k[1] == 100 and k != ("chr1", 300, 400)} | {("chr1", 950, 1050): "x" * 100, ("chr1", 300, 400): "ACG", ("chrX", 0, 100): "A" * 100}
    sinks.write_dna_tree(spark.createDataFrame([(*k, v) for k, v in old.items()], "chrom string, start long, end long, dna string"), str(tmp_path / "dna"))
    donor = readers.read_dna_tree(spark, str(tmp_path / "dna"))
    pieces = spark.createDataFrame([(c, i, s[i : i + 37]) for c, s in seqs.items() for i in range(0, len(s), 37)], "chrom string, start long, seq string")
    for given in (sequences, pieces):
        found = {(r.chrom, r.start, r.end): (r.dna, r.adopted) for r in omics.dna_with_donor(given, grid, donor, 100).collect()}
        assert {k: v for k, (v, _) in found.items()} == wanted
        assert {k for k, (_, a) in found.items() if not a} == {("chr1", 300, 400), ("chr1", 1000, 1050)}
    assert {r.chrom: r.len for r in readers.sizes_from_names(spark, str(tmp_path / "dna")).collect()} == {"chr1": 1050, "chr2": 300, "chrX": 100}


def test_signal_catalog(spark, tmp_path):
    root = tmp_path / "signal"
    for f in ("Histone/Pluripotent_stem_cell/AG1.bedgraph", "Histone/Blood/H3.3_K27M_mutant.bedgraph", "TFs_and_others/Blood/AG1.bedgraph", "Histone/Blood/AG1.bedgraph", "Histone/All cell types/AG1.bedgraph", "Histone/Blood/odd.txt"):
        (root / f).parent.mkdir(parents=True, exist_ok=True)
        (root / f).write_text("chr1\t0\t10\t5\n")
    catalog = readers.signal_catalog(spark, str(root))
    assert catalog.count() == 5
    tissues = spark.createDataFrame([(t,) for t in ("Pluripotent stem cell", "Blood", "All cell types", "Liver")], "tissue string")
    names = spark.createDataFrame([("AG1", None), ("H3PERIOD3_K27M_mutant", "H3.3 K27M mutant"), ("gone", None)], "name string, alias string")
    found = {(r.tissue, r.name): r.path.partition("signal/")[2] for r in vocab.signal_files(catalog, names, tissues).collect()}
    assert found == {
        ("Pluripotent stem cell", "AG1"): "Histone/Pluripotent_stem_cell/AG1.bedgraph", ("Blood", "AG1"): "Histone/Blood/AG1.bedgraph", ("All cell types", "AG1"): "Histone/All cell types/AG1.bedgraph",
        ("Blood", "H3PERIOD3_K27M_mutant"): "Histone/Blood/H3.3_K27M_mutant.bedgraph",
    }
    with pytest.raises(ValueError, match="names share a slug: A B, A_B"):
        vocab.signal_files(catalog, spark.createDataFrame([("A B", None), ("A_B", None)], "name string, alias string"))
    with pytest.raises(ValueError, match="tissues share a slug"):
        vocab.signal_files(catalog, names, tissues.union(spark.createDataFrame([("Pluripotent_stem_cell",)], "tissue string")))
    runs = spark.createDataFrame([("TFs and others", "Blood", "α b", "chr1", 5, 9, 7), ("TFs and others", "Blood", "α b", "chr1", 10, 12, 3)], "ag_class string, ct_class string, antigen string, chrom string, start long, end long, value int")
    sinks.write_signal_tree(runs, str(tmp_path / "tree"))
    assert (tmp_path / "tree/TFs_and_others/Blood" / f"{slug_text('α b')}.bedgraph").read_text() == "chr1\t5\t9\t7\nchr1\t10\t12\t3\n"


def test_compressed_rows(spark, tmp_path):
    rng = random.Random(8)
    rows = [(src, rng.randrange(500), round(rng.random(), 6), rank) for src in rng.sample(range(300), 60) for rank in range(1, rng.randint(2, 9))]
    df = spark.createDataFrame(rows, "src long, dst long, score double, rank int")
    every = sorted({r[0] for r in rows} | {5, 299})
    sources = spark.createDataFrame([(w,) for w in every], "window_id long")
    indptr, values = pairs.csr(df, sources, block=16)
    found, held = sorted(map(tuple, indptr.collect())), {r.position: (r.window_id, r.score) for r in values.collect()}
    at = 0
    for (row, window, begin, end), (n, wanted) in zip(found, enumerate(every), strict=True):
        own = sorted((r[3], r[1], r[2]) for r in rows if r[0] == wanted)
        assert (row, window, begin, end) == (n, wanted, at, at + len(own)) and [held[i] for i in range(begin, end)] == [r[1:] for r in own]
        at = end
    assert sorted(held) == list(range(len(rows)))
    sinks.write_csr(df, str(tmp_path / "csr"))
    index = pairs.PairIndex.of_csr(spark.read.parquet(str(tmp_path / "csr/indptr")), spark.read.parquet(str(tmp_path / "csr/values")), sources)
    assert [tuple(r) for r in index.neighbours(rows[0][0]).collect()] == [(d, s, k) for src, d, s, k in rows if src == rows[0][0]]


def test_two_writers_lose_no_stage(spark, tmp_path):
    first = release.Release.create(spark, str(tmp_path), "hg38", "r1")
    first.manifest["chunk_size"] = 7
    second = release.Release.open(spark, str(tmp_path), "hg38", "r1")
    broken = []

    def note(made, who):
        try:
            for i in range(6):
                made.record(f"{who}{i}", n=i)
        except Exception as e:  # the test's thread must see it
            broken.append(e)

    threads = [threading.Thread(target=note, args=x) for x in ((first, "a"), (second, "b"))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not broken
    found = release.Release.open(spark, str(tmp_path), "hg38", "r1")
    assert set(found.manifest["stages"]) == {f"{w}{i}" for w in "ab" for i in range(6)} and found.manifest["chunk_size"] == 7
    assert len(list((tmp_path / "hg38/r1/manifest").glob("*.json"))) == 12 and not list((tmp_path / "hg38/r1").rglob("*.tmp"))
    assert json.loads((tmp_path / "hg38/r1/MANIFEST.json").read_text()) == found.manifest
    assert not sinks.put_new(spark, str(tmp_path / "hg38/r1/manifest/000001.json"), "x") and Counter(m[0] for m in found.manifest["stages"]) == {"a": 6, "b": 6}
