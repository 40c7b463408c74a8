"""The command line, migration, and the entry module without the training-data operators."""

from __future__ import annotations

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from genoweave.plans import migrate

ROOT = Path(__file__).resolve().parents[2]


def test_migration(spark, tmp_path):
    bodies = {
        "OMICS/His/Bld/05.H3K27ac.AllCell.bed": "signal/Histone/Blood/H3K27ac.bed", "OMICS/Xxx/Liv/05.A B.AllCell.bed": "signal/Xxx/Liv/A_B.bed", "OMICS/His/Bld/odd.txt": None,
        "DNA/hg38.fa": "genome/hg38.fa", "Subtables/dna/chr1/0_4.txt": "dna/chr1/0_4.txt", "Subtables/dna/chr1/4_9.txt": "dna/chr1/4_9.txt", "Subtables/omics/Bld/chr1/0_4.pkl": "chunks/omics/Blood/chr1/0_4.pkl",
        "SupportFiles/train_intervals_8192_ALL.pkl": "index/train_intervals_8192_ALL.pkl", "SupportFiles/train_intervals_x.pkl": None, "SupportFiles/omics_pairs.npz": "index/omics_pairs.npz", "SupportFiles/hg38_DNA_seq.pkl": "genome/hg38_DNA_seq.pkl",
    }
    for f in bodies:
        p = tmp_path / "old" / f
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(f)
    codes = spark.createDataFrame([("antigen", "Histone", "His"), ("tissue", "Blood", "Bld")], "kind string, name string, code string")
    args = (spark, str(tmp_path / "old"), str(tmp_path / "new"), "hg38", "2024-06-01", codes)
    moves = {r.old.split("/old/")[1]: r.new and r.new.split("2024-06-01/")[1] for r in migrate.plan(*args).collect()}
    assert moves == bodies
    made = migrate.migrate(*args)
    assert {str(f.relative_to(tmp_path / "old")) for f in (tmp_path / "old").rglob("*") if f.is_file()} == {f for f, new in bodies.items() if new is None}
    assert all((tmp_path / "new/hg38/2024-06-01" / new).read_text() == old for old, new in bodies.items() if new)
    assert made.manifest["chrom_sizes"] == {"chr1": 9} and made.manifest["source_threshold"] == "05" and made.manifest["stages"]["migrate"]["moved"] == 9
    with pytest.raises(FileExistsError):
        migrate.plan(*args)
    (tmp_path / "old/OMICS/His/Bld/10.X.AllCell.bed").write_text("x")
    (tmp_path / "old/OMICS/His/Bld/05.Y.AllCell.bed").write_text("x")
    with pytest.raises(ValueError, match="thresholds"):
        migrate.plan(*args[:2], str(tmp_path / "other"), *args[3:])
    (tmp_path / "old/OMICS/His/Bld/10.X.AllCell.bed").rename(tmp_path / "old/OMICS/His/Bld/05.Y_.AllCell.bed")
    (tmp_path / "old/OMICS/His/Bld/05.Y_.AllCell.bed").with_name("05.Y .AllCell.bed").write_text("y")
    with pytest.raises(ValueError, match="share a name"):
        migrate.plan(*args[:2], str(tmp_path / "other"), *args[3:])
    shutil.copytree(tmp_path / "new/hg38/2024-06-01/dna", tmp_path / "two/old/Subtables/dna")
    moves = migrate.plan(spark, str(tmp_path / "two/old"), str(tmp_path / "two/new"), "hg38", "r2", codes)
    assert [migrate.execute(moves.persist()) for _ in (1, 2)] == [2, 2], "a task that runs again finds its files moved"


def test_tracks_and_report_from_files(spark, tmp_path, capsys):
    from genoweave import __main__ as cli

    meta = tmp_path / "meta"
    meta.mkdir()
    (meta / "experimentList.tab").write_bytes(b"SRX1\thg38\tHistone\tH3K27ac\tBlood\tx\nSRX2\thg38\tHistone\tH3K27ac\tBlood\ty\nSRX3\thg38\tTFs\tCTCF\tLiver\tz\n")
    (tmp_path / "p.bed").write_text("chr1\t0\t10\tSRX1\t5\nchr1\t5\t20\tSRX2\t9\nchr1\t0\t4\tSRX3\t1\nchr2\t0\t4\tSRX9\t1\nchr2\t0\t4\tSRX9\n")
    assert cli.main(["tracks", "--meta", str(meta), "--peaks", str(tmp_path / "p.bed"), "--org", "hg38", "--out", str(tmp_path / "out"), "--beds"]) == 0
    runs = spark.read.parquet(str(tmp_path / "out/tracks"))
    assert sorted((r.antigen, r.start, r.end, r.value) for r in runs.collect()) == [("CTCF", 0, 4, 1), ("H3K27ac", 0, 5, 5), ("H3K27ac", 5, 20, 9)]
    counts = json.loads((tmp_path / "out/counts.json").read_text())
    assert counts == {"rows_in": 5, "bad_rows": 1, "unmapped": 1, "rows_out": 3, "lost": 0}
    assert cli.main(["report", "--out", str(tmp_path / "out")]) == 0
    said = capsys.readouterr().out
    assert "rows_in: 5" in said and "tracks: 2 files, 3 rows, 0 out of order" in said and "beds: 2 files, 3 rows, 0 out of order" in said
    bed = next(f for f in (tmp_path / "out/beds").rglob("*.csv") if "H3K27ac" in str(f))
    bed.write_text("".join(reversed(bed.read_text().splitlines(True))))
    bed.with_name(f".{bed.name}.crc").unlink()
    assert cli.main(["report", "--out", str(tmp_path / "out")]) == 1
    (tmp_path / "out/counts.json").write_text(json.dumps(counts | {"lost": 2}))
    assert cli.main(["list", "--root", str(tmp_path), "--org", "hg38"]) == 0


def test_without_the_corpus_operators(tmp_path):
    shutil.copytree(ROOT / "genoweave", tmp_path / "genoweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert 'max_runs' in e.queries() and 'pipeline' not in e.queries() and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
