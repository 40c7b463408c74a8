"""Files of exact names and shapes: contents, spread, commit, and what is found in footers."""

from __future__ import annotations

import json
import random
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from genoweave.plans import verify
from genoweave.sources import files, readers, sinks

OMICS = "tissue string, chrom string, chunk long, Chromosome string, Start long, End long, Name int, feature_name string"


def signal(n: int = 6000) -> list[tuple]:
    """Nine rows of ten lie on one chromosome of one tissue."""
    rng = random.Random(9)
    rows = []
    for _ in range(n):
        tissue, chrom = ("Pluripotent stem=cell/50%", "chr1") if rng.random() < 0.9 else (rng.choice(("Blood", "123")), rng.choice(("chr1", "chr2")))
        start = rng.randrange(64 * 100)
        end = start + rng.randrange(150)
        rows += [(tissue, chrom, c, chrom, start, end, rng.randint(1, 99), rng.choice("abc")) for c in range(start // 100, max(end - 1, start) // 100 + 1)]
    return rows


def read_back(path: Path) -> dict[tuple, list]:
    """Row groups by (file, place): chunk and rows."""
    out = {}
    for f in path.rglob("*.parquet"):
        table = pq.ParquetFile(f)
        listed = json.loads(table.metadata.metadata[files.CHUNK_KEY])
        assert len(listed) == table.num_row_groups
        for i, c in enumerate(listed):
            out[f, i] = (c, table.read_row_group(i).to_pylist())
    return out


def test_chunks_are_row_groups(spark, tmp_path):
    rows = signal()
    df = spark.createDataFrame(rows, OMICS).repartition(7)
    expected = spark.createDataFrame([("Blood", "chr1"), ("Blood", "chrM")], "tissue string, chrom string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        sinks.write_omics(df, str(tmp_path / "omics"), expected)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    groups = read_back(tmp_path / "omics")
    assert sum(len(r) for _, r in groups.values()) == len(rows)
    for (f, _), (c, found) in groups.items():
        assert {r["chunk"] for r in found} == {c} and [r["Start"] for r in found] == sorted(r["Start"] for r in found)
        assert f.parent.name == f"chrom={found[0]['Chromosome']}"
    keys = Counter((f.parent.parent.name, f.parent.name, c) for (f, _), (c, _) in groups.items())
    assert max(keys.values()) == 1, "a chunk is one row group"
    hot = [f for f in (tmp_path / "omics").rglob("*.parquet") if "Pluripotent" in str(f)]
    assert len(hot) > 1 and max(pq.read_metadata(f).num_rows for f in hot) < 0.6 * len(rows), "a large chromosome is written by several tasks"
    assert [pq.read_metadata(f).num_rows for f in (tmp_path / "omics").rglob("chrom=chrM/*.parquet")] == [0]
    assert not list(tmp_path.rglob("_temporary"))
    stored = readers.read_omics(spark, str(tmp_path / "omics"))
    assert sorted(map(tuple, stored.select(*[c.split()[0] for c in OMICS.split(", ")]).collect())) == sorted(rows)
    plan = stored.filter("tissue = '123' AND chrom = 'chr2' AND chunk = 5")
    assert plan.count() == sum(r[:3] == ("123", "chr2", 5) for r in rows) and "PushedFilters: [IsNotNull(chunk), EqualTo(chunk,5)]" in plan._jdf.queryExecution().toString()
    found = files.footers(spark, str(tmp_path / "omics"))
    assert found.agg(F.sum(F.aggregate("groups", F.lit(0).cast("long"), lambda n, g: n + g["rows"]))).first()[0] == len(rows)
    asked = df.select("tissue", "chrom", "chunk").distinct().unionByName(expected, allowMissingColumns=True)
    assert verify.footer_faults(found, asked, 100).isEmpty()
    more = asked.union(spark.createDataFrame([("Blood", "chr1", 999), ("Lung", "chr1", None)], "tissue string, chrom string, chunk long"))
    assert sorted((r.tissue, r.chunk, r.fault) for r in verify.footer_faults(found, more, 100).collect()) == [("Blood", 999, "missing chunk"), ("Lung", None, "missing file")]


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "omics")
    df = spark.createDataFrame([("T", "chr1", 0, "chr1", 0, 10, 1, "a")], OMICS)
    sinks.write_omics(df, path)
    bad = df.withColumn("Name", F.when(F.col("Start") >= 0, F.raise_error(F.lit("broken"))).cast("int"))
    with pytest.raises(Exception, match="broken"):
        sinks.write_omics(bad.union(df), path)
    assert readers.read_omics(spark, path).count() == 1 and not list(tmp_path.rglob("_temporary/*"))
    sinks.write_omics(df.withColumn("chunk", F.lit(7).cast("long")), path)
    assert [r.chunk for r in readers.read_omics(spark, path).collect()] == [7], "a write replaces what was there"
    sinks.write_omics(df.limit(0), path)
    assert list(tmp_path.rglob("*.parquet")) == []


def test_text_files(spark, tmp_path):
    rows = [("chr1/0_4.txt", "ACGT"), ("chr1/4_6.txt", "NN"), ("chr2/0_1.txt", "A")]
    files.write_text(spark.createDataFrame(rows, "file string, value string"), str(tmp_path / "dna"), ending="")
    assert sorted((str(f.relative_to(tmp_path / "dna")), f.read_text()) for f in (tmp_path / "dna").rglob("*.txt")) == rows
    with pytest.raises(Exception, match="not a name below"):
        files.write_text(spark.createDataFrame([("../x", "y")], "file string, value string"), str(tmp_path / "dna"))
    assert {r.path.rpartition("/")[2] for r in files.listing(spark, str(tmp_path / "dna"), "*_*.txt").collect()} == {"0_4.txt", "4_6.txt", "0_1.txt"}


def test_the_driver_gets_no_names(spark, tmp_path):
    """A task's message is as long for many files as for one; files of a folder may come from several tasks; tasks list and read."""
    import pickle

    import pyarrow as pa

    def message(n: int) -> bytes:
        writer = files.TextWriter(str(tmp_path / "one"), True, "")
        batch = pa.RecordBatch.from_pydict({"file": [f"c{i}/0_4.txt" for i in range(n)], "value": ["ACGT"] * n})
        return pickle.dumps(writer.write(iter([batch])))

    assert len(message(1)) == len(message(500))
    rows = [(f"chr {k}%/{i}_{i + 1}.txt", f"{k}ñ{i}") for k in range(40) for i in range(20)]
    path = str(tmp_path / "dna")
    with_parts = spark.createDataFrame(rows, "file string, value string").repartition(5)
    for _ in range(2):  # a write replaces what was there
        files.write_text(with_parts, path, ending="")
        (tmp_path / "dna/stray.txt").write_text("x")
        (tmp_path / "dna/_hidden").mkdir(exist_ok=True)
        (tmp_path / "dna/_hidden/1_2.txt").write_text("x")
        found = files.tree(spark, path, "*_*.txt", read=True)
        assert sorted((r.path.removeprefix(f"{path}/"), r.value) for r in found.collect()) == sorted(rows)
    assert {r.path for r in files.tree(spark, f"file://{path}", "*_*.txt").collect()} == {f"{path}/{name}" for name, _ in rows}
    assert files.tree(spark, path, "*.bed").isEmpty()
    plan = readers.sizes_from_names(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "MapInArrow" in plan
