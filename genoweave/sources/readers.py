"""Readers of the file formats: experiment lists, peaks, tracks, runs, FASTA, class lists, feature lists."""

from __future__ import annotations

import io
import json
import pickle
import zipfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoweave.operators.intervals import _segments, merge_runs
from genoweave.operators.omics import SCHEMA
from genoweave.sources.files import listing, tree

#: The first six fields of an experiment, a peak's, a track's.
EXPERIMENT, PEAK, TRACK = ("srx", "org", "ag_class", "antigen", "ct_class", "celltype"), "chrom string, start long, end long, srx string, score int", "chrom string, start long, end long, value int"


def _lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(line_no, value): lines of text files in any encoding, none dropped for quotes or separators.

    line_no is a struct of the file's path, the place in it where the line's split starts, and the line's place in the split, so
    lines compare in the order of files by name and of lines in a file, however files are dealt to tasks.
    The text source knows UTF-8 only, so lines are read as CSV of one column with a separator that doesn't occur.
    """
    df = spark.read.schema("value string").option("encoding", encoding).option("sep", "\u0001").option("quote", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(path)
    place = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"))
    return df.select(place.alias("line_no"), F.coalesce("value", F.lit("")).alias("value"))


def read_live_list(spark: SparkSession, path: str) -> DataFrame:
    """An experiment list without header, ragged and latin-1: the first six tab-separated fields; shorter lines are skipped."""
    f = F.split("value", "\t", 7)
    df = _lines(spark, path, "ISO-8859-1").filter(F.size(f) >= 6)
    return df.select("line_no", *[f[i].alias(name) for i, name in enumerate(EXPERIMENT)])


def _parsed(spark: SparkSession, path: str, parse: Callable[[bytes], Iterator[dict[str, list]]], schema: str) -> DataFrame:
    """Rows that ``parse`` makes of a file's bytes, in the task that reads the file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column(0):
                for columns in parse(raw.as_py()):
                    yield pa.RecordBatch.from_pydict(columns)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def read_bundled_zip(spark: SparkSession, path: str) -> DataFrame:
    """An experiment list that is the only CSV of a zip archive: header, first six columns by position, all strings."""

    def parse(raw: bytes) -> Iterator[dict[str, list]]:
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            inside = [n for n in z.namelist() if n.lower().endswith(".csv")]
            if len(inside) != 1:
                raise ValueError(f"the archive holds {len(inside)} CSV files, not one")
            with z.open(inside[0]) as f:
                at = 0
                for part in pd.read_csv(f, dtype=str, encoding="latin-1", keep_default_na=False, on_bad_lines="warn", usecols=range(6), engine="python", chunksize=10_000):
                    yield {"line_no": list(range(at, at + len(part)))} | {name: part.iloc[:, i].tolist() for i, name in enumerate(EXPERIMENT)}
                    at += len(part)

    return _parsed(spark, path, parse, "line_no long, " + ", ".join(f"{c} string" for c in EXPERIMENT))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_experiment_list(spark: SparkSession, folder: str, source: str = "auto", live: str = "experimentList.tab", bundled: str = "experiment_list.zip") -> DataFrame:
    """The live list if there is one, else the bundled one; ``source`` may ask for either."""
    if source not in ("auto", "live", "bundled"):
        raise ValueError(f"no such source: {source}")
    if source == "live" or (source == "auto" and _exists(spark, f"{folder}/{live}")):
        return read_live_list(spark, f"{folder}/{live}")
    return read_bundled_zip(spark, f"{folder}/{bundled}")


def read_peaks(spark: SparkSession, path: str, numbered: bool = False) -> DataFrame:
    """Peaks of a BED5 file, plain or compressed (.gz, .zst), with ``bad`` for lines of another width (other fields null).

    A line of the right width with a number that isn't one stops the read. Take ``good_peaks`` and ``bad_rows`` of it.
    ``numbered`` keeps ``line_no``.
    """
    f = F.split("value", "\t", -1)
    ok = F.size(f) == 5
    number = lambda i, kind: F.when(ok & (f[i] != ""), f[i].try_cast(kind))
    wrong = ok & F.exists(F.array(f[1], f[2], f[4]), lambda x: (x != "") & x.try_cast("long").isNull())
    df = _lines(spark, path).filter("value <> ''")
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("not a number in: "), "value")).cast("string")).otherwise(f[0])
    return df.select(F.when(ok, checked).alias("chrom"), number(1, "long").alias("start"), number(2, "long").alias("end"), F.when(ok, f[3]).alias("srx"), number(4, "int").alias("score"), (~ok).alias("bad"), *(["line_no"] if numbered else []))


def good_peaks(peaks: DataFrame) -> DataFrame:
    return peaks.filter(~F.col("bad")).drop("bad")


def bad_rows(peaks: DataFrame) -> int:
    return peaks.filter("bad").count()


def read_track(spark: SparkSession, path: str | list[str], chroms: Sequence[str] | None = None) -> DataFrame:
    """A bedGraph's runs, of some chromosomes only if asked; the condition is pushed to the scan."""
    df = spark.read.schema(TRACK).option("sep", "\t").option("mode", "FAILFAST").csv(path)
    return df.filter(F.col("chrom").isin(*chroms)) if chroms is not None else df


def read_tracks(spark: SparkSession, path: str) -> DataFrame:
    """Runs by group as ``write_tracks`` stored them; names of folders stay strings, whatever they look like."""
    return spark.read.schema(f"{TRACK}, ag_class string, ct_class string, antigen string").parquet(path)


def read_runs(spark: SparkSession, path: str, chroms: Sequence[str] | None = None) -> DataFrame:
    """Merged (chrom, start, end) of a BED file by white space; blank, comment, track, browser and short lines don't count."""
    f = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    df = _lines(spark, path).filter(~F.trim("value").rlike("^(#|track|browser)") & (F.size(f) >= 3))
    df = df.select(f[0].alias("chrom"), f[1].cast("long").alias("start"), f[2].cast("long").alias("end"))
    return merge_runs(df.filter(F.col("chrom").isin(*chroms)) if chroms is not None else df, ["chrom"])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (path, split, value) of FASTA files in order, as (path, split, record, name, start, seq): which record of the split a
    line belongs to (0: one that began before), the record's name (null for that one), and how much of it the split holds ahead."""
    record, ahead, called = 0, 0, None
    for goes_on, b, i, j in _segments(batches, 2):
        if not goes_on:
            record, ahead, called = 0, 0, None
        value = b.column(2).slice(i, j - i)
        header = pc.starts_with(value, ">").to_numpy(zero_copy_only=False)
        seq = pc.if_else(pa.array(header), "", pc.replace_substring_regex(value, r"[\s\x0b]+", ""))
        of = record + np.cumsum(header)
        after = ahead + np.cumsum(pc.utf8_length(seq).to_numpy())
        # what lies ahead of a record's first line is taken off, for the record that began before this batch nothing is
        first = np.concatenate(([0], after[header]))
        start = np.concatenate(([ahead], after[:-1])) - first[of - record]
        names = pa.array([called, *[(text[1:].split() or [""])[0] for text in value.filter(pa.array(header)).to_pylist()]], pa.string())
        name = names.take(pa.array(of - record))
        yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(of, pa.int64()), name, pa.array(start, pa.int64()), seq], schema=_NUMBERED)
        record, ahead, called = int(of[-1]), int(after[-1] - first[-1]), names[-1].as_py()


_NUMBERED = pa.schema([("path", pa.string()), ("split", pa.int64()), ("record", pa.int64()), ("name", pa.string()), ("start", pa.int64()), ("seq", pa.string())])


class Fasta:
    """FASTA files by line, so no record need fit a row. ``pieces`` are lines (chrom, start, seq) with their place in the
    record; ``records`` are (chrom, len), one for each header, also without a line. A record's name is its header's first word;
    a name that heads two records is an error, and lines ahead of a file's first header don't count.

    Lines are counted within their split of a file, and most records lie in one. Only what a split holds of a record that began
    before it needs a name and a place from other splits; these are prefix sums of a row for each split, which all tasks get. So lines
    stay where and in the order in which they are read.
    """

    def __init__(self, spark: SparkSession, path: str):
        lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), "value")
        local = lines.mapInArrow(_numbered, "path string, split long, record long, name string, start long, seq string")
        parts = local.groupBy("path", "split", "record").agg(F.max("name").alias("name"), F.sum(F.length("seq")).cast("long").alias("len"))
        # of each split the record that goes on after it, and what the split holds of that
        ends = parts.groupBy("path", "split").agg(F.max_by(F.struct("record", "name", "len"), "record").alias("r")).select("path", "split", "r.*")
        order = Window.partitionBy("path").orderBy("split")
        ends = ends.withColumn("nth", F.count("name").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        ends = ends.withColumn("sum", F.sum("len").over(Window.partitionBy("path", "nth").orderBy("split").rowsBetween(Window.unboundedPreceding, 0)))
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        # a file's first split has nothing before it; a file of one split has no row
        began = F.broadcast(ends.select("path", "split", F.last("name", ignorenulls=True).over(before).alias("began"), F.lag("sum").over(order).alias("ahead")).filter("split > 0"))
        named = lambda df: df.join(began, ["path", "split"], "left").withColumn("chrom", F.when(F.col("record") > 0, F.col("name")).otherwise(F.col("began")))
        # both passes must cut files alike; if they ever don't, a line without its split is an error, not a lost line
        lost = (F.col("split") > 0) & F.col("ahead").isNull()
        start = F.col("start") + F.when(lost, F.raise_error(F.lit("files were split otherwise in the second pass")).cast("long")).when(F.col("record") > 0, 0).otherwise(F.coalesce("ahead", F.lit(0)))
        self.pieces = named(local.filter("seq <> ''")).select(F.when(lost, "").otherwise(F.col("chrom")).alias("chrom"), start.alias("start"), "seq").filter("chrom IS NOT NULL")
        whole = named(parts).filter("chrom IS NOT NULL").groupBy("chrom").agg(F.sum("len").alias("len"), F.count_if(F.col("record") > 0).alias("heads"))
        once = F.when(F.col("heads") > 1, F.raise_error(F.concat(F.lit("two records are named "), "chrom")).cast("long")).otherwise(F.col("len"))
        self.records = whole.select("chrom", once.alias("len"))


def chrom_sizes(sequences: DataFrame) -> DataFrame:
    """(chrom, len) of whole sequences (chrom, seq) or of their pieces (chrom, start, seq)."""
    if "start" in sequences.columns:
        return sequences.groupBy("chrom").agg(F.max(F.col("start") + F.length("seq")).alias("len"))
    return sequences.select("chrom", F.length("seq").cast("long").alias("len"))


#: Chromosome, start and end in the name of a file of sequence.
_CHUNK_NAME = r"([^/]+)/(\d+)_(\d+)\.txt$"


def sizes_from_names(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, len) of a tree of sequence chunks ``chrom/start_end.txt``: the largest end. Names alone are read, no file's body."""
    part = lambda i: F.regexp_extract("path", _CHUNK_NAME, i)
    return tree(spark, path, "*_*.txt").filter(F.col("path").rlike(_CHUNK_NAME)).groupBy(part(1).alias("chrom")).agg(F.max(part(3).cast("long")).alias("len"))


def read_dna_tree(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, start, end, dna) of a tree ``chrom/start_end.txt``, a row for each file; they need not tile a chromosome."""
    part = lambda i: F.regexp_extract("path", _CHUNK_NAME, i)
    return tree(spark, path, "*_*.txt", read=True).select(part(1).alias("chrom"), part(2).cast("long").alias("start"), part(3).cast("long").alias("end"), F.upper(F.regexp_replace("value", r"\s", "")).alias("dna"))


def signal_catalog(spark: SparkSession, path: str, suffix: str = "bedgraph") -> DataFrame:
    """(ag_class, tissue, stem, path) of signal files ``class/tissue/name.suffix`` below a folder, names as they are on disk."""
    part = lambda i: F.regexp_extract("path", rf"([^/]+)/([^/]+)/([^/]+)\.{suffix}$", i)
    return listing(spark, path, f"*.{suffix}").select(part(1).alias("ag_class"), part(2).alias("tissue"), part(3).alias("stem"), "path")


def stored_order(rows: DataFrame, *, key: str = "chrom", start: str = "start", folders: bool = False) -> DataFrame:
    """(path, rows, out_of_order) of a scan of files: rows in each file, and those that start before the row ahead of them in the
    file while the key is the same. One pass in stored order; splits of a file are stitched by their edges.

    With ``folders`` a path is a folder, whose files go on from one another in the order of their names, as writers of ranges make them.
    """

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, last = [], None
        for goes_on, b, i, j in _segments(batches, 2):
            keys, at = b.column(2).slice(i, j - i), b.column(3).slice(i, j - i).to_numpy(zero_copy_only=False)
            code = keys.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            late = int(((code[1:] == code[:-1]) & (at[1:] < at[:-1])).sum())
            edge = (keys[0].as_py(), at[0].item())
            if goes_on:
                late += last[0] == edge[0] and edge[1] < last[1]
                row = done[-1]
                done[-1] = (*row[:2], row[2] + j - i, row[3] + late, *row[4:6], keys[j - i - 1].as_py(), at[-1].item())
            else:
                done.append((b.column(0)[i].as_py(), b.column(1)[i].as_py(), j - i, late, *edge, keys[j - i - 1].as_py(), at[-1].item()))
            last = done[-1][6:8]
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["path", "split", "rows", "late", "k0", "s0", "k1", "s1"])

    scan = rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.col(key).cast("string"), F.col(start).cast("long")).na.drop()
    edges = scan.mapInArrow(audit, "path string, split long, rows long, late long, k0 string, s0 long, k1 string, s1 long")
    edges = edges.withColumns({"file": F.col("path"), "path": F.regexp_replace("path", "/[^/]*$", "") if folders else F.col("path")})
    order = Window.partitionBy("path").orderBy("file", "split")  # a row for each split of a file
    seam = (F.lag("k1").over(order) == F.col("k0")) & (F.col("s0") < F.lag("s1").over(order))
    return edges.withColumn("late", F.col("late") + F.coalesce(seam.cast("long"), F.lit(0))).groupBy("path").agg(F.sum("rows").alias("rows"), F.sum("late").alias("out_of_order"))


def _trust(trusted: bool) -> None:
    """A pickle may run any code when it is loaded, so the caller must say that its origin is known."""
    if not trusted:
        raise ValueError("a pickle runs code when it is loaded; pass trusted=True for one of known origin")


def read_sequence_pickle(spark: SparkSession, path: str, trusted: bool = False) -> DataFrame:
    """(chrom, seq) of a pickled {chrom: sequence}, to be stored as a table once."""
    _trust(trusted)
    return _parsed(spark, path, lambda raw: ({"chrom": [str(k)], "seq": [str(v)]} for k, v in pickle.loads(raw).items()), "chrom string, seq string")  # noqa: S301


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """The group table of a release. ``NA`` is a name, not a missing value; a blank class is an error."""
    schema = "group_id int, ag_class string, antigen string, ct_class string, n_experiments long, path string"
    df = spark.read.schema(schema).option("sep", "\t").option("header", True).option("nullValue", "\u0001").csv(path)
    blank = df.filter(F.col("ag_class").isNull() | (F.trim("ag_class") == ""))
    if not blank.isEmpty():
        raise ValueError(f"{path}: a group has a blank class")
    return df


def read_class_list(spark: SparkSession, path: str) -> DataFrame:
    """Numbered lines of a file list, for ``vocab.class_codes``."""
    return _lines(spark, path)


def read_feature_list(spark: SparkSession, path: str, trusted: bool = False) -> DataFrame:
    """(idx, name) of a JSON list, or of an object's ``features``, in order; of a pickled one if it is trusted."""
    pickled = path.endswith((".pkl", ".joblib"))
    if pickled:
        _trust(trusted)

    def parse(raw: bytes) -> Iterator[dict[str, list]]:
        found = pickle.loads(raw) if pickled else json.loads(raw)  # noqa: S301
        names = [str(x) for x in (found["features"] if isinstance(found, dict) else found)]
        yield {"idx": pa.array(range(len(names)), pa.int32()), "name": pa.array(names, pa.string())}

    return _parsed(spark, path, parse, "idx int, name string")


def read_chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("chrom string, len long").option("sep", "\t").csv(path)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """(srx, group_id) as ``accession_lookup`` stored it."""
    return spark.read.schema("srx string, group_id int").parquet(path)


def read_omics(spark: SparkSession, path: str) -> DataFrame:
    """Signal by chunk; conditions on tissue and chrom prune folders, those on chunk prune row groups."""
    return spark.read.schema(f"chunk long, {SCHEMA}, tissue string, chrom string").parquet(path)


def read_legacy_windows(spark: SparkSession, path: str, trusted: bool = False) -> DataFrame:
    """(chrom, start, end, strand, tissue) of a pickled frame with windows of one split; what it lacks of the last two is null."""
    _trust(trusted)

    def parse(raw: bytes) -> Iterator[dict[str, list]]:
        df = pd.DataFrame(pickle.loads(raw))  # noqa: S301
        text = lambda c: pa.array([str(x) for x in df[c]] if c in df else [None] * len(df), pa.string())
        yield {"chrom": text("chrom"), "start": pa.array(df["start"], pa.int64()), "end": pa.array(df["end"], pa.int64()), "strand": text("strand"), "tissue": text("tissue")}

    return _parsed(spark, path, parse, "chrom string, start long, end long, strand string, tissue string")
