"""Writers: tables by group and chunk, tracks, sequences, sizes, vocabularies, pair indexes."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.functions.names import slugify
from genoweave.operators.pairs import csr
from genoweave.sources.files import write_chunks, write_text

GROUP_KEYS = ("ag_class", "ct_class", "antigen")


def write_group_beds(peaks: DataFrame, path: str, keys: Sequence[str] = GROUP_KEYS) -> None:
    """A folder of BED text for each group, in genomic order: within a file, and from one file's name to the next.

    Rows are dealt by ranges of group and place, whose bounds are sampled, so a large group is spread over tasks and files.
    """
    columns = ["chrom", "start", "end", "srx", "score"]
    df = peaks.select(*keys, *columns).repartitionByRange(*keys, "chrom", "start")
    # the sort begins with the folders' keys, or the writer would sort again and lose the order
    df = df.sortWithinPartitions(*keys, "chrom", "start", "end")
    df.write.mode("overwrite").partitionBy(*keys).option("sep", "\t").option("quote", "").option("emptyValue", "").csv(path)


def write_tracks(runs: DataFrame, path: str, keys: Sequence[str] = GROUP_KEYS, text: str | None = None) -> None:
    """Runs as Parquet by group, sorted by chromosome and start, in files as ``write_group_beds`` makes them; as bedGraph text too if a
    folder is given."""
    ordered = lambda df: df.repartitionByRange(*keys, "chrom", "start").sortWithinPartitions(*keys, "chrom", "start")
    ordered(runs).write.mode("overwrite").partitionBy(*keys).option("compression", "zstd").parquet(path)
    if text:  # from what is stored, so that runs are computed once
        stored = runs.sparkSession.read.schema(runs.schema).parquet(path)
        ordered(stored).select(*keys, "chrom", "start", "end", "value").write.mode("overwrite").partitionBy(*keys).option("sep", "\t").csv(text)


def write_signal_tree(runs: DataFrame, path: str) -> None:
    """Runs as ``class/tissue/antigen.bedgraph`` of slugs, one file for each group, for readers of that layout."""
    name = F.concat_ws("/", slugify(F.col("ag_class")), slugify(F.col("ct_class")), F.concat(slugify(F.col("antigen")), F.lit(".bedgraph")))
    rows = runs.select(name.alias("file"), F.concat_ws("\t", "chrom", "start", "end", "value").alias("value"), "chrom", "start")
    write_text(rows, path, order=("chrom", "start"))


def write_dna_tree(chunks: DataFrame, path: str) -> None:
    """Sequence chunks as text files ``chrom/start_end.txt``, without a line's end, for readers of that layout."""
    name = F.concat("chrom", F.lit("/"), F.col("start").cast("string"), F.lit("_"), F.col("end").cast("string"), F.lit(".txt"))
    write_text(chunks.select(name.alias("file"), F.col("dna").alias("value")), path, ending="")


def write_omics(omics: DataFrame, path: str, expected: DataFrame | None = None) -> None:
    """Signal by chunk: folders of tissue and chromosome, one row group for each chunk, the chunks listed in the footer."""
    write_chunks(omics, path, expected)


def write_dna(chunks: DataFrame, path: str) -> None:
    """(chrom, start, end, dna) by chromosome, sorted by start; a large chromosome has several files."""
    chunks.repartitionByRange("chrom", "start").sortWithinPartitions("chrom", "start").write.mode("overwrite").partitionBy("chrom").option("compression", "zstd").parquet(path)


def write_windows(windows: DataFrame, path: str) -> None:
    """Windows or a grid, compressed with zstd; partitioned by split if they have one."""
    writer = windows.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy("split") if "split" in windows.columns else writer).parquet(path)


def write_chrom_sizes(sizes: DataFrame, path: str) -> None:
    """One text file of chromosomes, longest first, then by name. As many rows as chromosomes."""
    sizes.coalesce(1).sortWithinPartitions(F.desc("len"), "chrom").select("chrom", "len").write.mode("overwrite").option("sep", "\t").csv(path)


def write_lookup(lookup: DataFrame, path: str) -> None:
    lookup.write.mode("overwrite").parquet(path)


def write_pairs(pairs: DataFrame, weights: DataFrame, path: str) -> None:
    """The pair table sorted by source, and the track weights."""
    pairs.repartitionByRange("src").sortWithinPartitions("src", "rank").write.mode("overwrite").parquet(f"{path}/pairs")
    weights.coalesce(1).sortWithinPartitions("track").write.mode("overwrite").parquet(f"{path}/weights")


def write_csr(pairs: DataFrame, path: str, sources: DataFrame | None = None) -> None:
    """The pair table in compressed rows (see ``pairs.csr``): indptr by row, values by position."""
    indptr, values = csr(pairs, sources)
    indptr.repartitionByRange("row").sortWithinPartitions("row").write.mode("overwrite").parquet(f"{path}/indptr")
    values.repartitionByRange("position").sortWithinPartitions("position").write.mode("overwrite").parquet(f"{path}/values")


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, whole, if there is none of that name; of several that try at once one succeeds."""
    jvm = spark.sparkContext._jvm
    hadoop, conf = jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    fs = hadoop.Path(path).getFileSystem(conf)
    target, part = fs.makeQualified(hadoop.Path(path)), fs.makeQualified(hadoop.Path(f"{path}.{uuid.uuid4().hex}.tmp"))
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":  # its rename looks first and renames then, which two may do at once; a link is made or refused
            jvm.java.nio.file.Files.createLink(jvm.java.io.File(target.toUri().getPath()).toPath(), jvm.java.io.File(part.toUri().getPath()).toPath())
        else:
            none = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
            hadoop.FileContext.getFileContext(target.toUri(), conf).rename(part, target, none)
    except Exception as refused:
        if "FileAlreadyExists" not in str(refused):
            raise
        return False
    finally:
        fs.delete(part, False)
    return True


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file by one rename over it, so that readers find the old text or the new one."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    fs = hadoop.Path(path).getFileSystem(conf)
    target, part = fs.makeQualified(hadoop.Path(path)), fs.makeQualified(hadoop.Path(f"{path}.{uuid.uuid4().hex}.tmp"))
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    over[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(target.toUri(), conf).rename(part, target, over)


def get_text(spark: SparkSession, path: str) -> str:
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0]).decode()


def write_vocabulary(spark: SparkSession, path: str, tissues: DataFrame, features: DataFrame, availability: DataFrame, **facts) -> None:
    """tissues.json, features.json (in index order, with further facts) and availability.json of small vocabularies."""
    put_text(spark, f"{path}/tissues.json", json.dumps([r.asDict() for r in tissues.orderBy("tissue").collect()], indent=1))
    put_text(spark, f"{path}/features.json", json.dumps({"features": [r.name for r in features.orderBy("idx").collect()], **facts}, indent=1))
    put_text(spark, f"{path}/availability.json", json.dumps({r.tissue: list(r.features) for r in availability.orderBy("tissue").collect()}, indent=1))
