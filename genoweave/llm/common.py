"""Pieces that several operators share: staged tables, word splitting, label folds and the exact library fallback test."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoweave.session import scratch

#: A word, wherever the contracts speak of words: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Texts with none of these characters split into words and pre-tokens alike in Python and in the tokenizer library.
_UNCOMMON = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ–—‘-„•…€]")


def common_only(text: str) -> bool:
    """True if the text holds only characters whose class never differs between Unicode tables."""
    return text.isascii() and not _CONTROL.search(text) or not _UNCOMMON.search(text)


_CONTROL = re.compile("[\x00-\x08\x0b-\x0c\x0e-\x1f\x7f]")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the application's folder in the shared one and read it back.

    It cuts the lineage, survives the loss of executors and makes values that depend on the physical row order
    (row ids) final. ``unstage`` removes what was written; the rest goes with the application.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def unstage(*frames: DataFrame) -> None:
    """Remove staged tables that no frame still to be computed reads."""
    for df in frames:
        context = df.sparkSession.sparkContext
        target = context._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words_of(text: str) -> list[bytes]:
    """The words of a text with A-Z lower-cased, as UTF-8.

    ``bytes.split`` and ``bytes.lower`` know ASCII only, which is what ``WORD`` and the contracts ask for.
    """
    return text.encode("utf-8", "surrogatepass").lower().split()


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds).cast("long"))
