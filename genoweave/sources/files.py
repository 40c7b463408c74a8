"""Files whose names and inner shape matter: written by tasks from sorted streams, put in place by one commit.

Both formats are Python data sources. A task gets its partition's rows as Arrow batches, in order, and writes into a folder of its own
below ``_temporary``, under the names that the files will have; the driver gets that folder's path alone and, once all tasks are done,
removes what was there and moves what lies in the folders into place. Files of tasks that failed or ran twice are never moved. Paths may be any that pyarrow's file systems
open (local or shared folders, HDFS, object stores); all executors must see them.

* ``genoweave_chunks``: signal by tissue, chromosome and chunk as Parquet, one row group for each chunk, and the list of chunks
  in the footer. A task holds one chunk at a time. A chromosome may have several files, each of a range of chunks.
* ``genoweave_text``: rows (file, value), a text file for each run of one name.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from genoweave.operators.intervals import _segments

#: The footer's key of the list of chunks, one for each row group, in order.
CHUNK_KEY = b"genoweave:chunks"
#: What Spark takes for a null in a folder's name.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:/"):
        path = "/" + path[6:].lstrip("/")
    return pa.fs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    """The folder in which a task's files have their names below the table. The names aren't sent: there may be millions."""

    folder: str


class CommittedWriter(DataSourceArrowWriter):
    """What the formats share: a task's folder, and the commit."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex

    def _task_folder(self) -> tuple[pa.fs.FileSystem, str]:
        fs, root = filesystem(self.path)
        folder = f"{root}/_temporary/{self.job}/{uuid.uuid4().hex}"
        fs.create_dir(folder, recursive=True)
        return fs, folder

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        if self.overwrite:
            for x in fs.get_file_info(pa.fs.FileSelector(root)):
                if x.base_name != "_temporary":
                    fs.delete_dir(x.path) if x.type == pa.fs.FileType.Directory else fs.delete_file(x.path)
        for m in messages:
            if m is not None:
                _merge(fs, m.folder, root)
        self._clean(fs, root)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clean(*filesystem(self.path))

    def _clean(self, fs: pa.fs.FileSystem, root: str) -> None:
        if fs.get_file_info(f"{root}/_temporary/{self.job}").type != pa.fs.FileType.NotFound:
            fs.delete_dir(f"{root}/_temporary/{self.job}")
        if not fs.get_file_info(pa.fs.FileSelector(f"{root}/_temporary", allow_not_found=True)):  # no other job writes here
            if fs.get_file_info(f"{root}/_temporary").type != pa.fs.FileType.NotFound:
                fs.delete_dir(f"{root}/_temporary")


def _merge(fs: pa.fs.FileSystem, source: str, target: str) -> None:
    """Moves what lies in a folder into another; a folder that the other lacks in one piece, where the file system can."""
    for x in fs.get_file_info(pa.fs.FileSelector(source)):
        to = f"{target}/{x.base_name}"
        if x.type == pa.fs.FileType.Directory and (fs.type_name not in ("local", "hdfs") or fs.get_file_info(to).type == pa.fs.FileType.Directory):
            fs.create_dir(to, recursive=True)
            _merge(fs, x.path, to)
        else:
            fs.move(x.path, to)


class ChunkWriter(CommittedWriter):
    """Rows (tissue, chrom, chunk, ...) sorted by these. A row without ``Start`` holds its chromosome's place: a file is
    made, if need be one without rows, so that "no signal" and "not written" differ."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = self._task_folder()
        writer = sink = where = None
        chunks: list[int] = []
        held: list[pa.RecordBatch] = []
        part = f"{folder}/_part"

        def flush() -> None:
            if held:
                table = pa.Table.from_batches(held).drop_columns(["tissue", "chrom"])
                chunks.append(table.column("chunk")[0].as_py())
                writer.write_table(table.cast(writer.schema), row_group_size=len(table))
                held.clear()

        def close() -> None:
            if writer is not None:
                flush()
                writer.add_key_value_metadata({CHUNK_KEY: json.dumps(chunks).encode()})
                writer.close()
                sink.close()
                tissue, chrom = (NO_VALUE if x is None else quote(x, safe=" ,;()&@!$'-._~+") for x in where)
                span = f"{chunks[0]:08d}-{chunks[-1]:08d}" if chunks else "none"
                fs.create_dir(f"{folder}/tissue={tissue}/chrom={chrom}", recursive=True)
                fs.move(part, f"{folder}/tissue={tissue}/chrom={chrom}/chunks-{span}-{uuid.uuid4().hex[:12]}.parquet")

        for goes_on, b, i, j in _segments(iterator, 3):
            if not goes_on:
                key = (b.column(0)[i].as_py(), b.column(1)[i].as_py())
                if key != where:
                    close()
                    where, chunks = key, []
                    sink = fs.open_output_stream(part)
                    schema = pa.schema([pa.field(f.name, f.type) for f in b.schema if f.name not in ("tissue", "chrom")])
                    writer = pq.ParquetWriter(sink, schema, compression="zstd")
                flush()
            piece = b.slice(i, j - i)
            piece = piece.filter(piece.column("Start").is_valid())
            if len(piece):
                held.append(piece)
        close()
        return Written(folder)


class TextWriter(CommittedWriter):
    """Rows (file, value), those of one file next to each other; ``ending`` follows each value."""

    def __init__(self, path: str, overwrite: bool, ending: str):
        super().__init__(path, overwrite)
        self.ending = ending

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = self._task_folder()
        sink = inside = None
        for goes_on, b, i, j in _segments(iterator, 1):
            name = b.column(0)[i].as_py()
            if not goes_on:
                if sink is not None:
                    sink.close()
                if name.startswith("/") or ".." in name.split("/"):
                    raise ValueError(f"not a name below the table: {name}")
                target = f"{folder}/{name}"
                if (parent := target.rpartition("/")[0]) != inside:
                    fs.create_dir(parent, recursive=True)
                    inside = parent
                sink = fs.open_output_stream(target, compression=None)
            sink.write("".join(f"{x}{self.ending}" for x in b.column(1).slice(i, j - i).to_pylist() if x is not None).encode())
        if sink is not None:
            sink.close()
        return Written(folder)


class ChunkFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "genoweave_chunks"

    def writer(self, schema, overwrite: bool) -> ChunkWriter:
        if schema.fieldNames()[:3] != ["tissue", "chrom", "chunk"]:
            raise ValueError("columns must begin with tissue, chrom, chunk")
        return ChunkWriter(self.options["path"], overwrite)


class TextFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "genoweave_text"

    def writer(self, schema, overwrite: bool) -> TextWriter:
        return TextWriter(self.options["path"], overwrite, self.options.get("ending", "\n"))


_REGISTERED: set[str] = set()


def register(spark: SparkSession) -> SparkSession:
    """Makes the formats known to a session's application, once."""
    if spark.sparkContext.applicationId not in _REGISTERED:
        for source in (ChunkFiles, TextFiles):
            spark.dataSource.register(source)
        _REGISTERED.add(spark.sparkContext.applicationId)
    return spark


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length) of all files below a folder whose names fit a pattern; no file is opened."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "length")


def tree(spark: SparkSession, path: str, pattern: str = "*", *, read: bool = False) -> DataFrame:
    """(path) of all files below a folder whose names fit a pattern, or (path, value) with their whole text, for trees of very many files.

    Tasks list and read: one the folder itself, the others what lies below the folders in it. The driver gets no names, as it does
    where Spark lists files. Names that begin with ``_`` or ``.`` don't count.
    """

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            yield from _batches(_inside(*filesystem(path)), ["path", "folder"])

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = filesystem(path)[0]
        found = (x for b in batches for name, folder in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for x in (_walk(fs, name) if folder else [name]))
        fit = (x for x in found if fnmatchcase(x.rpartition("/")[2], pattern))
        yield from _batches(((x, _text(fs, x)) for x in fit) if read else ((x,) for x in fit), ["path", "value"][: 1 + read])

    names = spark.range(0, 1, 1, 1).mapInArrow(top, "path string, folder boolean").repartition("path")
    return names.mapInArrow(below, "path string, value string" if read else "path string")


def _inside(fs: pa.fs.FileSystem, folder: str) -> Iterator[tuple[str, bool]]:
    """(path, is a folder) of what lies in a folder; of a local one entry by entry, however many there are."""
    if fs.type_name == "local":
        with os.scandir(folder) as entries:
            yield from ((x.path, x.is_dir()) for x in entries if x.name[0] not in "_.")
    else:
        yield from ((x.path, x.type == pa.fs.FileType.Directory) for x in fs.get_file_info(pa.fs.FileSelector(folder)) if x.base_name[0] not in "_.")


def _walk(fs: pa.fs.FileSystem, folder: str) -> Iterator[str]:
    for name, is_folder in _inside(fs, folder):
        yield from _walk(fs, name) if is_folder else [name]


def _text(fs: pa.fs.FileSystem, file: str) -> str:
    with fs.open_input_stream(file, compression=None) as f:
        return f.read().decode(errors="replace")


def _batches(rows: Iterator[tuple], names: list[str], most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows whose last column may hold long text, in batches of some megabytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + (len(row[-1]) if isinstance(row[-1], str) else 0)
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held, strict=True)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held, strict=True)], names=names)


FOOTER = "tissue string, chrom string, file string, listed array<long>, groups array<struct<rows: long, first_chunk: long, last_chunk: long, least_start: long, most_end: long>>"


def footers(spark: SparkSession, path: str) -> DataFrame:
    """A row for each file of chunks: the chunks that its footer lists, and what its row groups' statistics say.

    Tasks read footers alone, never rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for file in b.column(0).to_pylist():
                fs, inner = filesystem(file)
                with fs.open_input_file(inner) as f:
                    meta = pq.read_metadata(f)
                listed = json.loads((meta.metadata or {}).get(CHUNK_KEY, b"[]"))
                at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
                groups = []
                for g in range(meta.num_row_groups):
                    chunk, start, end = (meta.row_group(g).column(at[c]).statistics for c in ("chunk", "Start", "End"))
                    groups.append({"rows": meta.row_group(g).num_rows, "first_chunk": chunk.min, "last_chunk": chunk.max, "least_start": start.min, "most_end": end.max})
                keys = dict(x.split("=", 1) for x in inner.split("/")[-3:-1])
                tissue, chrom = (None if keys[k] == NO_VALUE else unquote(keys[k]) for k in ("tissue", "chrom"))
                rows.append({"tissue": tissue, "chrom": chrom, "file": file, "listed": listed, "groups": groups})
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW_FOOTER)

    return listing(spark, path, "*.parquet").select("path").mapInArrow(read, FOOTER)


ARROW_FOOTER = pa.schema(
    [
        ("tissue", pa.string()), ("chrom", pa.string()), ("file", pa.string()), ("listed", pa.list_(pa.int64())),
        ("groups", pa.list_(pa.struct([(k, pa.int64()) for k in ("rows", "first_chunk", "last_chunk", "least_start", "most_end")]))),
    ]
)


def write_chunks(omics: DataFrame, path: str, expected: DataFrame | None = None) -> None:
    """Signal by chunk in the exact layout. ``expected`` (tissue, chrom) get a file even without rows.

    Rows are dealt by ranges of (tissue, chrom, chunk), so a large chromosome is spread over tasks, a chunk never.
    """
    order = ["tissue", "chrom", "chunk"]
    body = [c for c in omics.columns if c not in order]
    df = omics.select(*order, *body)
    if expected is not None:
        marks = expected.select("tissue", "chrom").distinct().select("tissue", "chrom", F.lit(-1).cast("long").alias("chunk"))
        df = df.unionByName(marks, allowMissingColumns=True)
    df = df.repartitionByRange(*order).sortWithinPartitions(*order, "Start", "End", "feature_name")
    register(omics.sparkSession)
    df.write.format("genoweave_chunks").mode("overwrite").option("path", path).save()


def write_text(rows: DataFrame, path: str, *, ending: str = "\n", order: tuple[str, ...] = ()) -> None:
    """A text file for each name of rows (file, value), their values in ``order`` (columns of the rows; none: by value)."""
    register(rows.sparkSession)
    df = rows.repartitionByRange("file").sortWithinPartitions("file", *(order or ("value",))).select("file", "value")
    df.write.format("genoweave_text").mode("overwrite").option("path", path).option("ending", ending).save()
