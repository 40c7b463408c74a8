"""Releases: dated, self-describing folders with a manifest, and what readers ask of them.

A release is written once. Its manifest is a small JSON file; stages that finish at the same time each add a version to it, by
exclusive creation, and the last version is put in its place by rename. ``latest`` is a text
file that names the promoted release, so promotion is one rename on any file system.
"""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.functions.names import check_release_id
from genoweave.operators import omics
from genoweave.sources import readers, sinks

LAYOUT = 1
#: Where a release keeps each part, below its folder.
PATHS = {
    "groups": "groups", "lookup": "lookup", "tracks": "tracks", "pan": "pan_tracks", "sizes": "chrom_sizes", "grid": "chunk_grid", "windows": "windows/{window}", "omics": "omics", "dna": "dna",
    "pairs": "pairs", "weights": "weights", "vocabulary": "vocabulary",
}


class Release:
    """One release of one assembly below ``root``."""

    def __init__(self, spark: SparkSession, root: str, org: str, release: str, manifest: dict):
        self.spark, self.root, self.org, self.release, self.manifest = spark, root.rstrip("/"), org, release, manifest

    @property
    def folder(self) -> str:
        return f"{self.root}/{self.org}/{self.release}"

    @classmethod
    def create(cls, spark: SparkSession, root: str, org: str, release: str, **facts) -> Release:
        """A new, empty release; one that exists is refused."""
        check_release_id(release)
        if readers._exists(spark, f"{root}/{org}/{release}/MANIFEST.json"):
            raise FileExistsError(f"{org} {release} exists")
        made = cls(spark, root, org, release, {"layout_version": LAYOUT, "org": org, "release": release, "created": datetime.now(UTC).isoformat(timespec="seconds"), "paths": PATHS, "stages": {}, **facts})
        sinks.put_text(spark, f"{made.folder}/MANIFEST.json", json.dumps(made.manifest, indent=1))
        return made

    @classmethod
    def open(cls, spark: SparkSession, root: str, org: str, release: str | None = None) -> Release:
        """A given release, or the promoted one, or the last by name; another layout version is refused."""
        release = resolve_release(spark, root, org, release)
        manifest = json.loads(sinks.get_text(spark, f"{root}/{org}/{release}/MANIFEST.json"))
        if manifest.get("layout_version") != LAYOUT:
            raise ValueError(f"layout version {manifest.get('layout_version')}, not {LAYOUT}")
        return cls(spark, root, org, release, manifest)

    def record(self, stage: str, **facts) -> None:
        """Note that a stage is done. Stages that others note at the same time are kept, as each note is a new version of the
        manifest that must follow the last one: whoever finds its number taken reads the newer version and tries again."""
        done = {stage: {"done": datetime.now(UTC).isoformat(timespec="seconds"), **facts}}
        while True:
            version, now = _latest(self.spark, self.folder)
            own = {k: v for k, v in self.manifest.items() if k != "stages"}
            now |= own | {"stages": now.get("stages", {}) | done}
            if sinks.put_new(self.spark, f"{self.folder}/manifest/{version + 1:06d}.json", json.dumps(now, indent=1)):
                break
        self.manifest = now
        while True:  # the file that readers open is the last version, whoever writes it
            version, now = _latest(self.spark, self.folder)
            sinks.put_text(self.spark, f"{self.folder}/MANIFEST.json", json.dumps(now, indent=1))
            if _latest(self.spark, self.folder)[0] == version:
                return

    def has(self, stage: str) -> bool:
        return stage in self.manifest["stages"]

    def require(self, *stages: str) -> None:
        missing = [s for s in stages if not self.has(s)]
        if missing:
            raise RuntimeError(f"{self.org} {self.release} has no {', '.join(missing)}")

    def path(self, part: str, **fields) -> str:
        return f"{self.folder}/{self.manifest['paths'][part].format(**fields)}"

    def table(self, part: str, **fields) -> DataFrame:
        path = self.path(part, **fields)
        if part == "omics":
            return readers.read_omics(self.spark, path)
        return readers.read_tracks(self.spark, path) if part in ("tracks", "pan") else self.spark.read.parquet(path)

    # what readers ask
    def load_chunk(self, tissue: str, chrom: str, chunk: int) -> DataFrame:
        return omics.load_chunk(self.table("omics"), tissue, chrom, chunk)

    def load_window(self, tissue: str, chrom: str, begin: int, end: int) -> DataFrame:
        return omics.load_window(self.table("omics"), tissue, chrom, begin, end, self.manifest.get("chunk_size", omics.CHUNK))

    def empty_omics(self) -> DataFrame:
        return self.spark.createDataFrame([], omics.SCHEMA)

    def dna(self, chrom: str, begin: int, end: int) -> DataFrame:
        return omics.dna_window(self.table("dna"), chrom, begin, end)

    def windows(self, window: int, split: str | None = None, tissue: str | None = None) -> DataFrame:
        df = self.table("windows", window=window)
        for column, value in (("split", split), ("tissue", tissue)):
            if value is not None:
                df = df.filter(F.col(column) == value)
        return df

    def _vocabulary(self, name: str):
        return json.loads(sinks.get_text(self.spark, f"{self.path('vocabulary')}/{name}.json"))

    def tissues(self) -> list[dict]:
        return self._vocabulary("tissues")

    def features(self) -> list[str]:
        return self._vocabulary("features")["features"]

    def availability(self) -> dict[str, list[str]]:
        return self._vocabulary("availability")


def _latest(spark: SparkSession, folder: str) -> tuple[int, dict]:
    """The number and the content of a manifest's last version; 0 for the one that a release begins with."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(f"{folder}/manifest")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
    last = max((n for n in names if n.endswith(".json") and n[0].isdigit()), default=None)
    return int(last[:6]) if last else 0, json.loads(sinks.get_text(spark, f"{folder}/manifest/{last}" if last else f"{folder}/MANIFEST.json"))


def list_releases(spark: SparkSession, root: str, org: str) -> list[str]:
    """Names of all releases of an assembly, sorted."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{root}/{org}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if readers._exists(spark, f"{root}/{org}/{n}/MANIFEST.json"))


def resolve_release(spark: SparkSession, root: str, org: str, release: str | None = None) -> str:
    """The id asked for, else the promoted one, else the last by name; none at all is an error."""
    known = list_releases(spark, root, org)
    if release is None and readers._exists(spark, f"{root}/{org}/latest.txt"):
        release = sinks.get_text(spark, f"{root}/{org}/latest.txt").strip()
    release = release or (known[-1] if known else None)
    if release not in known:
        raise FileNotFoundError(f"no release {release or ''} of {org}")
    return release


def promote(spark: SparkSession, root: str, org: str, release: str) -> None:
    """Make a release the one that readers get by default; it must have been verified."""
    found = Release.open(spark, root, org, release)
    found.require("verify")
    sinks.put_text(spark, f"{root}/{org}/latest.txt", release)


def adopt(release: Release, groups: DataFrame, tracks: DataFrame) -> None:
    """Take groups and tracks into a release as its own copy, so later runs can't change what was released."""
    groups.coalesce(1).write.mode("overwrite").parquet(release.path("groups"))
    sinks.write_tracks(tracks, release.path("tracks"))
    release.record("adopt", groups=groups.count())
