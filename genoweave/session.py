"""Session settings and the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build(app: str = "genoweave", **conf: str) -> SparkSession:
    """A session with adaptive execution; the cluster's own settings come from its configuration."""
    base = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.serializer": "org.apache.spark.serializer.KryoSerializer"}
    return SparkSession.builder.appName(app).config(map=base | {k.replace("__", "."): v for k, v in conf.items()}).getOrCreate()


_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, which ``spark.checkpoint.dir`` names.

    Where that is unset, a local session (tests) takes a temporary folder; on a cluster it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = _LOCAL.get("dir") or _LOCAL.setdefault("dir", tempfile.mkdtemp(prefix="genoweave-"))
    return root.rstrip("/")


def with_checkpoints(spark: SparkSession) -> SparkSession:
    """Makes ``checkpoint()`` usable, in the application's folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(own_dir(spark))
    return spark


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder, with a short lineage."""
    with_checkpoints(df.sparkSession)
    return df.checkpoint()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the package to the Python workers of this application, wherever they run and whatever their path is."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="genoweave-")) / "genoweave_package.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        context.addPyFile(str(target))
        _SHIPPED.add(context.applicationId)
    return spark


_MARKED: set[str] = set()


def own_dir(spark: SparkSession) -> str:
    """The application's own folder in the shared one. The driver's JVM removes it when it ends."""
    folder = f"{shared_dir(spark)}/genoweave-{spark.sparkContext.applicationId}"
    if folder not in _MARKED:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _MARKED.add(folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the application's folder, for tables that are written and read back."""
    return f"{own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the application's folder and read back.

    Spark plans with their true size; what is checkpointed keeps the size that was guessed for it, a product of all tables joined.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
