"""Tables in, and intermediate tables in the folder that all executors share.

Iterative operators cut their lineage by writing a table to the folder named in
``spark.checkpoint.dir`` and reading it back. Every copy is on shared storage,
so losing an executor loses nothing.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_fallback: dict[str, str] = {}
_bases: list[tuple[SparkSession, str]] = []
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives this package to the Python workers of every executor, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        package = Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='siteweave-code-')}/siteweave", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in local mode where that is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local[") and master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = "file://" + tempfile.mkdtemp(prefix="siteweave-")
    return _fallback[app]


class Scratch:
    """Intermediate tables of one operator run.

    ``cut`` writes a frame and returns it as read back; ``drop`` deletes a table
    that later steps no longer read. What the returned result still reads stays.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        ship(spark)
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        self.n = 0
        self.paths: dict[int, str] = {}
        if not _bases:
            atexit.register(clean_up)
        _bases.append((spark, self.base))

    def cut(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n:04d}"
        df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *frames: DataFrame | None) -> None:
        for frame in frames:
            path = self.paths.pop(id(frame), None) if frame is not None else None
            if path:
                _delete(self.spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def clean_up() -> None:
    """Deletes every intermediate table of this process, results that still read them included; runs when the process ends, and may be called before a session is stopped."""
    while _bases:
        spark, base = _bases.pop()
        try:
            _delete(spark, base)
        except Exception:  # noqa: BLE001 - the session is gone already; the folder is then the cluster's to clear
            return
