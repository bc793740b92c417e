"""Session helpers: table access and the shared work folder."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []  # folders below the shared one


def build_session(app: str = "siftline", master: str = "local[*]", **conf: object) -> SparkSession:
    """A session with the settings that the operators assume (UTC, adaptive execution)."""
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.appName(app).master(master)
    for key, value in {**base, **{k: str(v) for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per context, so that their Python finds it whatever their path is."""
    sc = spark.sparkContext
    if getattr(sc, "_siftline_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="siftline-package-")
    atexit.register(shutil.rmtree, folder, True)
    target = os.path.join(folder, "siftline.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(Path("siftline") / f.relative_to(root)))
    sc.addPyFile(target)
    sc._siftline_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. In local mode a private one is made where the session names none; on a cluster that raises RuntimeError."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        jsc = spark.sparkContext._jsc.sc()
        known = jsc.getCheckpointDir()
        if known.isDefined():
            return known.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        private = tempfile.mkdtemp(prefix="siftline-")
        atexit.register(shutil.rmtree, private, True)
        conf = "file://" + private
        spark.sparkContext.setCheckpointDir(conf)
    elif not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(conf)
    return conf


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    at, fs = _fs(spark, path)
    return fs.exists(at)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of the shared file system; none if it does not exist."""
    at, fs = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, such as a mark that something is complete."""
    at, fs = _fs(spark, path)
    fs.create(at, True).close()


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    root = os.path.join(shared_dir(spark), f"siftline-{uuid.uuid4().hex}")
    _made.append(root)
    return os.path.join(root, name)


def clean_work(spark: SparkSession) -> int:
    """Deletes what this process wrote to the shared folder; results that still read from it must be saved before."""
    count = len(_made)
    for root in _made:
        path, fs = _fs(spark, root)
        fs.delete(path, True)
    _made.clear()
    return count


def collect_garbage(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files of finished steps now; else they stay until the driver's heap is next collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and survives executor loss."""
    spark = df.sparkSession
    path = work_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
