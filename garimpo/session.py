"""Session settings and shipping of the package to the executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(app: str = "garimpo", **more: str) -> SparkSession:
    """A session with the engine's settings; `more` overrides or adds to them."""
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder of the session, from spark.checkpoint.dir.

    Where it is unset and the master is local (tests), a temporary folder is
    used; on a cluster an unset folder is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="garimpo-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{base}")
    return f"file://{base}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: computed once, survives lost executors."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/garimpo/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file(spark: SparkSession, uri: str) -> tuple:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, uri: str) -> str | None:
    """A small file of any file system that Spark knows; None if it isn't there."""
    path, files = _file(spark, uri)
    return "\n".join(r.value for r in spark.read.text(uri).collect()) if files.exists(path) else None


def replace_text(spark: SparkSession, uri: str, text: str) -> None:
    """A small file written beside and moved into place, so a reader never sees half of it."""
    path, files = _file(spark, uri)
    beside, _ = _file(spark, f"{uri}.new")
    out = files.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(path, False)
    files.rename(beside, path)


def clean(spark: SparkSession) -> None:
    """Deletes the written tables of the shared folder; their DataFrames can't be read afterwards."""
    path, files = _file(spark, f"{work_dir(spark)}/garimpo")
    files.delete(path, True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="garimpo-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(os.path.join(folder, package.name), "zip", package.parent, package.name))
    _shipped.add(context.applicationId)
