"""Session factory and table access shared by every query."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "caselattice", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and a fixed time zone; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.legacy.javaCharsets": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Sends this package's sources to the executors once per context, so that workers can import it from anywhere."""
    sc = spark.sparkContext
    if getattr(sc, "_caselattice_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="caselattice-"), "caselattice_sources.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._caselattice_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a session in one process may lack it and get
    a folder of its own; on a cluster its executors would each write to their own disk."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if named:  # a path without a scheme is one of Hadoop's default store
        path = sc._jvm.org.apache.hadoop.fs.Path(named)
        return path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    if not re.match(r"local($|\[)", sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    if not getattr(sc, "_caselattice_shared", None):
        sc._caselattice_shared = "file://" + tempfile.mkdtemp(prefix="caselattice-shared-")
    return sc._caselattice_shared


def new_path(spark: SparkSession, label: str) -> str:
    """A path of the shared folder that nothing else uses; `release` deletes it."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    spark.sparkContext.__dict__.setdefault("_caselattice_written", []).append(path)
    return path


def stash(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends there and lost executors lose nothing."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, keep: int = 0, last: int = 0) -> int:
    """Deletes what this session has written to the shared folder, but for its first ``keep`` and its ``last`` paths, once
    results that read them are no longer needed. Gives the number of paths that stay."""
    written = spark.sparkContext.__dict__.setdefault("_caselattice_written", [])
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    end = max(len(written) - last, keep)
    for name in written[keep:end]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    del written[keep:end]
    return len(written)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
