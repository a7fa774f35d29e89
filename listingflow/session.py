"""Spark session helpers.

The library never relies on session settings it did not get: every query works on the
caller's session.  ``get_spark`` is for tests, benchmarks and scripts.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "listingflow", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("LISTINGFLOW_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster that setting must point at shared storage and is used as is.  Only a ``local``
    master may leave it unset (tests): its executors share this machine's disk, so a scratch
    folder is made and registered.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        context = spark.sparkContext
        current = context.getCheckpointDir()
        if not current:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            current = tempfile.mkdtemp(prefix="listingflow-ckpt-")
            context.setCheckpointDir(current)
        spark.conf.set("spark.checkpoint.dir", current)
    return current


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder under the shared checkpoint folder and read it back: several
    outputs can then be taken from one evaluation, and it survives lost executors."""
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def storable(df: DataFrame) -> bool:
    """Whether Parquet holds ``df`` as it is: no type without values of its own, no name twice."""
    names = [c.lower() for c in df.columns]
    return len(names) == len(set(names)) and not re.search(r"\b(void|interval)\b", " ".join(t for _, t in df.dtypes))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is at ``path``, on whatever file system it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether a single file is at ``path``: not a folder, whatever its name ends in."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so tasks can import it."""
    context = spark.sparkContext
    if getattr(context, "_listingflow_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="listingflow-zip-")), "listingflow.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._listingflow_shipped = True
