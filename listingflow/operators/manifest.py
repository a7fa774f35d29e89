"""Commits of several folders at once: a list of numbered manifests that readers follow.

Writers put files into new folders and then add one manifest, which names everything that is live
from then on.  A reader takes the newest manifest, so it sees all of a commit or nothing, and files
of a job that died before its manifest are never read.  A manifest also holds the last batch that
every job has applied: a batch that is run again after its commit is recognised and skipped.

A manifest is made with the file system's exclusive create, so of two writers one fails and can try
again on what the other left; a manifest that was cut short does not parse and is passed over.
"""

from __future__ import annotations

import json
import os
import uuid
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .store import latest_per_key

EMPTY = {"version": 0, "applied": {}}


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def child_sizes(spark: SparkSession, folder: str) -> dict[str, int]:
    """Bytes under every direct child of ``folder`` (none if it is not there)."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return {}
    return {s.getPath().getName(): fs.getContentSummary(s.getPath()).getLength() for s in fs.listStatus(p)}


def _versions(spark: SparkSession, root: str) -> list[int]:
    fs, p = _fs(spark, os.path.join(root, "_manifest"))
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))


def read_manifest(spark: SparkSession, root: str) -> dict:
    """The newest whole manifest under ``root``."""
    for version in reversed(_versions(spark, root)):
        fs, p = _fs(spark, os.path.join(root, "_manifest", f"v{version:010d}.json"))
        stream = fs.open(p)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except json.JSONDecodeError:
            continue
    return json.loads(json.dumps(EMPTY))


def commit(spark: SparkSession, root: str, manifest: dict) -> dict:
    """Make ``manifest`` (read from ``root`` and changed) the newest; raises if another was added meanwhile."""
    version = max([manifest["version"], *_versions(spark, root)[-1:]]) + 1
    if read_manifest(spark, root)["version"] != manifest["version"]:
        raise RuntimeError(f"{root} was changed by another writer")
    out = {**manifest, "version": version}
    fs, p = _fs(spark, os.path.join(root, "_manifest", f"v{version:010d}.json"))
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(json.dumps(out).encode()))
    finally:
        stream.close()
    return out


def applied(manifest: dict, job: str, batch_id: int) -> bool:
    return manifest["applied"].get(job, -1) >= batch_id


# ------------------------------------------------------------------ append and fan-out (SNK-2, SNK-4, SNK-8)
def append_once(sinks: dict[str, DataFrame], root: str, job: str, batch_id: int, before_commit: Callable[[], None] | None = None) -> bool:
    """Append a batch's rows to one or several sinks, visible together and once.

    False if the batch was there already.  ``batch_id`` must grow per ``job``, as a stream's does."""
    spark = next(iter(sinks.values())).sparkSession
    manifest = read_manifest(spark, root)
    if applied(manifest, job, batch_id):
        return False
    folder = os.path.join("data", f"{job}-{batch_id}-{uuid.uuid4().hex}")
    for name, rows in sinks.items():
        rows.write.parquet(os.path.join(root, folder, name))
    if before_commit:
        before_commit()
    live = manifest.setdefault("sinks", {})
    for name, rows in sinks.items():
        live.setdefault(name, {"schema": rows.schema.json(), "folders": []})["folders"].append(os.path.join(folder, name))
    manifest["applied"][job] = batch_id
    commit(spark, root, manifest)
    return True


def read_sink(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All committed rows of a sink."""
    sink = read_manifest(spark, root).get("sinks", {}).get(name)
    if sink is None:
        raise ValueError(f"no batch of sink {name!r} was committed under {root}")
    schema = T.StructType.fromJson(json.loads(sink["schema"]))
    return spark.read.schema(schema).parquet(*[os.path.join(root, f) for f in sink["folders"]])


def read_keyed(spark: SparkSession, root: str, name: str, key: str, order_cols: Sequence[str]) -> DataFrame:
    """A sink as an upsert by ``key``: the newest committed row of each (SNK-8's listing sink)."""
    return latest_per_key(read_sink(spark, root, name), key, order_cols)
