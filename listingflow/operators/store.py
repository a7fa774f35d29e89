"""Keyed-table maintenance: append-unique, upsert, latest-per-key, site state (SNK-1…9, WIN-1).

Tables are plain parquet snapshots.  An upsert is computed as a new DataFrame and written to a
*new* snapshot directory (never over a path being read); readers switch to it afterwards.
Latest-per-key uses ``max_by`` aggregation, which combines map-side, so a key holding a third
of all rows never lands whole in one task (a ``row_number`` window would).
"""

from __future__ import annotations

import os
import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, order_cols: Sequence[str]) -> DataFrame:
    """WIN-1: the row with the greatest ``order_cols`` (lexicographic) per ``key``.

    Ties on every ordering column are broken by a hash of the row, so the result is
    deterministic under task retry and the ordering stays a few bytes wide.
    """
    payload = F.struct(*[F.col(c) for c in df.columns if c != key])
    ordering = F.struct(*[F.col(c) for c in order_cols], F.xxhash64(*df.columns))
    return (df.groupBy(key)
            .agg(F.max_by(payload, ordering).alias("_r"))
            .select(key, *[F.col("_r." + c).alias(c) for c in df.columns if c != key])
            .select(*df.columns))


def append_unique(store: DataFrame, batch: DataFrame, key: str = "link") -> DataFrame:
    """SNK-1: each batch row with status 'inserted' or 'duplicate' (key already stored or
    repeated earlier in the batch by a smaller ``id``).  Exactly one row per new key is inserted:
    null ids come last, and rows with equal ids count in scan order."""
    known = store.select(F.col(key).alias("_kkey")).distinct().withColumn("_known", F.lit(True))
    batch = batch.withColumn("_row", F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("b"),
                                              F.monotonically_increasing_id().alias("c")))
    first = batch.groupBy(F.col(key).alias("_fkey")).agg(F.min("_row").alias("_first"))
    # null-safe joins: a batch row with a null key is kept and labelled, never dropped
    j = (batch.join(known, F.col(key).eqNullSafe(F.col("_kkey")), "left")
         .join(first, F.col(key).eqNullSafe(F.col("_fkey")), "inner"))
    dup = F.coalesce(F.col("_known"), F.lit(False)) | ~F.col("_row").eqNullSafe(F.col("_first"))
    return j.select(*[c for c in batch.columns if c != "_row"], F.when(dup, F.lit("duplicate")).otherwise(F.lit("inserted")).alias("status"))


def upsert(store: DataFrame, updates: DataFrame, key: str = "link", order_cols: Sequence[str] = ("crawled_at",),
           id_col: str = "id") -> DataFrame:
    """SNK-3 + JOIN-5: replace every field of a stored row by its latest update (nulls too),
    keep the stored id; new keys are inserted with their own id.  One full outer join: the
    store and the updates are each read once."""
    latest = latest_per_key(updates, key, list(order_cols)).select(*store.columns)
    new = latest.select(F.col(key).alias("_key"), F.struct(*store.columns).alias("_new"))
    hit = F.col("_new").isNotNull()
    return (store.join(new, F.col(key) == F.col("_key"), "full_outer")
            .select(*[(F.coalesce(F.col(id_col), F.col("_new." + id_col)) if c == id_col
                       else F.when(hit, F.col("_new." + c)).otherwise(F.col(c))).alias(c) for c in store.columns]))


def write_snapshot(df: DataFrame, root: str, partition_by: str = "source",
                   sort_within: Sequence[str] = ("city", "price")) -> str:
    """SNK-2/SNK-9: write a new snapshot directory under ``root`` and return its path.

    Layout replaces the reference's secondary indexes: partition pruning on ``source`` and
    parquet min/max skipping on the sorted columns.  Rows are rebalanced by source: small
    sources share no more tasks than they need and a hot source is split over several
    (``REBALANCE``, which Spark sizes at run time).  Writing a new directory each time makes the
    job safe to retry and never overwrites a path that is being read.
    """
    path = os.path.join(root, "data", "snapshot-" + uuid.uuid4().hex)
    cols = [c for c in sort_within if c in df.columns]
    out = df.hint("rebalance", F.col(partition_by)) if partition_by in df.columns else df
    if cols:
        out = out.sortWithinPartitions(*cols)
    writer = out.write.mode("errorifexists")
    if partition_by in df.columns:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    # the pointer row is appended only after the snapshot's files are committed, so a reader
    # of current_snapshot never sees a half-written table
    spark = df.sparkSession
    (spark.createDataFrame([(path,)], "path string")
     .select(F.current_timestamp().alias("written_at"), "path")
     .write.mode("append").parquet(os.path.join(root, "_pointer")))
    return path


def current_snapshot(spark, root: str) -> DataFrame:
    """The newest committed snapshot under ``root`` (the pointer table has one row per write)."""
    ptr = spark.read.parquet(os.path.join(root, "_pointer"))
    newest = ptr.orderBy(F.col("written_at").desc(), F.col("path").desc()).first()
    return spark.read.parquet(newest["path"])


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, sort: bool = True) -> str:
    """Store a big join side as a catalog table bucketed (and sorted) by its join key.

    Later joins on ``key`` read the table with its hash layout, so only the other, smaller side
    is shuffled: the page snapshots for JOIN-7 (frontier ⋈ snapshots, which carries ``html``) and
    the listing store for JOIN-2/3 (candidates ⋈ known links).  ``buckets`` should match the
    shuffle partitions of the joins that read it.  An existing table is never replaced (it may
    be being read): use a new name per version."""
    # by the same hash as the buckets, so each task writes one file
    w = df.repartition(buckets, key).write.mode("errorifexists").bucketBy(buckets, key)
    if sort:
        w = w.sortBy(key)
    w.saveAsTable(table)
    return table


def append_rows(df: DataFrame, path: str) -> str:
    """SNK-2: append documents to a named table directory (new files only, never rewrites)."""
    df.write.mode("append").parquet(path)
    return path


def duplicate_keys(df: DataFrame, key: str = "link") -> DataFrame:
    """SNK-9 uniqueness assertion: keys stored more than once (should be empty)."""
    return df.groupBy(key).count().filter(F.col("count") > 1)


# ------------------------------------------------------------------ website state (SNK-5/6/7, JOIN-8)
def state_seed(state: DataFrame, registry: DataFrame, now: Column) -> DataFrame:
    """SNK-7: add sites missing from the state table (enabled flag from the registry)."""
    missing = (registry.join(state.select("name"), "name", "left_anti")
               .select("name", F.coalesce(F.col("enabled"), F.lit(True)).alias("enabled"),
                       now.cast("timestamp_ntz").alias("updated_at")))
    return state.unionByName(missing)


def state_upsert(state: DataFrame, changes: DataFrame, now: Column) -> DataFrame:
    """SNK-5: set ``enabled`` for the named sites, inserting unknown names (upsert)."""
    ch = changes.select("name", F.col("enabled").alias("_new"), F.lit(True).alias("_hit"))
    j = state.join(ch, "name", "full_outer")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return j.select("name",
                    F.when(hit, F.col("_new")).otherwise(F.col("enabled")).alias("enabled"),
                    F.when(hit, now.cast("timestamp_ntz")).otherwise(F.col("updated_at")).alias("updated_at"))


def state_toggle(state: DataFrame, names: DataFrame, enabled: bool, now: Column) -> DataFrame:
    """SNK-6: enable/disable listed names that exist; unknown names are ignored.

    Returns the new state with a ``changed`` flag (the reference returns the changed names,
    i.e. ``filter(changed)``, a semi join of names with the state)."""
    hits = names.select("name").distinct().withColumn("_hit", F.lit(True))
    j = state.join(hits, "name", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return j.select("name",
                    F.when(hit, F.lit(enabled)).otherwise(F.col("enabled")).alias("enabled"),
                    F.when(hit, now.cast("timestamp_ntz")).otherwise(F.col("updated_at")).alias("updated_at"),
                    hit.alias("changed"))


def site_lookup(state: DataFrame, condition: Column) -> DataFrame:
    """JOIN-8 / FLT-8: point lookups and equality filters on the state table."""
    return state.filter(condition)
