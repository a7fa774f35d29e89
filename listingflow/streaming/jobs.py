"""Structured Streaming jobs (STR-1…6, SRC-6, SNK-8, UDF-4).

* ``ingest``   page files → rule-driven parse → typed listing, appended to a parquet sink
* ``dedup``    links not seen before: anti joins with the store and with the job's own output
* ``progress`` per-source running state (complete mode, written per micro-batch)
* ``route``    one cached micro-batch fanned out to several sinks by event type

Sinks and checkpoints live under the shared folder named by ``spark.checkpoint.dir`` (each run
gets its own sub-folder), never on a machine-local path.  Every sink writes to a directory
named by ``batchId`` with overwrite, so a replayed micro-batch after a failure rewrites the same
output instead of duplicating it.  Tests use ``trigger(availableNow=True)``.
"""

from __future__ import annotations

import os
import uuid
from typing import Callable, Dict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import enrich as EN
from ..operators import extract as EX
from ..operators import listing as LS
from ..operators import manifest as M
from ..operators import stats as S
from ..operators.delta_store import DeltaStore
from ..session import ensure_checkpoint_dir, is_file, path_exists


def run_dir(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex}")


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC-6 / SRC-2: a parquet file source with the schema taken from the files' footers."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if is_file(spark, path):                                     # a folder may be named like a file
        # a single file: watch its folder, keep only files with that exact name
        return reader.option("pathGlobFilter", os.path.basename(path)).parquet(os.path.dirname(path))
    return reader.parquet(path)


def _run(stream_writer, available_now: bool = True):
    q = (stream_writer.trigger(availableNow=True) if available_now else stream_writer).start()
    if available_now:
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return q


def batch_sink(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: ``path/batch=<id>``, overwritten on replay (idempotent)."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(os.path.join(path, f"batch={batch_id}"))
    return write


# ---------------------------------------------------------------- STR-1 ingest
def ingest(spark: SparkSession, pages_path: str, rules: EX.RuleSet, source_col,
           crawled_at, root: str) -> str:
    """Page snapshots as they arrive → typed listing rows appended under ``root/listing``."""
    pages = file_stream(spark, pages_path).select("page_id", "url", "html").withColumn("source", source_col)
    raw = EX.parse_detail_pages(pages, rules, phone=False).withColumn("crawled_at", crawled_at)
    typed = LS.normalise(raw)
    out = os.path.join(root, "listing")
    w = (typed.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(root, "_ckpt")).outputMode("append"))
    _run(w)
    return out


# ---------------------------------------------------------------- STR-1/2 + ENR + SNK-3
#: Micro-batches between two compactions of a delta store.
COMPACT_EVERY = 8


def listing_store(spark: SparkSession, root: str) -> DeltaStore:
    """The listing table of a stream: one row per link."""
    return DeltaStore(spark, root, LS.LISTING_SCHEMA, key="link", order_cols=("crawled_at",))


def ingest_enrich_upsert(spark: SparkSession, pages_path: str, rules: EX.RuleSet, source_col, crawled_at,
                         enricher, root: str, max_files_per_trigger: int | None = None, compact_every: int = COMPACT_EVERY) -> str:
    """The reference's main flow as a stream: each micro-batch of page snapshots is parsed,
    typed, enriched in batches (the end of a micro-batch is the final flush, STR-2) and upserted
    by link into the listing store, a log of deltas (``operators/delta_store``): a batch writes
    its own rows and nothing else, once, however often it is replayed."""
    pages = (file_stream(spark, pages_path, max_files_per_trigger)
             .select("page_id", "url", "html").withColumn("source", source_col))
    path = os.path.join(root, "store")
    store = listing_store(spark, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        if M.applied(store.manifest(), "ingest", batch_id):
            return                                               # replayed after its commit
        raw = EX.parse_detail_pages(batch, rules, phone=False).withColumn("crawled_at", crawled_at)
        if store.append(EN.enrich(LS.normalise(raw), enricher).drop("enriched"), "ingest", batch_id) and (batch_id + 1) % compact_every == 0:
            store.compact()

    _run(pages.writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(root, "_ckpt")))
    return path


def current_store(spark: SparkSession, store: str) -> DataFrame:
    """The rows of a listing store."""
    return listing_store(spark, store).read()


# ---------------------------------------------------------------- STR-3 dedup
#: Folders that a keyed stream output is cut into by the key's hash.
KEY_BUCKETS = 64


def _bucket(key: str):
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int")


def _touched(df: DataFrame) -> list:
    """The key buckets a micro-batch touches, at most ``KEY_BUCKETS``."""
    return [r["bucket"] for r in df.select("bucket").distinct().collect()]


def dedup_links(stream: DataFrame, store: DataFrame, root: str, key: str = "link") -> str:
    """STR-3 without a state store: each micro-batch is deduplicated with ``dropDuplicates``
    (combined map-side, so a link repeated by a third of the batch is not one hot task), then
    links already in the store or emitted by an earlier micro-batch are removed by anti joins.

    Exact over any time span: a link that first arrives late is kept, one that comes again after
    any pause is not.  The output is cut by link hash (``batch=<id>/bucket=<b>``), and a
    micro-batch reads only the buckets it touches.  A replayed batch rewrites the same folder."""
    out = os.path.join(root, "new_links")
    spark = stream.sparkSession
    known = store.select(key).distinct()

    def write(df: DataFrame, batch_id: int) -> None:
        fresh = (df.select(key).dropDuplicates([key]).join(known, key, "left_anti")
                 .withColumn("bucket", _bucket(key)).persist())
        try:
            new = fresh
            if path_exists(spark, out):
                earlier = read_all_batches(spark, out, fresh.schema).filter((F.col("batch") < batch_id) & F.col("bucket").isin(_touched(fresh)))
                new = fresh.join(earlier.select(F.col(key).alias("_k")), F.col(key).eqNullSafe(F.col("_k")), "left_anti")
            new.write.mode("overwrite").partitionBy("bucket").parquet(os.path.join(out, f"batch={batch_id}"))
        finally:
            fresh.unpersist()

    _run(stream.writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(root, "_ckpt")))
    return out


def dedup_into_store(stream: DataFrame, store: DeltaStore, root: str, job: str = "dedup", compact_every: int = COMPACT_EVERY) -> None:
    """STR-3 over a stored membership filter: each micro-batch's keys go to the store's sketches, the
    possible hits to an exact anti join with the buckets they fall into, and what is new is appended
    to the store, where the next micro-batch finds it.  The links of a run are the store's."""
    def write(df: DataFrame, batch_id: int) -> None:
        if M.applied(store.manifest(), job, batch_id):
            return
        store.append(store.unknown(df.select(store.key)), job, batch_id)
        if (batch_id + 1) % compact_every == 0:
            store.compact()

    _run(stream.writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(root, "_ckpt")))


# ---------------------------------------------------------------- STR-4/6 progress
def progress(feed: DataFrame, root: str) -> str:
    """Per-source running state in complete mode: status from the latest lifecycle event,
    start/end times, extracted items and event counts.  Each micro-batch writes the full state
    table to its own batch directory; the latest one is the answer."""
    e = F.col("event")
    life = F.when(e.isin("crawl_started", "crawl_completed", "crawl_failed"), e)
    order = F.struct("_et", "event_id")
    agg = (feed.withColumn("_et", F.col("ts").cast("timestamp"))
           .groupBy("source")
           .agg(F.max(F.when(e == "crawl_started", F.col("_et"))).alias("start_time"),
                F.max(F.when(e.isin("crawl_completed", "crawl_failed"), F.col("_et"))).alias("end_time"),
                F.max_by(life, F.when(life.isNotNull(), order)).alias("_last"),
                F.count_if(e == "property_extracted").cast("bigint").alias("total_items"),
                F.count(F.lit(1)).alias("n_events")))
    status = (F.when(F.col("_last") == "crawl_started", F.lit("running"))
              .when(F.col("_last") == "crawl_completed", F.lit("completed"))
              .when(F.col("_last") == "crawl_failed", F.lit("failed")).otherwise(F.lit("idle")))
    shaped = agg.select("source", status.alias("status"),
                        F.col("start_time").cast("timestamp_ntz").alias("start_time"),
                        F.col("end_time").cast("timestamp_ntz").alias("end_time"),
                        "total_items", "n_events")
    out = os.path.join(root, "progress")
    _run(shaped.writeStream.outputMode("complete").foreachBatch(batch_sink(out))
         .option("checkpointLocation", os.path.join(root, "_ckpt")))
    return out


def progress_fold(feed: DataFrame, root: str) -> str:
    """STR-4 exactly: the observer's per-source state machine (status, processed items since
    the latest start, totals, start/end) folded over micro-batches in arrival order.

    Each micro-batch is summarised per source with native aggregations (partial + final, so a
    hot source is not one task); the summary is merged with the previous state table — one
    row per source — and written to ``state/batch=<id>`` (a replay rewrites the same batch)."""
    state = os.path.join(root, "state")
    spark = feed.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        e = F.col("event")
        life = F.when(e.isin("crawl_started", "crawl_completed", "crawl_failed"), e)
        batch = batch.persist()
        try:
            summ = batch.groupBy("source").agg(
                F.max(F.when(e == "crawl_started", F.col("ts"))).alias("b_start"),
                F.max(F.when(e.isin("crawl_completed", "crawl_failed"), F.col("ts"))).alias("b_end"),
                F.max_by(life, F.when(life.isNotNull(), F.struct("ts", "event_id"))).alias("b_last"),
                F.count_if(e == "property_extracted").alias("b_views"),
                F.count(F.lit(1)).alias("b_events"))
            starts = summ.select(F.col("source").alias("_s"), "b_start")
            after = (batch.join(starts, F.col("source").eqNullSafe(F.col("_s")))
                     .groupBy("_s")
                     .agg(F.count_if((e == "property_extracted") &
                                     (F.col("b_start").isNull() | (F.col("ts") > F.col("b_start")))).alias("b_after")))
            summ = summ.join(after, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
            prev = _previous_state(spark, state, batch_id)
            if prev is not None:          # null-safe: a null source keeps one state row
                p = prev.withColumnRenamed("source", "_ps")
                j = (p.join(summ, F.col("_ps").eqNullSafe(F.col("source")), "full_outer")
                     .withColumn("source", F.coalesce(F.col("source"), F.col("_ps"))).drop("_ps"))
            else:
                j = summ
            col = (lambda c: F.col(c)) if prev is not None else (lambda c: F.lit(None))
            status = (F.when(F.col("b_last") == "crawl_started", F.lit("running"))
                      .when(F.col("b_last") == "crawl_completed", F.lit("completed"))
                      .when(F.col("b_last") == "crawl_failed", F.lit("failed"))
                      .otherwise(F.coalesce(col("status"), F.lit("idle"))))
            new = j.select(
                "source", status.alias("status"),
                F.when(F.col("b_start").isNotNull(), F.col("b_after"))
                 .otherwise(F.coalesce(col("processed_items"), F.lit(0)) + F.coalesce(F.col("b_views"), F.lit(0)))
                 .cast("bigint").alias("processed_items"),
                (F.coalesce(col("total_items"), F.lit(0)) + F.coalesce(F.col("b_views"), F.lit(0))).cast("bigint").alias("total_items"),
                F.coalesce(F.col("b_start"), col("start_time")).cast("timestamp_ntz").alias("start_time"),
                F.coalesce(F.col("b_end"), col("end_time")).cast("timestamp_ntz").alias("end_time"),
                (F.coalesce(col("n_events"), F.lit(0)) + F.coalesce(F.col("b_events"), F.lit(0))).cast("bigint").alias("n_events"))
            new.write.mode("overwrite").parquet(os.path.join(state, f"batch={batch_id}"))
        finally:
            batch.unpersist()

    _run(feed.writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(root, "_ckpt")))
    return state


def _batches(spark: SparkSession, out: str) -> list:
    """The batch ids under a sink folder, by listing it."""
    if not path_exists(spark, out):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    names = [f.getPath().getName() for f in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch="))


def _previous_state(spark: SparkSession, state: str, batch_id: int):
    """The state table written by the newest earlier micro-batch, or None before the first."""
    earlier = [b for b in _batches(spark, state) if b < batch_id]
    return spark.read.parquet(os.path.join(state, f"batch={earlier[-1]}")) if earlier else None


def latest_batch(spark: SparkSession, out: str) -> DataFrame:
    """The output of the newest micro-batch of a complete-mode sink."""
    return spark.read.parquet(os.path.join(out, f"batch={_batches(spark, out)[-1]}"))


# ---------------------------------------------------------------- STR-5 / SNK-8 / UDF-4 routing
def route(feed: DataFrame, routes: Dict[str, Callable[[DataFrame], DataFrame]], root: str) -> Dict[str, str]:
    """Fan one micro-batch out to several sinks (the reference's observers).  ``routes`` maps a
    sink name to a selection on the batch; the batch is cached once and unpersisted after."""
    outs = {name: os.path.join(root, name) for name in routes}

    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            for name, select in routes.items():
                select(df).write.mode("overwrite").parquet(os.path.join(outs[name], f"batch={batch_id}"))
        finally:
            df.unpersist()

    _run(feed.writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(root, "_ckpt")))
    return outs


def route_committed(feed: DataFrame, routes: Dict[str, Callable[[DataFrame], DataFrame]], root: str, job: str = "route") -> None:
    """``route`` with one commit for all sinks of a micro-batch: a reader (``manifest.read_sink``, or
    ``manifest.read_keyed`` for a sink that is upserted by key) sees all of them or none, and a
    replayed micro-batch adds nothing."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            M.append_once({name: select(df) for name, select in routes.items()}, root, job, batch_id)
        finally:
            df.unpersist()

    _run(feed.writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(root, "_ckpt")))


def default_routes() -> Dict[str, Callable[[DataFrame], DataFrame]]:
    """The reference's observer wiring: enriched listings → store, completed sessions →
    statistics, everything else → log counts."""
    return {
        "listings": lambda b: b.filter(F.col("event") == "property_enriched"),
        "sessions": lambda b: b.filter(F.col("event") == "crawl_completed"),
        # null-safe: an event without a type is logged too, never lost
        "log": lambda b: b.filter(~F.coalesce(F.col("event").isin("property_enriched", "crawl_completed"), F.lit(False)))
                          .groupBy("source", "event").count(),
    }


def read_all_batches(spark: SparkSession, out: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows of a sink with their ``batch``; with a ``schema`` also when every batch was empty."""
    if schema is None:
        return spark.read.parquet(out)
    return spark.read.schema(T.StructType(schema.fields + [T.StructField("batch", T.LongType())])).parquet(out)


def event_feed(spark: SparkSession, events_path: str) -> DataFrame:
    """The events table as a streaming crawl feed (SRC-6)."""
    return S.crawl_events(file_stream(spark, events_path).select("event_id", "ts", "user_id", "event_type"))

