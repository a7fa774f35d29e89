"""Enrichment with a log of replies, so that no answered batch is asked again (ENR-6, ENR-7).

A model call is slow and costs money; a job that fails after half of its batches must not repeat
them.  Every batch has a hash of what is asked (``enrich.batch_records``).  ``ask_logged`` asks the
batches whose hash the log does not answer yet, in waves: each wave is one job that appends its
replies and errors to the log, visible only once the wave is committed.  A job that dies loses at
most the wave it was in, a lost executor at most its own task's batches, and a later run over the
same log asks only for what is missing.  A batch that raised stays in the log as an error, passes
through, and is asked again by the next run.

The log is a folder of Parquet files, ``run=<id>/wave=<n>``, that is only ever added to.  A batch
asked twice (two runs at once) has two entries; the newest answer counts.
"""

from __future__ import annotations

import os
import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import patterns as P
from ..session import path_exists, stage
from . import enrich as EN
from .batching import batch_ids

LOG_SCHEMA = T.StructType([
    T.StructField("batch_hash", T.StringType()), T.StructField("batch_key", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("error", T.StringType()), T.StructField("asked_at", T.TimestampType())])
#: Jobs that one run is cut into.
WAVES = 8


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """All entries; none if nothing was ever logged."""
    if not path_exists(spark, log):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(log)


def answers(log: DataFrame) -> DataFrame:
    """The newest answer per batch hash: ``(batch_hash, text)``."""
    return (log.filter(F.col("text").isNotNull()).groupBy("batch_hash")
            .agg(F.max_by("text", F.struct("asked_at", "text")).alias("text")))


def failures(log: DataFrame) -> DataFrame:
    """Batches that were asked and never answered: ``(batch_hash, batch_key, error, times)``."""
    e = log.groupBy("batch_hash").agg(F.max("batch_key").alias("batch_key"), F.max_by("error", F.struct("asked_at", "error")).alias("error"),
                                      F.count(F.lit(1)).alias("times"), F.max(F.col("text").isNotNull()).alias("_answered"))
    return e.filter(~F.col("_answered")).drop("_answered")


def ask_logged(requests: DataFrame, enricher: EN.Enricher, log: str, waves: int = WAVES) -> None:
    """Ask for every batch of ``requests`` (staged rows of ``batch_records``) that the log does not answer."""
    spark = requests.sparkSession
    run = os.path.join(log, f"run={uuid.uuid4().hex}")
    wave = F.pmod(F.xxhash64("batch_hash"), F.lit(waves))
    # one reading of the log decides for the whole run; its waves are disjoint
    answered = stage(read_log(spark, log).filter(F.col("text").isNotNull()).select("batch_hash").distinct(), "answered")
    todo = stage(requests.join(answered, "batch_hash", "left_anti"), "asked")
    for w in range(waves):
        replies = EN.ask(todo.filter(wave == w), enricher).withColumn("asked_at", F.current_timestamp())
        replies.select(*LOG_SCHEMA.names).write.mode("errorifexists").parquet(os.path.join(run, f"wave={w}"))


def enrich_logged(listing: DataFrame, enricher: EN.Enricher, log: str, group: str = "source", size: int = P.ENRICH_BATCH, as_of: str = "crawled_at",
                  request_cols: Sequence[str] = ("title", "description"), waves: int = WAVES, row_key: str | None = None, stored: bool = False) -> DataFrame:
    """``enrich`` over a reply log: answered batches are merged from the log, the others are asked first.
    A ``stored`` listing is read again where it is needed, not kept in memory."""
    batched = batch_ids(listing, group, ["link", "id"], size, row_key=row_key, stored=stored)
    base = batched.select(*listing.columns)
    requests = stage(EN.batch_records(batched, group, request_cols), "requests")
    ask_logged(requests, enricher, log, waves)
    mine = requests.select("batch_hash", "batch_key").join(answers(read_log(listing.sparkSession, log)), "batch_hash")
    return EN.merge_reply_items(base, EN.parse_replies(mine, "text", keep=["batch_key"]), ["batch_key", "pos"], as_of)
