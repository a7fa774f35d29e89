"""Statistics: counts per source, crawl-session statistics, recent sessions, progress.

AGG-1/2/6 counts, AGG-3 + SNK-4 session statistics, ORD-1 top-k, AGG-4/7 progress fold,
STR-6 event counts.  All aggregations combine map-side (those with ``max_by`` over a struct sort
first), so a source holding a third of the events costs one partial row per task, not a hot task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Event names of the crawl feed, and the given events table's stand-ins.
EVENT_NAMES = {
    "signup": "crawl_started",
    "view": "property_extracted",
    "click": "property_enriched",
    "purchase": "crawl_completed",
    "error": "crawl_failed",
}
# The same stand-ins read as labelled outcomes of a session's pages and links.
OUTCOME_NAMES = {
    "signup": "page_crawled",
    "view": "property_extracted",
    "click": "property_duplicate",
    "purchase": "crawl_completed",
    "error": "property_failed",
}


def count_by(df: DataFrame, key: str = "source") -> DataFrame:
    """AGG-1: rows per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def count_where(df: DataFrame, condition: Column) -> DataFrame:
    """AGG-2 / FLT-8: count of rows matching an equality filter (pushed to the scan)."""
    return df.filter(condition).agg(F.count(F.lit(1)).alias("count"))


def total_count(df: DataFrame) -> DataFrame:
    """AGG-2 / AGG-6: grand total."""
    return df.agg(F.count(F.lit(1)).alias("count"))


def crawl_events(events: DataFrame, names: dict = EVENT_NAMES) -> DataFrame:
    """SRC-6: the given ``events`` table as a crawl feed: ``(event_id, ts, source, session_id,
    event)``; one session per source and day."""
    name = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in names.items()])
    source = F.concat(F.lit("src"), F.col("user_id").cast("string"))
    return events.select(
        "event_id", "ts", source.alias("source"),
        F.concat(source, F.lit("/"), F.date_format(F.col("ts"), "yyyy-MM-dd")).alias("session_id"),
        name.alias("event"))


def session_stats(feed: DataFrame) -> DataFrame:
    """AGG-3: per crawl session, counters of labelled outcomes that follow their definitions
    (fixes Q5): pages fetched; listings extracted, failed, and already stored; total_items is the
    sum of those three.  Start, completion, failure of the session and enrichment count as none
    of them.  Status: completed > failed > running."""
    e = F.col("event")
    g = feed.groupBy("source", "session_id").agg(
        F.min("ts").alias("start_time"),
        F.max(F.when(e.isin("crawl_completed", "crawl_failed"), F.col("ts"))).alias("end_time"),
        F.count_if(e == "page_crawled").cast("bigint").alias("total_pages"),
        F.count_if(e == "property_extracted").cast("bigint").alias("successful_items"),
        F.count_if(e == "property_failed").cast("bigint").alias("failed_items"),
        F.count_if(e == "property_duplicate").cast("bigint").alias("duplicate_items"),
        F.max((e == "crawl_completed").cast("int")).alias("_done"),
        F.max((e == "crawl_failed").cast("int")).alias("_failed"),
    )
    status = (F.when(F.col("_done") == 1, F.lit("completed"))
              .when(F.col("_failed") == 1, F.lit("failed")).otherwise(F.lit("running")))
    return g.select(
        "session_id", "source", "start_time", "end_time", "total_pages",
        (F.col("successful_items") + F.col("failed_items") + F.col("duplicate_items")).alias("total_items"),
        "successful_items", "failed_items", "duplicate_items", status.alias("status"),
        F.when(F.col("_failed") == 1, F.lit("crawl failed")).alias("error_message"))


def completed_sessions(stats: DataFrame) -> DataFrame:
    """SNK-4: only completed sessions are stored."""
    return stats.filter(F.col("status") == "completed")


def append_sessions(stats: DataFrame, path: str) -> None:
    """SNK-4: append the statistics of completed sessions to the table at ``path``."""
    completed_sessions(stats).write.mode("append").parquet(path)


def recent_sessions(stats: DataFrame, k: int = 10) -> DataFrame:
    """ORD-1: the k latest sessions by start time (tie-broken), a TakeOrderedAndProject."""
    return stats.orderBy(F.col("start_time").desc(), F.col("source"), F.col("session_id")).limit(k)


def progress_for(feed: DataFrame, source: str | None = None) -> DataFrame:
    """AGG-7: progress of one source (filter pushed to the feed) or of all sources."""
    return progress(feed if source is None else feed.filter(F.col("source") == source))


def progress(feed: DataFrame) -> DataFrame:
    """AGG-4: per-source progress, the fold of the reference's observer as aggregates.

    status is set by the latest start/complete/fail event (idle if none); processed counts
    extracted items since the latest start; end_time is the latest complete/fail event.
    Two aggregations and a join on source (one row per source on the small side).
    """
    e = F.col("event")
    order = F.struct("ts", "event_id")
    life = F.when(e.isin("crawl_started", "crawl_completed", "crawl_failed"), e)
    first = feed.groupBy("source").agg(
        F.max(F.when(e == "crawl_started", F.col("ts"))).alias("start_time"),
        F.max(F.when(e.isin("crawl_completed", "crawl_failed"), F.col("ts"))).alias("end_time"),
        F.max_by(life, F.when(life.isNotNull(), order)).alias("_last"),
        F.count_if(e == "property_extracted").cast("bigint").alias("total_items"),
    )
    status = (F.when(F.col("_last") == "crawl_started", F.lit("running"))
              .when(F.col("_last") == "crawl_completed", F.lit("completed"))
              .when(F.col("_last") == "crawl_failed", F.lit("failed"))
              .otherwise(F.lit("idle")))
    starts = first.select(F.col("source").alias("_s"), F.col("start_time").alias("_start"))
    since = (feed.join(starts, F.col("source").eqNullSafe(F.col("_s")), "inner")
             .groupBy(F.col("source").alias("_s"))
             .agg(F.count_if((e == "property_extracted") &
                             (F.col("_start").isNull() | (F.col("ts") > F.col("_start"))))
                  .cast("bigint").alias("processed_items")))
    # null-safe joins: events without a source form their own group instead of vanishing
    return (first.join(since, F.col("source").eqNullSafe(F.col("_s")), "inner")
            .select("source", status.alias("status"), "processed_items", "total_items",
                    "start_time", "end_time"))


def event_counts(feed: DataFrame) -> DataFrame:
    """STR-6: event counts per source and type (the log lines' numbers)."""
    return feed.groupBy("source", "event").agg(F.count(F.lit(1)).alias("count"))
