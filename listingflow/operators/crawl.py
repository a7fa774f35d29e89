"""The full crawl as one Spark job over stored pages (the reference's ``crawl_all``).

    result pages ─parse_list_pages─► links ─dedup─► ─left_anti(store)─► new links
        ─⋈ latest detail snapshot (JOIN-7)─► parse_detail_pages ─► normalise ─► split_valid
    every candidate link gets one outcome: success | failed | duplicate | not_fetched
    outcomes ─groupBy(source)─► session statistics (AGG-3), fixing the reference's counters (Q5)

The anti join runs *before* the HTML parse: Catalyst cannot move a join across
``mapInPandas``, so the order is explicit and known links are never parsed.  The candidate links
and the checked listings are each written once to the shared folder, and all outputs read them
from there, so every page is parsed once.
"""

from __future__ import annotations

from typing import Dict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import extract as EX
from . import listing as LS
from .links import absolute_url


def latest_snapshots(pages: DataFrame) -> DataFrame:
    """``(url, page_id)`` of the newest successful snapshot (largest page id) per URL."""
    return LS.successful(pages).groupBy("url").agg(F.max("page_id").alias("page_id"))


def crawl(list_pages: DataFrame, detail_pages: DataFrame, store: DataFrame, rules: EX.RuleSet,
          now: Column, links: DataFrame | None = None, registry: DataFrame | None = None) -> Dict[str, DataFrame]:
    """``list_pages``/``detail_pages``: ``(page_id, url, source, html[, success])``; ``store``: has
    ``link``.  ``links`` may pass the result pages already parsed (``parse_list_pages`` output).
    ``registry`` (``name, base_url``: configuration, one row per site) gives the base for a site's
    relative links; without it the page's own URL is the base.
    Returns ``valid``, ``rejected`` listings, ``outcomes`` per candidate link and ``stats``.  A page
    that cannot be parsed, or whose source has no rules, makes its link ``failed``."""
    list_pages = LS.successful(list_pages)                                   # FLT-1
    links = EX.parse_list_pages(list_pages, rules) if links is None else links
    if registry is not None:
        bases = registry.select(F.col("name").alias("_site"), "base_url")
        links = links.join(F.broadcast(bases), F.col("source").eqNullSafe(F.col("_site")), "left")
        base = F.coalesce(F.col("base_url"), F.col("url"))
    else:
        base = F.col("url")
    known = store.select("link").distinct().withColumn("known", F.lit(True))
    cand = stage(links.select("source", absolute_url(F.col("href"), base).alias("link"))
                 .filter(F.col("link").isNotNull())
                 .groupBy("link").agg(F.min("source").alias("source"))       # SET-2 (fixes Q6)
                 .join(known, "link", "left")                                # JOIN-2, JOIN-3
                 .withColumn("known", F.coalesce("known", F.lit(False))), "crawl-links")
    new = cand.filter(~F.col("known"))
    wanted = (new.join(latest_snapshots(detail_pages).withColumnRenamed("url", "link"), "link")
              .select("page_id", "source", "link"))
    fetched = wanted.join(detail_pages.select("page_id", "html"), "page_id")  # JOIN-7
    ruled = EX.dispatch(fetched, rules.to_df(fetched.sparkSession)).withColumnRenamed("link", "url")   # JOIN-6
    raw = EX.parse_detail_pages(ruled, rules, keep_errors=True, phone=False)
    # the parse keeps its page's id, under which its error is found again
    typed = LS.with_errors(LS.normalise(raw.withColumn("crawled_at", now), keep=("page_id", "parse_error")))
    checked = stage(typed, "crawl-listings")
    good = F.col("parse_error").isNull() & (F.size("errors") == 0)
    extra = ("errors", "page_id", "parse_error")
    valid = checked.filter(good).drop(*extra)
    rejected = checked.filter(F.col("parse_error").isNull() & (F.size("errors") > 0)).drop(*extra[1:])
    parsed = checked.groupBy("link").agg(F.max(good).alias("ok"))
    outcomes = (cand.join(wanted.select("link", F.lit(True).alias("fetched")), "link", "left").join(parsed, "link", "left")
                .select("source", "link",
                        F.when(F.col("known"), "duplicate").when(F.col("fetched").isNull(), "not_fetched")
                        .when(F.col("ok"), "success").otherwise("failed").alias("outcome")))
    pages_per_source = list_pages.groupBy(F.col("source").alias("_source")).agg(F.count(F.lit(1)).alias("total_pages"))
    return {"valid": valid, "rejected": rejected, "outcomes": outcomes, "stats": outcome_stats(outcomes, pages_per_source)}


def outcome_stats(outcomes: DataFrame, pages_per_source: DataFrame) -> DataFrame:
    """AGG-3 from labelled outcomes: the counters follow their definitions."""
    o = F.col("outcome")
    per_source = outcomes.groupBy("source").agg(
        F.count_if(o == "success").alias("successful_items"), F.count_if(o == "failed").alias("failed_items"),
        F.count_if(o == "duplicate").alias("duplicate_items"), F.count_if(o == "not_fetched").alias("not_fetched_items"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("successful_items", "failed_items", "duplicate_items", "not_fetched_items")]
    return (pages_per_source.join(per_source, F.col("_source").eqNullSafe(F.col("source")), "left")
            .select(F.col("_source").alias("source"), "total_pages", *zero)
            .withColumn("total_items", F.col("successful_items") + F.col("failed_items") + F.col("duplicate_items"))
            .withColumn("status", F.lit("completed")))
