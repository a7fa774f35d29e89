"""No single page or row ends a job; writes scale with their data; outcomes follow their definitions."""

import datetime as dt
import os

import pandas as pd
import pytest
from conftest import eval_rows
from pyspark.sql import functions as F

from listingflow.functions import html as H
from listingflow.functions import text as T
from listingflow.operators import crawl as C
from listingflow.operators import enrich as EN
from listingflow.operators import extract as EX
from listingflow.operators import listing as LS
from listingflow.operators import stats as S
from listingflow.operators import store as ST
from listingflow import session
from test_extract import BATDONGSAN

NOW = dt.datetime(2024, 6, 15)
SRC = "batdongsan.com.vn"
DEEP = "<html><body>" + "<p>x" * 2000 + "<font>" * 1200 + "</body></html>"
PAGE = "page_id long, url string, source string, html string, success boolean"


def test_deep_pages_are_read_and_broken_ones_fail_alone(spark):
    assert H.parse(DEEP).text().count("x") == 2000
    pages = spark.createDataFrame([(1, "https://a/1", SRC, BATDONGSAN), (2, "https://a/2", SRC, DEEP), (3, "https://a/3", SRC, "<![foo]>"),
                                   (4, "https://a/4", SRC, None)], "page_id long, url string, source string, html string")
    rules = EX.RuleSet(EX.site_rules())
    got = {r["page_id"]: r["parse_error"] for r in EX.parse_detail_pages(pages, rules, keep_errors=True).collect()}
    assert got[1] is None and got[2] is None and got[4] is None and "AssertionError" in got[3]
    assert sorted(r["page_id"] for r in EX.parse_detail_pages(pages, rules).collect()) == [1, 2, 4]
    assert EX.parse_list_pages(pages, rules).count() >= 0


def test_numbers_out_of_range_are_null_or_kept(spark):
    rows = [("999999999 ngày trước",), ("99999999999999 giờ trước",), ("999999999 phút trước",), ("3 ngày trước",)]
    got = [r[0] for r in eval_rows(spark, "s string", rows, T.parse_date("s", F.lit(NOW).cast("timestamp_ntz")))]
    assert got[:2] == [None, None] and got[2] == NOW - dt.timedelta(minutes=999999999) and got[3] == NOW - dt.timedelta(days=3)
    got = [r[0] for r in eval_rows(spark, "p double, a double", [(1e25, 1.0), (10.0, 3.0), (1e300, 1e-300)], T.unit_price("p", "a"))]
    assert got[:2] == [1e25, 3.33] and got[2] == float("inf")
    df = spark.createDataFrame([("a", 1, 1e40)], "id string, pos int, price double")
    assert "price: 1.0E40" in df.select(EN.record_block(df, ["price"]).alias("b")).first()["b"]


def test_city_is_cleaned_and_zero_is_not_given(spark):
    raw = spark.createDataFrame([("https://x.vn/1", "bds123.vn", "Dĩ An, Bình  Dương ★", "0"), ("https://x.vn/2", "mogi.vn", "Dĩ An, Bình  Dương ★", "0")],
                                "link string, source string, address string, frontage_text string").withColumn("crawled_at", F.lit(NOW).cast("timestamp_ntz"))
    got = {r["source"]: r for r in LS.normalise(raw).collect()}
    assert {r["city"] for r in got.values()} == {"Bình Dương"}
    assert got["bds123.vn"]["frontage"] is None and got["mogi.vn"]["frontage"] == 0.0


def test_crawl_outcomes(spark):
    rules = EX.RuleSet(EX.generic_rules("generic"))
    lists = spark.createDataFrame([
        (1, "https://m.vn/bat-dong-san/ban", "generic", "<nav><ul><li><a href='x'>x</a></li><li><a href='y'>y</a></li><li><a href='z'>z</a></li><li><a href='w'>w</a></li></ul></nav>", True),
        (2, "https://m.vn/bat-dong-san/ban?p=2", "generic", "<nav><ul><li><a href='lost'>x</a></li></ul></nav>", False)], PAGE)
    page = "<html><h1>T</h1><article>text</article></html>"
    details = spark.createDataFrame([
        (11, "https://m.vn/x", "generic", page, True), (12, "https://m.vn/x", "generic", page, True), (13, "https://m.vn/y", "generic", "<![x]>", True),
        (14, "https://m.vn/z", "generic", page, True)], PAGE)
    store = spark.createDataFrame([("https://m.vn/z",)], "link string")
    registry = spark.createDataFrame([("generic", "https://m.vn/")], "name string, base_url string")
    out = C.crawl(lists, details, store, rules, F.lit(NOW).cast("timestamp_ntz"), registry=registry)
    got = {r["link"]: r["outcome"] for r in out["outcomes"].collect()}
    assert got == {"https://m.vn/x": "success", "https://m.vn/y": "failed", "https://m.vn/z": "duplicate", "https://m.vn/w": "not_fetched"}
    assert [r["link"] for r in out["valid"].collect()] == ["https://m.vn/x"]
    (s,) = out["stats"].collect()
    assert (s["total_pages"], s["successful_items"], s["failed_items"], s["duplicate_items"], s["not_fetched_items"], s["total_items"]) == (1, 1, 1, 1, 1, 3)
    plan = out["stats"]._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan                       # outputs read what was parsed once
    no_rules = C.crawl(lists, details, store, EX.RuleSet(EX.generic_rules("other")), F.lit(NOW).cast("timestamp_ntz"),
                       links=EX.parse_list_pages(LS.successful(lists), rules), registry=registry)
    assert {r["outcome"] for r in no_rules["outcomes"].collect() if r["link"] == "https://m.vn/x"} == {"failed"}


def test_session_counters_by_hand(spark):
    at = [dt.datetime(2024, 1, 1, 0, i) for i in range(9)]
    feed = spark.createDataFrame([(i, at[i], "s", "s/1", e) for i, e in enumerate(
        ["crawl_started", "page_crawled", "property_extracted", "property_enriched", "property_duplicate", "property_failed", "property_extracted", "crawl_completed"])],
        "event_id long, ts timestamp_ntz, source string, session_id string, event string")
    (r,) = S.session_stats(feed).collect()
    assert (r["total_pages"], r["total_items"], r["successful_items"], r["failed_items"], r["duplicate_items"], r["status"]) == (1, 4, 2, 1, 1, "completed")


def test_completed_sessions_are_appended(spark, tmp_path):
    stats = spark.createDataFrame([("a", "completed"), ("b", "running")], "session_id string, status string")
    path = str(tmp_path / "sessions")
    S.append_sessions(stats, path)
    S.append_sessions(stats, path)
    assert [r[0] for r in spark.read.parquet(path).select("session_id").collect()] == ["a", "a"]


def test_one_row_per_new_key_is_inserted(spark):
    store = spark.createDataFrame([(9, "k")], "id long, link string")
    batch = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y"), (None, "y"), (3, "k"), (None, None), (4, None)], "id long, link string")
    got = [(r["link"], r["status"]) for r in ST.append_unique(store, batch).collect()]
    assert sorted(got, key=str) == sorted([("x", "inserted"), ("x", "duplicate"), ("y", "inserted"), ("y", "duplicate"), ("k", "duplicate"),
                                          (None, "inserted"), (None, "duplicate")], key=str)


def test_upsert_replaces_inserts_and_reads_each_side_once(spark):
    store = spark.createDataFrame([(1, "a", 5, 1), (2, "b", 6, 1)], "id long, link string, price long, crawled_at long")
    updates = spark.createDataFrame([(7, "a", None, 2), (8, "a", 9, 1), (9, "c", 1, 1)], "id long, link string, price long, crawled_at long")
    out = ST.upsert(store, updates)
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "a", None, 2), (2, "b", 6, 1), (9, "c", 1, 1)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_a_hot_source_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(200_000).select(F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("city"), F.col("id").cast("double").alias("price"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        path = ST.write_snapshot(df.repartition(8), str(tmp_path / "snap"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len([f for f in os.listdir(os.path.join(path, "source=hot")) if f.endswith(".parquet")]) > 2
    assert spark.read.parquet(path).count() == 200_000


def test_batches_reach_the_enricher_whole(spark):
    rows = [{"batch_key": f"k{i // 10}", "id": str(i)} for i in range(34)]
    frames = [pd.DataFrame(rows[i:i + 7]) for i in range(0, 34, 7)]
    got = [(k, len(r)) for k, r in EN.whole_batches(iter(frames), 10)]
    assert got == [("k0", 10), ("k1", 10), ("k2", 10), ("k3", 4)]
    assert [(k, len(r)) for k, r in EN.whole_batches(iter(frames), 6)] == [("k0", 6), ("k0", 4), ("k1", 6), ("k1", 4), ("k2", 6), ("k2", 4), ("k3", 4)]


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(*_):
                return None
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_small_scans_are_spread_and_large_ones_are_not(spark, monkeypatch):
    from listingflow.sources import tables
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert tables.spread(df, 5).rdd.getNumPartitions() == 5
    monkeypatch.setattr(tables, "SPREAD_BYTES", 10)
    assert tables.spread(df, 5) is df
