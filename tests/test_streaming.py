"""Streams over several files (one file per micro-batch) equal the batch answer."""

import os

from pyspark.sql import functions as F

from listingflow.operators import stats as S
from listingflow.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def _split_events(spark, tmp_path):
    ev = spark.read.parquet(SF + "/events.parquet")
    folder = str(tmp_path / "events")
    for i in range(3):                                  # three files; links repeat across files
        ev.filter(F.col("event_id") % 3 == i).coalesce(1).write.parquet(os.path.join(folder, f"part{i}"))
    return os.path.join(folder, "part*"), ev


def test_progress_stream_equals_batch(spark, tmp_path):
    folder, ev = _split_events(spark, tmp_path)
    schema = ev.schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    root = J.run_dir(spark, "test-progress")
    out = J.progress(S.crawl_events(stream.select("event_id", "ts", "user_id", "event_type")), root)
    assert spark.read.parquet(out).select("batch").distinct().count() == 3       # three micro-batches
    got = sorted(map(tuple, J.latest_batch(spark, out).select("source", "status", "total_items").collect()))
    batch = S.progress(S.crawl_events(ev))
    exp = sorted(map(tuple, batch.select("source", "status", "total_items").collect()))
    assert got == exp


def test_dedup_stream_across_files(spark, tmp_path):
    folder, ev = _split_events(spark, tmp_path)
    link = F.concat(F.lit("https://listing.example/"), F.get_json_object("props", "$.k")).alias("link")
    stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(folder)
              .select("event_id", "ts", link))
    store = ev.select(link).filter(F.regexp_extract("link", "([0-9]+)$", 1).cast("int") < 10)
    out = J.dedup_links(stream, store, J.run_dir(spark, "test-dedup"))
    got = [r[0] for r in spark.read.parquet(out).select("link").collect()]
    assert len(got) == len(set(got))                                         # each link once over all batches
    exp = {r[0] for r in ev.select(link).distinct().join(store, "link", "left_anti").collect()}
    assert set(got) == exp


def test_progress_fold_over_batches_equals_batch(spark, tmp_path):
    ev = spark.read.parquet(SF + "/events.parquet")
    folder = str(tmp_path / "by_time")
    cuts = ["2024-01-01", "2024-01-11", "2024-01-21", "2100-01-01"]
    for i in range(3):                       # files arrive in event-time order: part0, part1, part2
        ev.filter((F.col("ts") >= cuts[i]) & (F.col("ts") < cuts[i + 1])).coalesce(1).write.parquet(
            os.path.join(folder, f"part{i}"))
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(folder, "part*"))
    out = J.progress_fold(S.crawl_events(stream.select("event_id", "ts", "user_id", "event_type")),
                          J.run_dir(spark, "test-fold"))
    assert spark.read.parquet(out).select("batch").distinct().count() == 3
    cols = ["source", "status", "processed_items", "total_items", "start_time", "end_time"]
    got = sorted(map(tuple, J.latest_batch(spark, out).select(*cols).collect()))
    exp = sorted(map(tuple, S.progress(S.crawl_events(ev)).select(*cols).collect()))
    assert got == exp


def test_enrich_upsert_stream_over_two_batches(spark, tmp_path):
    import datetime as dt
    from listingflow.operators import enrich as EN
    from listingflow.operators import extract as EX
    from test_extract import BATDONGSAN
    src = "batdongsan.com.vn"
    updated = BATDONGSAN.replace("12 tỷ 500 triệu", "13 tỷ")
    folder = str(tmp_path / "pages")
    rows0 = [(1, "https://batdongsan.com.vn/tin/1", BATDONGSAN), (2, "https://batdongsan.com.vn/tin/2", BATDONGSAN)]
    rows1 = [(3, "https://batdongsan.com.vn/tin/1", updated)]
    for i, rows in enumerate([rows0, rows1]):
        spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(
            os.path.join(folder, f"part{i}"))
    out = J.ingest_enrich_upsert(spark, os.path.join(folder, "part*"), EX.RuleSet(EX.site_rules()), F.lit(src),
                                 F.lit(dt.datetime(2024, 6, 15)).cast("timestamp_ntz"), EN.rule_based_enricher(),
                                 J.run_dir(spark, "test-upsert"), max_files_per_trigger=1)
    assert J.listing_store(spark, out).manifest()["applied"] == {"ingest": 1}                # two micro-batches
    store = {r["link"][-1]: r for r in J.current_store(spark, out).collect()}
    assert sorted(store) == ["1", "2"]
    assert store["1"]["price"] == 13e9 and store["2"]["price"] == 12.5e9   # the later page replaced the fields
    assert store["1"]["type"] == "nhà phố"                                 # filled by the enricher


def test_exact_dedup_across_batches(spark, tmp_path):
    folder, ev = _split_events(spark, tmp_path)
    link = F.concat(F.lit("https://listing.example/"), F.get_json_object("props", "$.k")).alias("link")
    stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(folder)
              .select("event_id", "ts", link))
    store = ev.select(link).filter(F.regexp_extract("link", "([0-9]+)$", 1).cast("int") < 10)
    out = J.dedup_links(stream, store, J.run_dir(spark, "test-dedup-exact"))
    # three micro-batches ran; a batch that finds no new link writes an empty directory
    assert sorted(d for d in os.listdir(out) if d.startswith("batch=")) == ["batch=0", "batch=1", "batch=2"]
    got = [r[0] for r in spark.read.parquet(out).select("link").collect()]
    assert len(got) == len(set(got))
    assert set(got) == {r[0] for r in ev.select(link).distinct().join(store, "link", "left_anti").collect()}


def test_restart_on_same_checkpoint_changes_nothing(spark, tmp_path):
    folder, ev = _split_events(spark, tmp_path)
    link = F.concat(F.lit("https://listing.example/"), F.get_json_object("props", "$.k")).alias("link")
    store = ev.select(link).filter(F.regexp_extract("link", "([0-9]+)$", 1).cast("int") < 10)
    root = J.run_dir(spark, "test-restart")

    def run():
        stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(folder)
                  .select("event_id", "ts", link))
        out = J.dedup_links(stream, store, root)
        return sorted(r[0] for r in spark.read.parquet(out).select("link").collect())

    first = run()
    second = run()                                  # same checkpoint: no batch is replayed twice
    assert first == second and len(first) == len(set(first))


def _links_in_files(spark, tmp_path, *batches):
    folder = str(tmp_path / "links")
    for i, links in enumerate(batches):
        spark.createDataFrame([(link,) for link in links], "link string").coalesce(1).write.parquet(os.path.join(folder, f"part{i}"))
    return (spark.readStream.schema("link string").option("maxFilesPerTrigger", 1).parquet(os.path.join(folder, "part*")))


def test_late_and_repeated_links(spark, tmp_path):
    """No watermark: a link is emitted once however late it comes or comes again."""
    store = spark.createDataFrame([("known",)], "link string")
    stream = _links_in_files(spark, tmp_path, ["a", "b", "known"], ["a", "c", "d"], ["late", "a", "d"], ["known", "a"])
    out = J.dedup_links(stream, store, J.run_dir(spark, "test-late"))
    assert sorted(r[0] for r in spark.read.parquet(out).select("link").collect()) == ["a", "b", "c", "d", "late"]
    assert all(d.startswith("bucket=") for b in os.listdir(out) if b.startswith("batch=")
               for d in os.listdir(os.path.join(out, b)) if not d.startswith(("_", ".")))


def test_first_batch_without_a_new_link(spark, tmp_path):
    store = spark.createDataFrame([("known",)], "link string")
    stream = _links_in_files(spark, tmp_path, ["known"], ["x", "known"])
    out = J.dedup_links(stream, store, J.run_dir(spark, "test-none"))
    assert [r[0] for r in spark.read.parquet(out).select("link").collect()] == ["x"]


def test_first_micro_batch_is_deduplicated(spark, tmp_path):
    import datetime as dt
    from listingflow.operators import enrich as EN
    from listingflow.operators import extract as EX
    from test_extract import BATDONGSAN
    folder = str(tmp_path / "pages")
    rows = [(1, "https://batdongsan.com.vn/tin/1", BATDONGSAN), (2, "https://batdongsan.com.vn/tin/1", BATDONGSAN),
            (3, "https://batdongsan.com.vn/tin/3", "<![broken]>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(os.path.join(folder, "part0"))
    out = J.ingest_enrich_upsert(spark, os.path.join(folder, "part*"), EX.RuleSet(EX.site_rules()), F.lit("batdongsan.com.vn"),
                                 F.lit(dt.datetime(2024, 6, 15)).cast("timestamp_ntz"), EN.rule_based_enricher(), J.run_dir(spark, "test-first"))
    assert [r["link"] for r in J.current_store(spark, out).collect()] == ["https://batdongsan.com.vn/tin/1"]


def test_events_without_a_type_are_logged(spark, tmp_path):
    folder = str(tmp_path / "events")
    spark.createDataFrame([(1, "s", None), (2, "s", "crawl_completed"), (3, None, "crawl_started")], "event_id long, source string, event string").write.parquet(folder)
    outs = J.route(spark.readStream.schema("event_id long, source string, event string").parquet(folder), J.default_routes(), J.run_dir(spark, "test-route"))
    log = {(r["source"], r["event"]): r["count"] for r in spark.read.parquet(outs["log"]).collect()}
    assert log == {("s", None): 1, (None, "crawl_started"): 1}


def test_a_table_in_several_files_is_streamed_whole(spark, tmp_path):
    """A table may be a folder of files that is named like a file."""
    path = str(tmp_path / "events.parquet")
    spark.read.parquet(SF + "/events.parquet").repartition(3).write.parquet(path)
    stream = J.file_stream(spark, path)
    out = J.route(stream, {"all": lambda b: b.select("event_id")}, J.run_dir(spark, "test-folder"))["all"]
    assert J.read_all_batches(spark, out).count() == spark.read.parquet(SF + "/events.parquet").count() > 0


def test_ingest_of_pages_in_a_folder(spark, tmp_path):
    from listingflow.plans.catalog import QUERIES
    (spark.read.parquet(SF + "/pages.parquet").repartition(3).write.parquet(str(tmp_path / "pages.parquet")))
    got, one = (sorted(map(tuple, QUERIES["stream_ingest"](spark, d).collect())) for d in (str(tmp_path), SF))
    assert got == one and len(got) > 0
