"""Delta store, membership filter and manifest: sizes, replays, half-done commits, exactness."""
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingflow.operators import delta_store as DS
from listingflow.operators import manifest as M
from listingflow.streaming import jobs as J

SCHEMA = T.StructType().add("id", "string").add("link", "string").add("price", "double").add("note", "string").add("crawled_at", "integer")


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def store_of(spark, name, **kw):
    return DS.DeltaStore(spark, J.run_dir(spark, name), SCHEMA, **kw)


def written(spark, store):
    return sum(M.child_sizes(spark, store.root + "/data").values()) + sum(M.child_sizes(spark, store.root + "/sketch").values())


def test_batches_equal_a_dictionary(spark):
    rng = random.Random(1)
    store, want = store_of(spark, "ds-model", depth=1), {}
    for batch in range(6):
        part = []
        for _ in range(rng.randrange(0, 40)):
            link = rng.choice([None, *(f"l{i}" for i in range(60))])
            part.append((f"{batch}-{rng.randrange(1000)}", link, rng.choice([None, 1.0, 2.0]), rng.choice([None, "n"]), rng.randrange(1000)))
        assert store.append(rows(spark, part), "job", batch)
        newest = {}
        for r in part:
            newest.setdefault(r[1], []).append(r)
        got = {r["link"]: tuple(r) for r in store.read().collect()}
        for link, several in newest.items():
            top = max(r[4] for r in several)
            kept = want[link][0] if link in want else None
            fit = [r for r in several if r[4] == top and got[link] == ((kept or r[0]), *r[1:])]
            assert fit, (got[link], several)                            # the newest row, nulls too, with the first id
            want[link] = got[link]
        assert got == want
        if batch in (2, 4):
            assert store.compact(most_deltas=2, most_rows=12)            # splits
            assert {r["link"]: tuple(r) for r in store.read().collect()} == want
    assert max(d for d, *_ in store.manifest()["leaves"].values()) > 1
    before = store.manifest()
    for batch in (0, 5):
        assert not store.append(rows(spark, [("x", "l1", 9.0, "replayed", 9)]), "job", batch)
    assert store.manifest() == before and {r["link"]: tuple(r) for r in store.read().collect()} == want


def test_a_batch_writes_what_it_holds_not_what_is_stored(spark):
    store = store_of(spark, "ds-bytes")
    big = spark.range(60_000).selectExpr("cast(id as string) id", "concat('https://x/', id) link", "rand(1) price", "sha2(cast(id as string), 256) note", "cast(id as int) crawled_at")
    store.append(big, "seed", 0)
    whole, sizes = written(spark, store), []
    for batch in range(10):
        before = written(spark, store)
        store.append(big.filter(F.col("crawled_at").between(batch * 50, batch * 50 + 49)).withColumn("price", F.lit(float(batch))), "job", batch)
        sizes.append(written(spark, store) - before)
    assert max(sizes) < whole / 20 and max(sizes) < 1.5 * min(sizes)
    assert store.read().count() == 60_000 and store.read().filter("price = 7").count() == 50
    touched = store.compact(most_deltas=10)
    assert touched and store.read().count() == 60_000 and store.read().filter("price = 7").count() == 50
    assert store.compact(most_deltas=10) == []                          # nothing is fat any more


def files_of(df):
    return {f for f in df.inputFiles()}


def test_only_buckets_with_a_possible_hit_are_read(spark):
    store = store_of(spark, "ds-filter", depth=5)
    store.append(rows(spark, [(str(i), f"https://x/{i}", 1.0, None, 1) for i in range(5000)]), "seed", 0)
    new = spark.range(40).selectExpr("concat('https://new/', id) link")
    found = store.candidates(new.union(spark.createDataFrame([("https://x/77",), (None,)], "link string")))
    hits = {r["bucket"] for r in found.filter("possible").collect()}
    assert found.filter("possible and link = 'https://x/77'").count() == 1
    assert found.filter("possible").count() <= 6                        # a few false ones at most
    out = store.unknown(new.union(spark.createDataFrame([("https://x/77",), (None,)], "link string")))
    assert {r["link"] for r in out.collect()} == {None, *(f"https://new/{i}" for i in range(40))}
    read = {f.split("bucket=")[1].split("/")[0] for f in files_of(out) if "/data/" in f}
    assert read <= {str(h) for h in hits} and len(read) < 8
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<link:string>" in plan                    # the key alone


@pytest.mark.parametrize("full", [False, True])
def test_false_positives_are_not_lost(spark, monkeypatch, full):
    store = store_of(spark, "ds-false", depth=1)
    if full:                                                            # sketches that say yes to everything
        monkeypatch.setattr(DS.DeltaStore, "_masks", lambda self: [F.lit(1).cast("long")] * DS.WORDS)
        monkeypatch.setattr(DS, "KEY_BITS", 0)
    store.append(rows(spark, [(str(i), f"a{i}", 1.0, None, 1) for i in range(200)]), "j", 0)
    store.append(rows(spark, [("n", None, 1.0, None, 1)]), "j", 1)
    asked = spark.createDataFrame([(f"a{i}",) for i in range(150, 260)] + [(None,), ("a199",)], "link string")
    if full:
        assert store.candidates(asked).filter("not possible").count() == 0
    assert {r["link"] for r in store.unknown(asked).collect()} == {f"a{i}" for i in range(200, 260)}


def test_empty_store_and_empty_batches(spark):
    store = store_of(spark, "ds-empty")
    assert store.read().collect() == [] and store.compact() == []
    assert [r["link"] for r in store.unknown(spark.createDataFrame([("a",), ("a",)], "link string")).collect()] == ["a"]
    assert store.append(rows(spark, []), "j", 0) and not store.append(rows(spark, []), "j", 0)
    assert store.read().collect() == [] and store.unknown(spark.createDataFrame([], "link string")).collect() == []


def test_stream_over_ten_files_gives_every_link_once(spark, tmp_path):
    folder = str(tmp_path / "links")
    for i in range(10):
        spark.createDataFrame([(f"l{k}",) for k in range(i * 5, i * 5 + 12)] + [("known",), ("l0",)], "link string").coalesce(1).write.parquet(os.path.join(folder, f"part{i}"))
    store = DS.DeltaStore(spark, J.run_dir(spark, "ds-stream") + "/links", T.StructType().add("link", "string"), order_cols=())
    store.append(spark.createDataFrame([("known",)], "link string"), "seed", 0)
    root = J.run_dir(spark, "ds-stream-ckpt")

    def run():
        stream = spark.readStream.schema("link string").option("maxFilesPerTrigger", 1).parquet(os.path.join(folder, "part*"))
        J.dedup_into_store(stream, store, root, compact_every=4)
        return sorted(r["link"] for r in store.read().collect())
    want = sorted(["known", *(f"l{k}" for k in range(57))])
    assert run() == want and run() == want
    assert store.manifest()["applied"] == {"seed": 0, "dedup": 9}


# ------------------------------------------------------------------ manifest
def test_the_same_append_twice_reads_as_one(spark):
    root = J.run_dir(spark, "manifest")
    batch = spark.createDataFrame([(1,), (2,)], "n int")
    assert M.append_once({"stats": batch}, root, "job", 0) and not M.append_once({"stats": batch}, root, "job", 0)
    assert M.append_once({"stats": batch}, root, "other", 0)
    assert M.read_sink(spark, root, "stats").count() == 4


def test_an_append_stopped_before_its_manifest_is_not_read(spark):
    root = J.run_dir(spark, "manifest-half")
    a, b = spark.createDataFrame([(1,)], "n int"), spark.createDataFrame([("x",)], "s string")
    M.append_once({"a": a, "b": b}, root, "job", 0)

    def stop():
        raise RuntimeError("stopped after the files")
    with pytest.raises(RuntimeError):
        M.append_once({"a": a, "b": b}, root, "job", 1, before_commit=stop)
    assert M.read_sink(spark, root, "a").count() == 1 and M.read_sink(spark, root, "b").count() == 1
    assert M.append_once({"a": a, "b": b}, root, "job", 1)
    assert M.read_sink(spark, root, "a").count() == 2 and M.read_sink(spark, root, "b").count() == 2
    bad = a.selectExpr("raise_error('second sink') AS s")
    with pytest.raises(Exception):
        M.append_once({"a": a, "b": bad}, root, "job", 2)                # no reader sees half of it
    assert M.read_sink(spark, root, "a").count() == 2 and M.read_sink(spark, root, "b").count() == 2
    with pytest.raises(ValueError):
        M.read_sink(spark, root, "never")


def test_a_cut_manifest_is_passed_over_and_two_writers_do_not_mix(spark):
    root = J.run_dir(spark, "manifest-cut")
    a = spark.createDataFrame([(1,)], "n int")
    M.append_once({"a": a}, root, "job", 0)
    one, two = M.read_manifest(spark, root), M.read_manifest(spark, root)
    M.commit(spark, root, one)
    with pytest.raises(RuntimeError):
        M.commit(spark, root, two)
    fs, p = M._fs(spark, root + "/_manifest/v0000000003.json")
    out = fs.create(p, False)
    out.write(bytearray(b'{"version": 3, "appl'))
    out.close()
    assert M.read_manifest(spark, root)["version"] == 2
    assert M.append_once({"a": a}, root, "job", 1) and M.read_manifest(spark, root)["version"] == 4
    assert M.read_sink(spark, root, "a").count() == 2


def test_sinks_of_a_micro_batch_are_committed_together(spark, tmp_path):
    folder, schema = str(tmp_path / "events"), "event_id long, link string, event string, ts int"
    for i, part in enumerate([[(1, "a", "property_enriched", 1), (2, "b", "property_enriched", 1), (3, None, "crawl_completed", 2)],
                              [(4, "a", "property_enriched", 5), (5, "a", "property_enriched", 4), (6, "c", "other", 5)]]):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(os.path.join(folder, f"part{i}"))
    root = J.run_dir(spark, "route-committed")
    routes = {"listings": lambda b: b.filter("event = 'property_enriched'"), "sessions": lambda b: b.filter("event = 'crawl_completed'")}

    def run(sinks):
        feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(folder, "part*"))
        J.route_committed(feed, sinks, root)
    broken = {**routes, "sessions": lambda b: b.selectExpr("raise_error('down') AS s")}
    with pytest.raises(Exception):
        run(broken)
    with pytest.raises(ValueError):
        M.read_sink(spark, root, "listings")                            # nothing of the failed micro-batch
    run(routes)
    got = {r["link"]: r["event_id"] for r in M.read_keyed(spark, root, "listings", "link", ["ts", "event_id"]).collect()}
    assert got == {"a": 4, "b": 2} and M.read_sink(spark, root, "sessions").count() == 1
    run(routes)
    assert M.read_sink(spark, root, "listings").count() == 4


def test_many_buckets_are_written_by_several_tasks(spark):
    """The files of a bucket come from one task, those of many small buckets not all from the same one."""
    store = store_of(spark, "ds-spread", depth=6)
    store.append(rows(spark, [(str(i), f"l{i}", 1.0, None, 1) for i in range(500)]), "job", 0)
    files = [(f.split("/")[-2], f.split("/")[-1].split("-")[1]) for kind in ("data", "sketch")
             for f in spark.read.option("recursiveFileLookup", "true").parquet(os.path.join(store.root, kind)).inputFiles()]
    assert len(files) == 2 * len({b for b, _ in files}) and len({b for b, _ in files}) > 32
    assert len({task for _, task in files}) > 2
    assert store.read().count() == 500
