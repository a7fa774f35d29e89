"""Enrichers that fail: batches are isolated, replies are logged, and a later run asks only for what is missing."""
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from listingflow.operators import batching as B
from listingflow.operators import enrich as EN
from listingflow.operators import reply_log as RL
from listingflow.plans import catalog
from listingflow.streaming import jobs as J

COLUMNS = "id string, title string, description string, source string, link string, type string, legal string, amenityLocation string, price double"


@pytest.fixture(scope="module")
def listing(spark):
    rows = [(str(i), f"Tin {i}", "Villa sân vườn gần công viên", "a" if i % 3 else "b", f"https://x/{i:03d}", None, "sổ đỏ" if i % 2 else None, None, float(i)) for i in range(95)]
    return spark.createDataFrame(rows, COLUMNS).withColumn("crawled_at", F.lit("2024-06-15").cast("timestamp_ntz")).repartition(3).cache()


def frame(*keys):
    return pd.DataFrame({"batch_hash": ["h" + k for k in keys], "batch_key": list(keys), "id": [str(i) for i in range(len(keys))]})


def echo(bad=(), silent=()):
    def fn(frames):
        for pdf in frames:
            for key, part in pdf.groupby("batch_key", sort=False):
                if key in bad:
                    raise ValueError("bad " + key)
                if key not in silent:
                    yield pd.DataFrame({"batch_key": [key], "text": [",".join(part["id"])]})
    return fn


def test_frames_are_cut_at_batches():
    frames = [frame("a", "a", "b"), frame("b"), frame(), frame("b", "c", "c"), frame("c", "d")]
    got = [list(f["batch_key"]) for f in EN.whole_frames(iter(frames))]
    assert got == [["a", "a"], ["b", "b", "b"], ["c", "c", "c"], ["d"]]
    assert list(EN.whole_frames(iter([]))) == [] and list(EN.whole_frames(iter([frame()]))) == []


def test_a_raise_costs_its_batch_alone():
    out = pd.concat(EN.guarded(echo(bad=("b", "d")))(iter([frame("a", "b", "b", "c"), frame("c", "d", "e")])))
    got = {r.batch_key: (r.batch_hash, r.text, r.error) for r in out.itertuples()}
    assert got == {"a": ("ha", "0", None), "b": ("hb", None, "ValueError: bad b"), "c": ("hc", "3,0", None),
                   "d": ("hd", None, "ValueError: bad d"), "e": ("he", "2", None)}
    assert len(out) == 5                                         # no batch is answered twice


def test_an_enricher_that_always_raises_passes_everything_through(spark, listing):
    def broken(frames):
        raise RuntimeError("provider down")
        yield
    out = EN.enrich(listing, broken)
    assert out.count() == 95 and out.filter("enriched").count() == 0
    assert sorted(map(tuple, out.drop("enriched").collect()), key=str) == sorted(map(tuple, listing.select(*out.drop("enriched").columns).collect()), key=str)


def test_records_carry_the_missing_names_of_their_batch(spark, listing):
    requests = EN.batch_records(EN.with_batches(listing)).collect()
    assert sum(len(r.records) for r in requests) == 95 and len({r.batch_hash for r in requests}) == len(requests)
    for r in requests:
        assert len(r.records) <= 10 and [x.pos for x in r.records] == list(range(1, len(r.records) + 1))
        assert set(r.batch_missing) == {m for x in r.records for m in x.missing} and r.batch_missing == sorted(r.batch_missing, key=EN.P.ENRICH_FIELDS.index)
    assert any("legal" not in x.missing and "legal" in r.batch_missing for r in requests for x in r.records)
    seen = EN.ask(EN.batch_records(EN.with_batches(listing)), lambda frames: (pd.DataFrame({"batch_key": p["batch_key"], "text": p["batch_missing"] + ";" + p["missing"]}) for p in frames))
    assert {len(set(t.text.split(";")[0].split(","))) for t in seen.collect()} != {0}


def asked(spark, log):
    return Counter(r.batch_hash for r in RL.read_log(spark, log).collect())


def test_failed_batches_alone_are_asked_again(spark, listing):
    log = J.run_dir(spark, "test-log")
    third = {f"{s}/{b}" for s in "ab" for b in (2, 5)}
    answer = EN.rule_based_enricher()

    def failing(frames):
        for pdf in frames:
            for key, part in pdf.groupby("batch_key", sort=False):
                if key in third:
                    raise RuntimeError("timeout")
                yield from answer(iter([part]))
    first = RL.enrich_logged(listing, failing, log, waves=3)
    lost = RL.failures(RL.read_log(spark, log)).collect()
    assert {r.batch_key for r in lost} == {k for k in third if k != "b/5"} and {r.error for r in lost} == {"RuntimeError: timeout"}
    assert first.count() == 95 and first.filter("not enriched").count() == 10 * 2 + 10      # a/2, a/5, b/2
    before = asked(spark, log)
    second = RL.enrich_logged(listing, answer, log, waves=3)
    assert second.filter("enriched").count() == 95 and RL.failures(RL.read_log(spark, log)).count() == 0
    assert asked(spark, log) - before == Counter({r.batch_hash: 1 for r in lost})
    after = asked(spark, log)
    third_run = RL.enrich_logged(listing, lambda frames: 1 / 0, log, waves=3)               # nothing is left to ask
    assert third_run.filter("enriched").count() == 95 and asked(spark, log) == after
    plain = EN.enrich(listing, answer)
    assert sorted(map(str, second.collect())) == sorted(map(str, plain.select(*second.columns).collect()))


def test_a_job_that_dies_keeps_the_waves_it_had_committed(spark, listing):
    log = J.run_dir(spark, "test-dying")
    answer = EN.rule_based_enricher()

    def dying(frames):
        for pdf in frames:
            if (pdf["batch_key"] == "a/4").any():
                raise KeyboardInterrupt                          # not the enricher's error: the task dies
            yield from answer(iter([pdf]))
    with pytest.raises(Exception):
        RL.enrich_logged(listing, dying, log, waves=6)
    kept = asked(spark, log)
    assert 0 < len(kept) < 10 and set(kept.values()) == {1}
    out = RL.enrich_logged(listing, answer, log, waves=6)
    now = asked(spark, log)
    assert out.filter("enriched").count() == 95 and len(now) == 11 and set(now.values()) == {1}


def test_a_changed_batch_is_asked_again(spark, listing):
    log = J.run_dir(spark, "test-changed")
    RL.enrich_logged(listing, EN.rule_based_enricher(), log, waves=2)
    n = len(asked(spark, log))
    changed = listing.withColumn("description", F.when(F.col("id") == "1", F.lit("Lô đất thổ cư")).otherwise(F.col("description")))
    out = RL.enrich_logged(changed, EN.rule_based_enricher(), log, waves=2)
    assert len(asked(spark, log)) == n + 1
    assert out.filter("id = '1'").first()["type"] != out.filter("id = '2'").first()["type"]


def test_empty_listing(spark, listing):
    log = J.run_dir(spark, "test-empty")
    out = RL.enrich_logged(listing.filter("id = 'none'"), EN.rule_based_enricher(), log, waves=1)
    assert out.count() == 0 and RL.read_log(spark, log).count() == 0


def test_a_few_offsets_move_no_row(spark, listing):
    ranked = B.rank_within(listing, "source", ["link", "id"], "rk", num_partitions=5)
    assert "Exchange hashpartitioning" not in ranked._jdf.queryExecution().explainString(ranked._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    kept = B.rank_within(listing, "source", ["link", "id"], "rk", num_partitions=3, stored=True)
    want = {r.id: r.n for r in listing.selectExpr("id", "row_number() over (partition by source order by link, id) - 1 as n").collect()}
    assert {r.id: r.rk for r in ranked.collect()} == {r.id: r.rk for r in kept.collect()} == want


def test_rows_that_parquet_cannot_hold_are_ranked(spark, listing):
    odd = listing.select("id", "source", "link", F.lit(None).alias("nothing"))
    got = B.rank_within(odd, "source", ["link", "id"], "rk", num_partitions=3)
    assert got.count() == 95 and got.agg(F.max("rk")).first()[0] == 62 and dict(got.dtypes)["nothing"] == "void"


def test_small_frames_are_answered_without_a_record_conversion(monkeypatch):
    asked = frame(*[k for k in "abcdef" for _ in range(3)]).assign(batch_missing="type", missing="type", title="Villa", description=None)
    monkeypatch.setattr(pd.DataFrame, "to_dict", lambda *a, **b: pytest.fail("costs a small frame ten times its rows"))
    out = pd.concat(EN.guarded(EN.rule_based_enricher())(iter([asked])))
    assert list(out["batch_key"]) == list("abcdef") and out["error"].isna().all()
    assert '{"id": "2", "type": "biệt thự"}' in out["text"].iloc[0]


def test_both_runs_are_over_listings_typed_once(spark, tmp_path, monkeypatch):
    spark.range(200).selectExpr("id as o_orderkey", "timestamp_ntz'2024-06-15' as o_orderdate").write.parquet(str(tmp_path / "orders.parquet"))
    plans, run = [], RL.enrich_logged

    def logged(listing, *args, **more):
        plans.append(listing._jdf.queryExecution().optimizedPlan().toString())
        return run(listing, *args, **more)
    monkeypatch.setattr(RL, "enrich_logged", logged)
    rows = catalog.QUERIES["enrich_resume"](spark, str(tmp_path)).collect()
    assert len(plans) == 2 and not any("regexp" in p for p in plans)
    # 200 ids over 6 sources: two of 34 and four of 33, each in four batches, of which the third fails at first
    assert len(rows) == 24 and {r.listings_enriched for r in rows} == {200} and {r.answered for r in rows} == {1}
    assert {r.batch_key for r in rows if r.failed_first} == {f"site{s}/2" for s in range(6)} == {r.batch_key for r in rows if r.asked == 2}
