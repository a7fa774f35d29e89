"""Registered queries: name -> builder(spark, sf_dir) -> DataFrame.

Every query reads the given tables (or views Spark derives from them) in full.  The matching
DuckDB SQL for the driver's oracle lives in ``plans/oracle.py`` under the same name; column
names and types are aligned on both sides.
"""

from __future__ import annotations

from typing import Callable, Dict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import links as L
from ..operators import crawl as CR
from ..operators import delta_store as DS
from ..operators import enrich as EN
from ..operators import extract as EX
from ..operators import frontier as FR
from ..operators import listing as LS
from ..operators import stats as S
from ..operators import reply_log as RL
from ..operators import store as ST
from ..sources import registry as R
from ..streaming import jobs as J
from ..sources import views as V
from ..session import stage
from ..sources.tables import named_table, read_pages, read_table, register_tables, table_path

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: Dict[str, Builder] = {}


def query(name: str):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ pages (SRC-2, PRJ-3/4/5)
@query("page_listing_stats")
def q_page_listing_stats(spark, sf_dir):
    return L.page_listing_stats(read_pages(spark, sf_dir))


@query("page_links_absolute")
def q_page_links_absolute(spark, sf_dir):
    return L.page_links(read_pages(spark, sf_dir))


@query("url_valid")
def q_url_valid(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    return pages.select("page_id", T.is_valid_url("url").alias("valid_url"),
                        T.starts_with_http("url").alias("is_http"))


# ------------------------------------------------------------------ scalar normalisation (SCL-*)
@query("clean_text")
def q_clean_text(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"], spread_out=True)
    cleaned = T.clean_text("text")
    return docs.select("doc_id", F.md5(cleaned).alias("clean_md5"),
                       T.contains_ci(cleaned, "Contact").alias("mentions_contact"))


@query("phone_masked")
def q_phone_masked(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"], spread_out=True)
    # keep documents with a phone without a Filter node: a Filter would be pushed below the
    # extraction and run the regexes twice per document
    found = F.filter(F.array(T.extract_phone("text")), lambda x: x.isNotNull())
    return (docs.select("doc_id", F.explode(found).alias("phone"))
            .select("doc_id", T.mask_phone("phone").alias("phone_masked")))


@query("price")
def q_price(spark, sf_dir):
    return T.apply_keyed(V.text_view(spark, sf_dir), [("price", "price_text", "price")], ["id"])


@query("area")
def q_area(spark, sf_dir):
    return T.apply_keyed(V.text_view(spark, sf_dir), [("area", "area_text", "area")], ["id"])


@query("rooms")
def q_rooms(spark, sf_dir):
    return T.apply_keyed(V.text_view(spark, sf_dir), [("rooms", "rooms_text", "bedroom")], ["id"])


@query("bathrooms")
def q_bathrooms(spark, sf_dir):
    return T.apply_keyed(V.text_view(spark, sf_dir), [("bathrooms", "bath_text", "bathroom")], ["id"])


@query("frontage")
def q_frontage(spark, sf_dir):
    return T.apply_keyed(V.text_view(spark, sf_dir), [("frontage", "frontage_text", "frontage")], ["id"])


@query("posted_date")
def q_posted_date(spark, sf_dir):
    v = V.text_view(spark, sf_dir).select("id", "as_of", T.date_key("date_text").alias("_dk"))
    d = v.select("id", T.posted_date_key("_dk", "as_of").alias("posted_date"))
    return d.select("id", "posted_date", T.format_date("posted_date").alias("posted_text"))


@query("city")
def q_city(spark, sf_dir):
    return T.apply_keyed(V.text_view(spark, sf_dir), [("city", "address_text", "city")], ["id"])


@query("unit_price")
def q_unit_price(spark, sf_dir):
    v = T.apply_keyed(V.text_view(spark, sf_dir),
                      [("price", "price_text", "price"), ("area", "area_text", "area")], ["id"])
    return v.select("id", "price", "area", T.unit_price("price", "area").alias("unit_price"))


@query("type_class")
def q_type_class(spark, sf_dir):
    return V.text_view(spark, sf_dir).select("id", T.classify_type("description").alias("type"))


@query("legal_phrase")
def q_legal_phrase(spark, sf_dir):
    return V.text_view(spark, sf_dir).select("id", T.legal_phrase("description").alias("legal"))


@query("amenities")
def q_amenities(spark, sf_dir):
    return V.text_view(spark, sf_dir).select("id", T.amenities("description").alias("amenityLocation"))


# ------------------------------------------------------------------ frontier and joins

NOW = "2024-06-01 00:00:00"   # the job's "now", a parameter (never the wall clock)
PAGES_CAP = 3                 # pages per search URL in the frontier queries
FRONTIER_BATCH = 2            # result pages per batch in the frontier queries


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


def _registry(spark, sf_dir):
    return R.registry_from_suppliers(
        read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]))


def _state(spark, sf_dir):
    return R.state_from_suppliers(read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"]))


@query("pagination_urls")
def q_pagination_urls(spark, sf_dir):
    return FR.page_urls(_registry(spark, sf_dir), PAGES_CAP, FRONTIER_BATCH)


@query("frontier_batches")
def q_frontier_batches(spark, sf_dir):
    urls = FR.page_urls(_registry(spark, sf_dir), PAGES_CAP, FRONTIER_BATCH)
    return (urls.groupBy("name", "batch")
            .agg(F.count(F.lit(1)).alias("n_urls"), F.min("page").alias("first_page"),
                 F.max("page").alias("last_page")))


@query("enabled_sites")
def q_enabled_sites(spark, sf_dir):
    en = FR.enabled_sites(_registry(spark, sf_dir), _state(spark, sf_dir))
    return en.select("name", "base_url", F.size("search_urls").alias("n_search_urls"))


@query("site_lookup")
def q_site_lookup(spark, sf_dir):
    return ST.site_lookup(_state(spark, sf_dir), F.col("name") == "Supplier#000000007")


@query("state_seed")
def q_state_seed(spark, sf_dir):
    return ST.state_seed(_state(spark, sf_dir), _registry(spark, sf_dir), _now())


@query("state_upsert")
def q_state_upsert(spark, sf_dir):
    sup = read_table(spark, sf_dir, "supplier", ["s_name", "s_acctbal"])
    changes = sup.filter(F.col("s_acctbal") > 5000).select(
        F.col("s_name").alias("name"), (F.col("s_acctbal") > 7500).alias("enabled"))
    return ST.state_upsert(_state(spark, sf_dir), changes, _now())


@query("state_toggle")
def q_state_toggle(spark, sf_dir):
    sup = read_table(spark, sf_dir, "supplier", ["s_name", "s_nationkey"])
    picked = sup.filter(F.col("s_nationkey").isin(7, 20))          # nation 20 has no stored state
    names = (picked.select(F.col("s_name").alias("name"))
             .unionByName(picked.select(F.concat(F.lit("unknown-"), F.col("s_name")).alias("name"))))
    return ST.state_toggle(_state(spark, sf_dir), names, True, _now())


def _candidates(spark, sf_dir):
    """Candidate links: every listing, and the 1999 listings a second time (found twice)."""
    v = V.text_view(spark, sf_dir).select("id", F.col("link").alias("url"), "as_of")
    return v.unionByName(v.filter(F.year("as_of") == 1999)).select("id", "url")


def _store(spark, sf_dir):
    """The known-link store: listings crawled before 1997."""
    return V.listing_view(spark, sf_dir).filter(F.col("crawled_at") < F.lit("1997-01-01").cast("timestamp_ntz"))


@query("new_links")
def q_new_links(spark, sf_dir):
    return FR.new_links(_candidates(spark, sf_dir).select("url"), _store(spark, sf_dir))


@query("known_links")
def q_known_links(spark, sf_dir):
    return FR.known_links(_candidates(spark, sf_dir).select("url"), _store(spark, sf_dir))


@query("url_page_join")
def q_url_page_join(spark, sf_dir):
    pages = read_pages(spark, sf_dir)
    frontier = FR.page_urls(
        pages.select(F.col("page_id").cast("string").alias("name"), F.array("url").alias("search_urls")), 2, 20)
    sized = pages.select("url", "page_id", F.length("html").cast("bigint").alias("html_chars"))
    return (FR.frontier_with_pages(frontier.select("url", "page"), sized, ("page_id", "html_chars"))
            .select("url", "page", "page_id", "html_chars"))


def _updates(spark, sf_dir):
    return V.listing_updates_view(spark, sf_dir).withColumn("id", F.col("id") + 100000000)


@query("append_unique")
def q_append_unique(spark, sf_dir):
    batch = (V.listing_view(spark, sf_dir).filter(F.year("crawled_at") == 1998)
             .unionByName(_updates(spark, sf_dir)))
    return ST.append_unique(_store(spark, sf_dir), batch).select("id", "link", "status")


@query("upsert_latest")
def q_upsert_latest(spark, sf_dir):
    return ST.upsert(V.listing_view(spark, sf_dir), _updates(spark, sf_dir))


# ------------------------------------------------------------------ statistics
def _docs(spark, sf_dir, cols=("doc_id", "source")):
    return read_table(spark, sf_dir, "documents", list(cols))


@query("count_by_source")
def q_count_by_source(spark, sf_dir):
    return S.count_by(_docs(spark, sf_dir), "source")


@query("count_filtered")
def q_count_filtered(spark, sf_dir):
    return S.count_where(_docs(spark, sf_dir), F.col("source") == "src3")


@query("total_count")
def q_total_count(spark, sf_dir):
    (name,) = register_tables(spark, sf_dir, ["documents"], prefix="lf_")     # SRC-4
    return S.total_count(named_table(spark, name))


@query("union_sources")
def q_union_sources(spark, sf_dir):
    docs = _docs(spark, sf_dir, ("doc_id", "lang", "source"))
    langs = ("en", "de", "fr", "es")
    parts = [docs.filter(F.col("lang") == lang) for lang in langs]
    parts.append(docs.filter(F.col("lang").isNull() | ~F.col("lang").isin(*langs)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _feed(spark, sf_dir, names=S.EVENT_NAMES):
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    return S.crawl_events(ev, names)


@query("session_stats")
def q_session_stats(spark, sf_dir):
    return S.session_stats(_feed(spark, sf_dir, S.OUTCOME_NAMES))


@query("session_append")
def q_session_append(spark, sf_dir):
    """SNK-4: completed sessions appended to the statistics table, read back."""
    path = J.run_dir(spark, "sessions")
    S.append_sessions(S.session_stats(_feed(spark, sf_dir, S.OUTCOME_NAMES)), path)
    return spark.read.parquet(path)


@query("recent_sessions")
def q_recent_sessions(spark, sf_dir):
    return S.recent_sessions(S.completed_sessions(S.session_stats(_feed(spark, sf_dir, S.OUTCOME_NAMES))), 10)


@query("progress_by_source")
def q_progress_by_source(spark, sf_dir):
    return S.progress(_feed(spark, sf_dir))


@query("event_counts")
def q_event_counts(spark, sf_dir):
    return S.event_counts(_feed(spark, sf_dir))


# ------------------------------------------------------------------ typed listing, validation


def _raw_from_text(spark, sf_dir):
    """The text view as raw extracted fields (what PRJ-6 yields for a page)."""
    v = V.text_view(spark, sf_dir)
    return v.select(
        "id", "link", F.col("description").alias("title"), F.col("address_text").alias("address"),
        "description", "price_text", "area_text", F.col("rooms_text").alias("bedroom_text"),
        F.col("bath_text").alias("bathroom_text"), "frontage_text", "date_text",
        F.concat(F.lit("site"), (F.col("id") % 6).cast("string")).alias("source"),
        F.col("as_of").alias("crawled_at"))


def _typed(spark, sf_dir):
    return LS.normalise(_raw_from_text(spark, sf_dir))


@query("normalise_listing")
def q_normalise_listing(spark, sf_dir):
    return _typed(spark, sf_dir)


@query("validate_split")
def q_validate_split(spark, sf_dir):
    v = V.listing_view(spark, sf_dir).withColumn("unit_price", T.unit_price("price", "area"))
    e = LS.with_errors(v)
    return e.select("id", (F.size("errors") == 0).alias("valid"), F.array_join("errors", ",").alias("errors"))


@query("conform_schema")
def q_conform_schema(spark, sf_dir):
    v = (V.listing_view(spark, sf_dir)
         .withColumn("numberphone", F.lit(None).cast("string"))     # misspelt name (Q1) is mapped
         .withColumn("extra_note", F.lit("x"))                        # unknown column is dropped
         .withColumn("id", LS.listing_id("link"))                     # PRJ-11 deterministic id
         .withColumn("updated_at", F.col("crawled_at")))              # PRJ-12 stamps
    return LS.conform(v)


# ------------------------------------------------------------------ enrichment
def _missing_str(df):
    return F.array_join(EN.missing_fields(df), ",")


@query("missing_fields")
def q_missing_fields(spark, sf_dir):
    t = _typed(spark, sf_dir)
    m = EN.missing_fields(t)
    return t.select("id", F.array_join(m, ",").alias("missing"), F.size(m).alias("n_missing"))


@query("enrich_batches")
def q_enrich_batches(spark, sf_dir):
    b = EN.with_batches(_typed(spark, sf_dir))
    r = EN.batch_requests(b)
    return r.select("source", "batch", "n_records", "missing")


@query("request_text")
def q_request_text(spark, sf_dir):
    b = EN.with_batches(_typed(spark, sf_dir))
    return EN.batch_requests(b).select("source", "batch", "request")


@query("response_parse")
def q_response_parse(spark, sf_dir):
    items = EN.parse_replies(V.response_view(spark, sf_dir), "text", keep=["id"])
    return items.select("id", "pos", "item_id",
                        F.map_contains_key("item", "legal").alias("has_legal"),
                        F.element_at("item", F.lit("legal")).alias("legal"),
                        F.element_at("item", F.lit("type")).alias("type"))


@query("type_map")
def q_type_map(spark, sf_dir):
    items = EN.parse_replies(V.response_view(spark, sf_dir), "text", keep=["id"])
    raw = F.element_at("item", F.lit("type"))
    return items.select("id", raw.alias("type_raw"), T.map_property_type(raw).alias("type"))


@query("response_merge")
def q_response_merge(spark, sf_dir):
    items = EN.parse_replies(V.response_wide_view(spark, sf_dir), "text", keep=["id"])
    return EN.merge_reply_items(_typed(spark, sf_dir), items.withColumnRenamed("id", "resp_id"), ["resp_id", "pos"])


@query("enrich_hook")
def q_enrich_hook(spark, sf_dir):
    out = EN.enrich(_typed(spark, sf_dir), EN.rule_based_enricher())
    return out.select("id", "type", "legal", "amenityLocation", "enriched")


def _failing_enricher():
    """The rule-based enricher, raising for every third batch of a source."""
    answer = EN.rule_based_enricher()

    def fn(frames):
        for pdf in EN.whole_frames(frames):
            for key, part in EN.batch_parts(pdf):
                if int(key.rsplit("/", 1)[1]) % 3 == 2:
                    raise RuntimeError("no reply for " + key)
                yield from answer(iter([part]))

    return fn


@query("enrich_partial_failure")
def q_enrich_partial_failure(spark, sf_dir):
    out = EN.enrich(_typed(spark, sf_dir), _failing_enricher())
    return out.select("id", "type", "legal", "amenityLocation", "enriched")


@query("enrich_resume")
def q_enrich_resume(spark, sf_dir):
    """A run in which every third batch fails, and a second over its log: what each batch was asked."""
    log = J.run_dir(spark, "reply-log")
    typed = stage(_typed(spark, sf_dir), "typed")                # both runs are over the same listings: typed once
    first = RL.enrich_logged(typed, _failing_enricher(), log, waves=2, stored=True)
    first.write.parquet(log + "-first")
    lost = RL.failures(stage(RL.read_log(spark, log), "log")).select("batch_key", F.lit(True).alias("failed_first"))
    second = RL.enrich_logged(typed, EN.rule_based_enricher(), log, waves=2, stored=True).agg(F.count_if("enriched").alias("enriched")).select("enriched")
    asked = RL.read_log(spark, log).groupBy("batch_key").agg(F.count(F.lit(1)).alias("asked"), F.count("text").alias("answered"))
    return (asked.join(lost, "batch_key", "left").crossJoin(F.broadcast(second))          # one row
            .select("batch_key", "asked", "answered", F.coalesce("failed_first", F.lit(False)).alias("failed_first"), F.col("enriched").alias("listings_enriched")))


# ------------------------------------------------------------------ rule-driven extraction

RULED_SOURCES = ("example.com", "example.org")   # sources registered with the generic rules


def _pages_with_source(spark, sf_dir):
    pages = read_pages(spark, sf_dir)
    suffix = F.regexp_extract(L.host_of("url"), r"([a-z0-9-]+\.[a-z]+)$", 1)
    return pages.withColumn("source", suffix)


def _generic_ruleset(source="generic"):
    return EX.RuleSet(EX.generic_rules(source))


@query("page_text_rules")
def q_page_text_rules(spark, sf_dir):
    pages = read_pages(spark, sf_dir).withColumn("source", F.lit("generic"))
    d = EX.parse_detail_pages(pages, _generic_ruleset())
    return d.select("page_id", "title", F.col("seller").alias("footer"), F.col("address").alias("ad_text"),
                    F.md5("description").alias("article_md5"), F.md5("phone_text").alias("page_text_md5"))


@query("rule_postprocess")
def q_rule_postprocess(spark, sf_dir):
    """Two custom rules: a registered post-processor on the title, a chain on the advertisement."""
    rules = EX.RuleSet().with_postprocessor("initials", lambda c: F.regexp_replace(c, "([A-Za-z])[a-z]*", "$1"))
    rules = rules.register("generic", [r._replace(postprocess={"title": "initials", "address": "clean_text|digits"}.get(r.field)) for r in EX.generic_rules("generic")])
    pages = read_pages(spark, sf_dir).withColumn("source", F.lit("generic"))
    return EX.parse_detail_pages(pages, rules, phone=False).select("page_id", "title", F.col("address").alias("ad_text"))


@query("zero_dropping_source")
def q_zero_dropping_source(spark, sf_dir):
    """PRJ-13: listings of a site that writes 0 for what it does not know, through its own rules."""
    raw = (V.text_view(spark, sf_dir).withColumn("source", F.lit("bds123.vn"))
           .withColumn("price_text", F.when(F.col("id") % 5 == 0, F.lit("0 triệu")).otherwise(F.col("price_text")))
           .withColumn("area_text", F.when(F.col("id") % 7 == 0, F.lit("0,0 m²")).otherwise(F.col("area_text"))))
    typed = LS.normalise(EX.postprocess(raw.withColumn("crawled_at", F.col("as_of")), EX.RuleSet(EX.site_rules())))
    return typed.select("id", "price", "area", F.col("unit_price").isNull().alias("no_unit_price"))


@query("enrichable_fields")
def q_enrichable_fields(spark, sf_dir):
    return LS.project(_typed(spark, sf_dir), ["title", "price", "area", "bedroom", "bathroom", "frontage", "legal", "city", "type"])


@query("rule_dispatch")
def q_rule_dispatch(spark, sf_dir):
    rules = EX.RuleSet()
    for src in RULED_SOURCES:                       # UDF-1: register a rule set per source
        rules = rules.register(src, EX.generic_rules(src))
    disp = EX.dispatch(_pages_with_source(spark, sf_dir), rules.to_df(spark))
    parsed = EX.parse_detail_pages(disp.filter("has_rules"), rules).select(
        "page_id", "source", F.lit(True).alias("has_rules"), "title")
    rejected = disp.filter(~F.col("has_rules")).select(
        "page_id", "source", "has_rules", F.lit(None).cast("string").alias("title"))
    return parsed.unionByName(rejected)


@query("page_links_rules")
def q_page_links_rules(spark, sf_dir):
    pages = read_pages(spark, sf_dir).withColumn("source", F.lit("generic"))
    links = EX.parse_list_pages(pages, _generic_ruleset())
    return links.select("page_id", "pos", L.absolute_url(F.col("href"), F.col("url")).alias("url"), "title")


@query("spec_map_lookup")
def q_spec_map_lookup(spark, sf_dir):
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_size"])
    k, s = F.col("p_partkey"), F.col("p_size")

    def e(key, val):
        return F.struct(F.lit("specs").alias("map"), F.lit(key).alias("k"), val.cast("string").alias("v"))
    entries = F.filter(F.array(
        e("Mức giá", F.concat(s.cast("string"), F.lit(" triệu"))),
        e("Diện tích", F.concat((k % 300 + 20).cast("string"), F.lit(" m²"))),
        e("Phòng ngủ", F.concat((s % 5 + 1).cast("string"), F.lit(" PN"))),
        e("Số phòng ngủ", F.when(k % 3 == 0, F.lit("")).otherwise(F.concat((s % 4 + 1).cast("string"), F.lit(" phòng ngủ")))),
        F.when(k % 2 == 0, e("Mặt tiền (m)", F.concat((s % 10 + 2).cast("string"), F.lit("m")))),
        e("Pháp lý", F.col("p_brand")),
        F.when(k % 4 == 0, e("Diện tích", F.concat((s + 30).cast("string"), F.lit(" m2")))),
    ), lambda x: x.isNotNull())
    m = part.select("p_partkey", entries.alias("spec_entries"))
    raw = m.select(
        "p_partkey",
        EX.spec_value(F.col("spec_entries"), "specs", "Mức giá").alias("price_text"),
        EX.spec_value(F.col("spec_entries"), "specs", "Diện tích").alias("area_text"),
        F.coalesce(F.nullif(EX.spec_value(F.col("spec_entries"), "specs", "Số phòng ngủ"), F.lit("")),
                   EX.spec_value(F.col("spec_entries"), "specs", "Phòng ngủ")).alias("bedroom_text"),
        EX.spec_first_containing(F.col("spec_entries"), "specs", "Mặt tiền").alias("frontage_text"),
        EX.spec_first_containing(F.col("spec_entries"), "specs", "Pháp lý").alias("legal_text"))
    typed = T.apply_keyed(raw, [("price", "price_text", "price"), ("area", "area_text", "area"),
                                ("rooms", "bedroom_text", "bedroom"), ("frontage", "frontage_text", "frontage")],
                          ["p_partkey", "legal_text"])
    return typed.select("p_partkey", "price", "area", "bedroom", "frontage",
                        T.clean_text("legal_text").alias("legal"))


# ------------------------------------------------------------------ streaming (STR-1…6)


@query("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    root = J.run_dir(spark, "ingest")
    out = J.ingest(spark, table_path(sf_dir, "pages"), _generic_ruleset(), F.lit("generic"), _now(), root)
    return spark.read.parquet(out).select(
        "id", "title", "address", "city", "seller", "link", "source",
        F.md5("description").alias("description_md5"))


def _event_links(df):
    return df.select("event_id", "ts", F.concat(F.lit("https://listing.example/"),
                                                F.get_json_object("props", "$.k")).alias("link"))


@query("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    root = J.run_dir(spark, "dedup")
    path = table_path(sf_dir, "events")
    stream = _event_links(J.file_stream(spark, path))
    store = _event_links(read_table(spark, sf_dir, "events", ["event_id", "ts", "props"])).filter(
        F.regexp_extract("link", "([0-9]+)$", 1).cast("int") < 10)
    out = J.dedup_links(stream, store, root)
    return J.read_all_batches(spark, out).select("link")


def _in_three_files(spark, sf_dir, name, root):
    """The table as three files by row hash, so a stream over it takes three micro-batches."""
    path = root + "-input"
    (read_table(spark, sf_dir, name).withColumn("_part", F.pmod(F.xxhash64(*read_table(spark, sf_dir, name).columns), F.lit(3)))
     .repartition(3, "_part").drop("_part").write.parquet(path))
    return path


@query("stream_progress")
def q_stream_progress(spark, sf_dir):
    root = J.run_dir(spark, "progress")
    out = J.progress(J.event_feed(spark, table_path(sf_dir, "events")), root)
    return J.latest_batch(spark, out)


@query("stream_route")
def q_stream_route(spark, sf_dir):
    root = J.run_dir(spark, "route")
    outs = J.route(J.event_feed(spark, table_path(sf_dir, "events")), J.default_routes(), root)
    parts = [J.read_all_batches(spark, outs["listings"]).agg(F.count(F.lit(1)).alias("rows")).withColumn("sink", F.lit("listings")),
             J.read_all_batches(spark, outs["sessions"]).agg(F.count(F.lit(1)).alias("rows")).withColumn("sink", F.lit("sessions")),
             J.read_all_batches(spark, outs["log"]).agg(F.sum("count").cast("bigint").alias("rows")).withColumn("sink", F.lit("log"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("sink", "rows")


# ------------------------------------------------------------------ the full crawl (§3 entry 1)


@query("crawl_stats")
def q_crawl_stats(spark, sf_dir):
    """Result pages → links → known-link anti join → detail snapshots → parse → type → validate
    → per-source statistics.  Derived from ``pages``: every page is a detail snapshot of its
    first nav link (the newest per link is parsed), the store knows every second nav link."""
    pages = read_pages(spark, sf_dir).withColumn("source", F.lit("generic"))
    rules = _generic_ruleset()
    parsed = stage(EX.parse_list_pages(pages, rules), "crawl-parsed")     # parsed once, read three times
    nav = parsed.select("page_id", "pos", L.absolute_url(F.col("href"), F.col("url")).alias("link"))
    first = nav.filter(F.col("pos") == 1).select("page_id", "link")
    details = (pages.join(first, "page_id", "inner")
               .select("page_id", F.col("link").alias("url"), "source", "html"))
    store = nav.filter(F.col("pos") == 2).select("link")
    out = CR.crawl(pages, details, store, rules, _now(), links=parsed)
    return out["stats"].select("source", "total_pages", "successful_items", "failed_items", "duplicate_items",
                               "not_fetched_items", "total_items", "status")


@query("crawl_failures")
def q_crawl_failures(spark, sf_dir):
    """Pages that cannot be parsed fail alone: every page again as a broken copy."""
    pages = read_pages(spark, sf_dir)
    broken = pages.select("page_id", F.concat("url", F.lit("#broken")).alias("url"), F.concat(F.lit("<![x]>"), "html").alias("html"))
    both = pages.unionByName(broken).withColumn("source", F.lit("generic"))
    parsed = EX.parse_detail_pages(both, _generic_ruleset(), keep_errors=True)
    outcomes = parsed.select("source", F.when(F.col("parse_error").isNull(), "success").otherwise("failed").alias("outcome"))
    total = both.groupBy(F.col("source").alias("_source")).agg(F.count(F.lit(1)).alias("total_pages"))
    return CR.outcome_stats(outcomes, total)


@query("ruled_sources")
def q_ruled_sources(spark, sf_dir):
    """UDF-2: the sources that have rules, of those that the pages come from."""
    rules = EX.RuleSet()
    for src in RULED_SOURCES:
        rules = rules.register(src, EX.generic_rules(src))
    seen = _pages_with_source(spark, sf_dir).select("source").distinct()
    return EX.supported_sources(rules.to_df(spark)).join(seen, "source", "left_semi")


@query("progress_of_source")
def q_progress_of_source(spark, sf_dir):
    """AGG-7: progress of one source."""
    return S.progress_for(_feed(spark, sf_dir), "src7")


@query("successful_snapshots")
def q_successful_snapshots(spark, sf_dir):
    """FLT-1: snapshots with a non-empty title count as fetched."""
    pages = read_pages(spark, sf_dir).withColumn("success", F.lower("html").contains("<h1"))
    return LS.successful(pages).select("page_id", F.length("html").cast("bigint").alias("html_chars"))


@query("store_snapshot")
def q_store_snapshot(spark, sf_dir):
    """SNK-2/SNK-9: the listing store written as a snapshot and read back through its pointer,
    with the uniqueness check."""
    root = J.run_dir(spark, "snapshot")
    ST.write_snapshot(V.listing_view(spark, sf_dir), root, sort_within=("price",))
    stored = ST.current_snapshot(spark, root)
    twice = ST.duplicate_keys(stored).agg(F.count(F.lit(1)).alias("duplicate_links"))
    return (stored.groupBy("source").agg(F.count(F.lit(1)).alias("listings"), F.sum("price").alias("price"))
            .crossJoin(F.broadcast(twice)))


@query("stream_progress_fold")
def q_stream_progress_fold(spark, sf_dir):
    root = J.run_dir(spark, "progress-fold")
    out = J.progress_fold(J.event_feed(spark, table_path(sf_dir, "events")), root)
    return J.latest_batch(spark, out)


@query("stream_enrich_upsert")
def q_stream_enrich_upsert(spark, sf_dir):
    root = J.run_dir(spark, "enrich-upsert")
    out = J.ingest_enrich_upsert(spark, table_path(sf_dir, "pages"), _generic_ruleset(), F.lit("generic"), _now(),
                                 EN.rule_based_enricher(), root)
    return J.current_store(spark, out).select("id", "link", "title", "type", "legal", "amenityLocation", "source")


@query("stream_dedup_exact")
def q_stream_dedup_exact(spark, sf_dir):
    root = J.run_dir(spark, "dedup-exact")
    # every link comes again in later micro-batches
    stream = _event_links(J.file_stream(spark, _in_three_files(spark, sf_dir, "events", root), 1))
    store = _event_links(read_table(spark, sf_dir, "events", ["event_id", "ts", "props"])).filter(
        F.regexp_extract("link", "([0-9]+)$", 1).cast("int") < 10)
    out = J.dedup_links(stream, store, root)
    return J.read_all_batches(spark, out).select("link")


@query("stream_dedup_filter")
def q_stream_dedup_filter(spark, sf_dir):
    """Links of ten files, each new one once, by the sketches kept beside the store."""
    root = J.run_dir(spark, "dedup-filter")
    path = root + "-input"
    events = read_table(spark, sf_dir, "events", ["event_id", "ts", "props"])
    events.withColumn("_part", F.pmod(F.xxhash64("event_id"), F.lit(10))).repartition(10, "_part").drop("_part").write.parquet(path)
    links = _event_links(events).select("link")
    known = links.filter(F.regexp_extract("link", "([0-9]+)$", 1).cast("int") < 10)
    store = DS.DeltaStore(spark, root + "/links", links.schema, order_cols=())
    store.append(known, "seed", 0)
    J.dedup_into_store(_event_links(J.file_stream(spark, path, 1)), store, root, compact_every=4)
    return store.read().join(known.distinct(), "link", "left_anti")


@query("upsert_deltas")
def q_upsert_deltas(spark, sf_dir):
    """Ten batches into a delta store, the later five with newer rows of a third of the links; one batch comes twice."""
    v = V.listing_view(spark, sf_dir).select("id", "link", "price", "source", "crawled_at").withColumn("id", F.col("id").cast("long"))
    newer = (v.filter(F.col("id") % 3 == 0).withColumn("price", F.col("price") + 1).withColumn("crawled_at", F.col("crawled_at") + F.expr("interval 1 day"))
             .withColumn("id", F.col("id") + 10_000_000))
    store = DS.DeltaStore(spark, J.run_dir(spark, "upsert-deltas"), v.schema)
    for batch in [*range(10), 9]:
        part = (v if batch < 5 else newer).filter(F.pmod(F.xxhash64("link"), F.lit(5)) == batch % 5)
        if store.append(part, "load", batch) and batch % 4 == 3:
            store.compact(most_deltas=2, most_rows=2000)
    return store.read()
