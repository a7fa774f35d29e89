"""The typing step's generated code: the JVM compiles no method beyond 8,000 bytes."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from listingflow.functions import patterns as P
from listingflow.functions import text as X
from listingflow.functions.regex import needed
from listingflow.operators import enrich
from listingflow.operators import listing

COLUMNS = "id link source title address description price_text area_text bedroom_text bathroom_text frontage_text date_text".split()


def raw(spark):
    rows = [[str(i), f"https://a.example/{i}", "s", "Tin", "Quận 1, TP. Hồ Chí Minh", "sổ đỏ", "3 tỷ 500 triệu", "80,5 m²", "3 PN", "2 WC", "5,5", "12/5/2024"] for i in range(3)]
    rows.append([None] * len(COLUMNS))
    return spark.createDataFrame(rows, ", ".join(c + " string" for c in COLUMNS))


def method_sizes(spark, df):
    said = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", said)]


def test_no_generated_method_is_too_large_to_be_compiled(spark):
    sizes = method_sizes(spark, listing.normalise(raw(spark)))
    assert sizes and max(sizes) <= 8000


def test_typed_values_are_the_same(spark):
    rows = {r.id: r for r in listing.normalise(raw(spark)).collect()}
    assert set(rows) == {"0", "1", "2", None} and rows[None].link is None
    r = rows["1"]
    assert (r.link, r.price, r.area, r.bedroom, r.bathroom, r.frontage, str(r.postedDate)) == ("https://a.example/1", 3.5e9, 80.5, 3, 2, 5.5, "2024-05-12")


def test_no_generated_method_of_the_reply_merge_is_too_large_to_be_compiled(spark):
    typed = listing.normalise(raw(spark).withColumn("crawled_at", F.lit("2024-06-15").cast("timestamp_ntz")))
    replies = spark.createDataFrame([("a/1", '[{"id":"1","price":"2 tỷ"}]')], "batch_key string, text string")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")         # an adaptive plan shows its stages only as they run
    try:
        sizes = method_sizes(spark, enrich.merge_reply_items(typed, enrich.parse_replies(replies, "text", keep=["batch_key"]), ["batch_key", "pos"]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) <= 8000


def test_needed_words_are_certain():
    assert needed("ab?c") == [("a",), ("c",)] and needed("a{2}b") == [("b",)] and needed("ab+c") == [("ab",), ("c",)]
    assert needed("x(?:one|two)y") == [("x",), ("one", "two"), ("y",)] and needed("x(?:one|t.)y") == [("x",), ("y",)]
    assert needed("x(?:one|two)?y") == [("x",), ("y",)] and needed("[ab]c") == [("c",)] and needed(r"\.x\p{L}*y") == [("x",), ("y",)]
    assert needed("(?i)abc") == [] and needed("a|b") == [] and needed("(ab)") == []


def test_patterns_find_the_same_after_a_search_for_their_words(spark):
    patterns = [(p, 1) for p in [x[0] for x in P.PRICE_SUM_PARTS + P.PRICE_FALLBACK] + P.AREA_PATTERNS + P.ROOM_PATTERNS + P.BATH_PATTERNS]
    patterns += [(p, 1) for p in (P.DATE_DAYS_AGO, P.DATE_HOURS_AGO, P.DATE_MINUTES_AGO, P.FRONTAGE_METRES)] + [(p, 0) for p, _ in P.DATE_PATTERNS]
    words = "tỷ ty tỷ. triệu tr trâu tr/ nghìn ngàn k m² m2 m 2 mét met vuông vuong phòng ngủ tắm vệ sinh pn pnx bed bedroom wc toilet bath ngày giờ phút trước /1/2024 -1-2024".split()
    texts = [None, "", " ", "1/2/2024", "1-2-2024", "2024/1/2", "2024-1-2", "2 phòng vệ sinh", "2 phòng tắm", "2  ngủ"] + ["3" + gap + w + end for w in words for gap in ("", " ", ".5 ", ",5\u00a0") for end in ("", " ", " 2", "x", " vuông", " vuong", " ngủ", " sinh", "\ttrước")]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    plain = df.select(*[F.nullif(F.regexp_extract(t, p, g), F.lit("")) for p, g in patterns]).collect()
    found = df.select(*[F.nullif(X._found(t, p, g), F.lit("")) for p, g in patterns]).collect()
    assert [tuple(r) for r in found] == [tuple(r) for r in plain]
    assert [p for i, (p, _) in enumerate(patterns) if not any(r[i] for r in plain)] == []
