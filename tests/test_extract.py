"""Rule-driven extraction on hand-written pages: one per site, each rule kind, PRJ-7 empty
first match, PRJ-8 duplicate labels, PRJ-9 fall-through, PRJ-10 key search, malformed HTML."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from listingflow.functions import html as H
from listingflow.operators import extract as EX
from listingflow.operators import listing as LS

NOW = dt.datetime(2024, 6, 15)

BATDONGSAN = """<html><body>
<h1 class="pr-title">Bán nhà  phố ★ Quận 3</h1>
<span class="re__pr-short-description">12 Lê Lợi, Phường 4, Quận 3, TP. Hồ Chí Minh</span>
<div class="re__contact-name">Anh Minh</div>
<div class="re__section-body js__pr-description">Nhà đẹp, sổ hồng. Gọi 0912 345 678</div>
<div class="re__pr-specs-content-item"><span class="re__pr-specs-content-item-title">Mức giá</span>
  <span class="re__pr-specs-content-item-value">12 tỷ 500 triệu</span></div>
<div class="re__pr-specs-content-item"><span class="re__pr-specs-content-item-title">Diện tích</span>
  <span class="re__pr-specs-content-item-value">60 m²</span></div>
<div class="re__pr-specs-content-item"><span class="re__pr-specs-content-item-title">Diện tích</span>
  <span class="re__pr-specs-content-item-value">80 m²</span></div>
<div class="re__pr-specs-content-item"><span class="re__pr-specs-content-item-title">Số phòng ngủ</span>
  <span class="re__pr-specs-content-item-value"></span></div>
<div class="re__pr-specs-content-item"><span class="re__pr-specs-content-item-title">Phòng ngủ</span>
  <span class="re__pr-specs-content-item-value">3 phòng</span></div>
<div class="re__pr-specs-content-item"><span class="re__pr-specs-content-item-title">Mặt tiền (m)</span>
  <span class="re__pr-specs-content-item-value">5 m</span></div>
<div class="re__pr-specs-content-item"><span class="re__pr-specs-content-item-title">Pháp lý</span>
  <span class="re__pr-specs-content-item-value">Sổ hồng riêng</span></div>
<div class="re__pr-short-info-item"><span class="title">Ngày đăng</span><span class="value">10/06/2024</span></div>
</body></html>"""

NHATOT = """<html><body><h1 class="title"></h1><h1>Nhà khác</h1>
<span class="address">Cầu Giấy, Hà Nội</span>
<div class="plmkxo3"><b class="pyhk1dv">3,2 tỷ</b><span class="brnpcl3 t19tc1ar">45 m²</span></div>
<strong itemprop="rooms">2</strong><strong itemprop="toilets">2 WC</strong>
<strong itemprop="property_legal_document">Sổ đỏ</strong>
<div class="r9vw5if"><span class="tpc9glo">hôm qua</span></div>
<p itemprop="description">Gần công viên</p></body></html>"""

MOGI = """<html><body><div class="main-info"><div class="title"><h1>Căn hộ Vinhomes</h1></div>
<div class="address">Quận 9, Hồ Chí Minh</div><div class="price">2,5 tỷ</div></div>
<div class="info-attrs">
 <div class="info-attr"><span>Diện tích đất</span><span>70 m2</span></div>
 <div class="info-attr"><span>Phòng ngủ</span><span>2</span></div>
 <div class="info-attr"><span>Nhà tắm</span><span>1</span></div>
 <div class="info-attr"><span>Pháp lý</span><span>Hợp đồng mua bán</span></div>
 <div class="info-attr"><span>Ngày đăng</span><span>01/06/2024</span></div>
 <div class="info-attr"><span>Lẻ</span></div>
</div><div class="agent-name"><a>Chị Lan</a></div><div class="info-content-body">Mô tả</div></body></html>"""

BDS123 = """<html><body><header><h1>Nhà mặt tiền</h1>
<div class="d-flex"><div class="fs-6 fw-semibold text-pink">7 tỷ</div><div class="fs-6 d-flex ms-5">100 m2</div></div>
</header>
<table><tr><td><div>Địa chỉ</div></td><td>Hải Châu, Đà Nẵng</td></tr>
<tr><td><div>Ngày đăng</div></td><td><time>2024-05-20</time></td></tr></table>
<span><i class="icon bed"></i>4 phòng ngủ</span><span><i class="icon bath"></i>3</span>
<span><span>Pháp lý</span></span><span>Sổ đỏ</span>
<div class="agent-name"><a>Ông Ba</a></div><div class="post__main__content">Liên hệ +84 905 111 222</div>
<p>unclosed <b>bold</body></html>"""

SOSANHNHA = """<html><body><h1 class="text-xl font-medium text-slate-700">Đất nền</h1>
<div class="detail-params"><div class="item"><span class="label">Địa chỉ</span><span class="value">Biên Hòa, Đồng Nai</span></div>
<div class="item"><span class="label">Phòng ngủ</span><span class="value">3PN</span></div>
<div class="item"><span class="label">Vệ sinh</span><span class="value">2</span></div>
<div class="item"><span class="label">Cập nhật</span><span class="value">3 ngày trước</span></div></div>
<span class="price text-2xl">950 triệu</span><span class="area">120 m²</span>
<div class="page-right"><div class="font-bold text-gray-700">Cô Tư</div></div><div class="description">Đất thổ cư</div></body></html>"""

MUABAN = """<html><body><h1 class="title">Bán nhà</h1><div class="address">Ninh Kiều, Cần Thơ</div>
<div class="price">1,8 tỷ</div><ul><li><span class="label">Diện tích đất</span><span>64 m2</span></li>
<li><span class="label">Số phòng ngủ</span><span>3</span></li><li><span class="label">Số phòng vệ sinh</span><span>2</span></li>
<li><span class="label">Giấy tờ pháp lý</span><span>Sổ hồng</span></li></ul>
<div class="sc-6orc5o-21 ebxmhG"><div><span class="label">Ngày bắt đầu</span><span class="value">14/06/2024</span></div></div>
<div class="seller-name">Bà Năm</div><div class="sc-6orc5o-10 eRboKF">Nhà 1 trệt 1 lầu</div></body></html>"""

PAGES = [("batdongsan.com.vn", BATDONGSAN), ("nhatot.com", NHATOT), ("mogi.vn", MOGI), ("bds123.vn", BDS123),
         ("sosanhnha.com", SOSANHNHA), ("muaban.net", MUABAN)]


@pytest.fixture(scope="module")
def typed(spark):
    rows = [(i, f"https://{s}/tin/{i}", s, h) for i, (s, h) in enumerate(PAGES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, source string, html string")
    raw = EX.parse_detail_pages(pages, EX.RuleSet(EX.site_rules()))
    raw = raw.withColumn("crawled_at", F.lit(NOW).cast("timestamp_ntz"))
    return {r["source"]: r.asDict() for r in LS.normalise(raw, keep_phone=True).collect()}


def test_batdongsan(typed):
    r = typed["batdongsan.com.vn"]
    assert r["title"] == "Bán nhà phố  Quận 3"           # whitespace collapsed before ★ is deleted
    assert r["city"] == "Hồ Chí Minh"
    assert r["price"] == 12_500_000_000.0
    assert r["area"] == 80.0                          # PRJ-8: last duplicate label wins
    assert r["bedroom"] == 3                           # PRJ-9: '' falls through to 'Phòng ngủ'
    assert r["frontage"] == 5.0                        # PRJ-10: first key containing 'Mặt tiền'
    assert r["legal"] == "Sổ hồng riêng"
    assert r["postedDate"] == dt.date(2024, 6, 10)
    assert r["numberPhone"] == "0912345678"           # phone from the whole page text
    assert r["unit_price"] == 156250000.0
    assert r["link"] == "https://batdongsan.com.vn/tin/0"


def test_nhatot(typed):
    r = typed["nhatot.com"]
    assert r["title"] is None                          # PRJ-7: empty first match wins, '' → null
    assert (r["price"], r["area"], r["bedroom"], r["bathroom"]) == (3_200_000_000.0, 45.0, 2, 2)
    assert r["legal"] == "Sổ đỏ" and r["postedDate"] == dt.date(2024, 6, 14)
    assert r["city"] == "Hà Nội"


def test_mogi(typed):
    r = typed["mogi.vn"]
    assert r["title"] == "Căn hộ Vinhomes" and r["price"] == 2_500_000_000.0
    assert (r["area"], r["bedroom"], r["bathroom"]) == (70.0, 2, 1)
    assert r["legal"] == "Hợp đồng mua bán" and r["postedDate"] == dt.date(2024, 6, 1)
    assert r["seller"] == "Chị Lan" and r["city"] == "Hồ Chí Minh"


def test_bds123(typed):
    r = typed["bds123.vn"]
    assert r["title"] == "Nhà mặt tiền" and r["address"] == "Hải Châu, Đà Nẵng" and r["city"] == "Đà Nẵng"
    assert (r["price"], r["area"], r["bedroom"], r["bathroom"]) == (7e9, 100.0, 4, 3)
    assert r["legal"] == "Sổ đỏ"                       # span:has(> span:-soup-contains) + span
    assert r["postedDate"] == dt.date(2024, 5, 20)     # the reference's ':contains(' never matched (Q11)
    assert r["numberPhone"] == "0905111222"


def test_sosanhnha_muaban(typed):
    s = typed["sosanhnha.com"]
    assert (s["price"], s["area"], s["bedroom"], s["bathroom"]) == (950_000_000.0, 120.0, 3, 2)
    assert s["postedDate"] == dt.date(2024, 6, 12) and s["city"] == "Đồng Nai"
    m = typed["muaban.net"]
    assert (m["price"], m["area"], m["bedroom"], m["bathroom"]) == (1.8e9, 64.0, 3, 2)
    assert m["legal"] == "Sổ hồng" and m["postedDate"] == dt.date(2024, 6, 14) and m["city"] == "Cần Thơ"


LIST_BDS = """<div><a class="js__product-link-for-product-id" href="/ban/1" title="Tin 1"></a>
<a class="js__product-link-for-product-id" href="/ban/2"><span class="pr-title js__card-title">Tin 2</span></a>
<a class="js__product-link-for-product-id" href="/ban/3"></a>
<a class="js__product-link-for-product-id" href="https://batdongsan.com.vn/ban/4"><h3 class="re__card-title"><span>Tin 4</span></h3></a></div>"""
LIST_BDS123 = """<ul><li class="item vip"><h3><a href="/p/1" title=" A ">x</a></h3></li>
<li class="normal"><h3><a href="/p/2">B text</a></h3></li><li class="other"><h3><a href="/p/3">C</a></h3></li></ul>"""


def test_list_pages(spark):
    rows = [(1, "https://batdongsan.com.vn/nha-dat-ban", "batdongsan.com.vn", LIST_BDS),
            (2, "https://bds123.vn/ban-nha.html", "bds123.vn", LIST_BDS123)]
    pages = spark.createDataFrame(rows, "page_id long, url string, source string, html string")
    links = EX.parse_list_pages(pages, EX.RuleSet(EX.site_rules())).orderBy("page_id", "pos").collect()
    got = [(r["page_id"], r["href"], r["title"]) for r in links]
    assert got == [(1, "/ban/1", "Tin 1"), (1, "/ban/2", "Tin 2"),          # /ban/3 has no title: dropped
                   (1, "https://batdongsan.com.vn/ban/4", "Tin 4"),
                   (2, "/p/1", "A"), (2, "/p/2", "B text")]


def test_register_and_dispatch(spark):
    rules = EX.RuleSet(EX.site_rules())
    with pytest.raises(ValueError):
        rules.register("x.vn", [EX.Rule("x", "detail", "title", 1, "css", "h1", None)])   # no link rule
    with pytest.raises(ValueError):
        EX.RuleSet([EX.Rule("x", "detail", "title", 1, "css", "h1:bogus", None)])
    r2 = rules.register("x.vn", EX.generic_rules("x.vn"))
    assert "x.vn" in r2.sources() and len(r2.sources()) == 7
    assert sorted(x[0] for x in EX.supported_sources(r2.to_df(spark)).collect()) == r2.sources()


def test_malformed_html():
    doc = H.parse("<div><p>one<p>two</div><script>var t='</p>';</script><b>open")
    assert doc.text(strip=True) == "onetwoopen"
    assert H.select_one(doc, "p p").text() == "two"


def test_has_relative_selectors():
    doc = H.parse("<div id='a'><p><b>x</b></p></div><div id='b'><section><p><b>y</b></p></section></div>")
    assert [n.attrs["id"] for n in H.select(doc, "div:has(> p b)")] == ["a"]
    assert [n.attrs["id"] for n in H.select(doc, "div:has(p b)")] == ["a", "b"]
    assert [n.attrs["id"] for n in H.select(doc, "div:has(> section)")] == ["b"]


def test_spec_lookups_first_and_last(spark):
    entries = [("specs", "Mặt tiền (m)", "4 m"), ("specs", "Mặt tiền (m)", "6 m"), ("info", "Ngày đăng", "01/06/2024"),
               ("info", "NGÀY ĐĂNG", "02/06/2024"), ("info", "Ngày đăng", "03/06/2024")]
    df = spark.createDataFrame([(entries,)], "e array<struct<map:string,k:string,v:string>>")
    r = df.select(EX.spec_first_containing(F.col("e"), "specs", "Mặt tiền").alias("a"),
                  EX.spec_first_containing(F.col("e"), "info", "ci:ngày đăng").alias("b"),
                  EX.spec_first_containing(F.col("e"), "info", "ci:first:ngày đăng").alias("c"),
                  EX.spec_value(F.col("e"), "specs", "Mặt tiền (m)").alias("d")).first()
    assert (r["a"], r["b"], r["c"], r["d"]) == ("6 m", "03/06/2024", "01/06/2024", "6 m")


def test_selector_subset():
    doc = H.parse("""<ul><li class="a x" data-k="alpha"><span class="label">L</span><span>1</span></li>
    <li class="b" data-k="beta-2"><span>2</span></li><li id="z" class="c VIP-item" data-k="gamma x">3</li></ul>
    <p>p1</p><div>d</div><p>p2</p>""")
    ids = lambda sel: [n.text(strip=True) for n in H.select(doc, sel)]
    assert ids("li[data-k^='al']") == ["L1"] and ids("li[data-k$='-2']") == ["2"]
    assert ids("li[data-k*='mm']") == ["3"] and ids("li[data-k~='x']") == ["3"]
    assert ids("li[data-k|='beta']") == ["2"] and ids("li[data-k]")[1:] == ["2", "3"]
    assert ids("li span:not(.label)") == ["1", "2"] and ids("li:nth-child(2)") == ["2"]
    assert ids("#z") == ["3"] and ids("li.a.x") == ["L1"] and ids("ul > li > span.label") == ["L"]
    assert ids("p ~ p") == ["p2"] and ids("div + p") == ["p2"] and ids("li:class-re(vip)") == ["3"]
    assert ids("p, li.b") == ["2", "p1", "p2"]                     # groups come back in document order
    assert H.select_one(doc, "table") is None
    with pytest.raises(ValueError):
        H.compile_selector("li:first-of-type")


def test_postprocessors_run_by_name_and_unknown_names_are_refused(spark):
    rules = EX.generic_rules("x")
    with pytest.raises(ValueError, match="unknown post-processor 'shout'"):
        EX.RuleSet().register("x", [r._replace(postprocess="clean_text|shout") for r in rules])
    named = EX.RuleSet().with_postprocessor("shout", lambda c: F.concat(c, F.lit("!")))
    named = named.register("x", [r._replace(postprocess="clean_text|shout" if r.field == "title" else None) for r in rules])
    named = named.register("y", EX.generic_rules("y"))
    pages = spark.createDataFrame([(1, "u", s, "<h1> Nhà  đẹp </h1><article>a</article>") for s in "xy"] + [(2, "u", "x", "<p>none</p>")], "page_id long, url string, source string, html string")
    got = {(r["source"], r["page_id"]): r["title"] for r in EX.parse_detail_pages(pages, named).collect()}
    assert got[("x", 1)].endswith("!") and not got[("y", 1)].endswith("!") and got[("x", 2)] is None
    both = EX.RuleSet([r._replace(postprocess="lower" if r.priority == 1 else "upper") for r in rules if r.field == "title"])
    with pytest.raises(ValueError, match="different post-processors"):
        EX.postprocess(spark.createDataFrame([("x", "t")], "source string, title string"), both)
    assert [tuple(r) for r in named.to_df(spark).filter("postprocess is not null").select("field", "postprocess").distinct().collect()] == [("title", "clean_text|shout")]


def test_a_site_that_writes_zero_for_unknown(spark):
    texts = ["0", "0 triệu", "0,0 m²", "Thỏa thuận", "10 m", "05", "", None]
    raw = spark.createDataFrame([(i, t, s) for i, t in enumerate(texts) for s in ("bds123.vn", "mogi.vn")], "i int, price_text string, source string")
    got = {(r["i"], r["source"]): r["price_text"] for r in EX.postprocess(raw, EX.RuleSet(EX.site_rules())).collect()}
    assert [got[(i, "bds123.vn")] for i in range(8)] == [None, None, None, "Thỏa thuận", "10 m", "05", None, None]
    assert [got[(i, "mogi.vn")] for i in range(8)] == texts


def test_pages_are_parsed_in_parts_of_bounded_size():
    """However many pages come in one batch, a task holds the output of about one part at a time."""
    import pyarrow as pa

    html = ["<h1>" + "x" * n + "</h1>" for n in (10, EX.PART_BYTES, 400_000, 400_000, 400_000, 5)] + [None]
    batch = pa.RecordBatch.from_pylist([{"page_id": i, "url": f"u{i}", "source": "s" if i != 5 else None, "html": h} for i, h in enumerate(html)],
                                       pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("source", pa.string()), ("html", pa.string())]))
    assert [p.num_rows for p in EX.by_bytes(batch, "html")] == [1, 1, 2, 3]
    assert list(EX.by_bytes(batch.slice(0, 0), "html")) == []
    out = list(EX._parser({"s": EX.generic_rules("s")}, "detail")(iter([batch])))
    assert [o.num_rows for o in out] == [1, 1, 2, 2]
    rows = [r for o in out for r in o.to_pylist()]
    assert [r["page_id"] for r in rows] == [0, 1, 2, 3, 4, 6] and [len(r["title"] or "") for r in rows][:2] == [10, EX.PART_BYTES]
