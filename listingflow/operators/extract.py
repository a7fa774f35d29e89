"""Rule-driven extraction from stored pages (PRJ-3, PRJ-5…10, PRJ-16, JOIN-6, UDF-1…3).

The only Python stage of the library.  ``mapInArrow`` parses each page once, evaluates the
CSS-like rules of the page's source and emits *raw strings* plus the label/value entries of
spec blocks; everything after it (spec-map lookups, typing, validation) is native Spark.  The
``html`` column is dropped by the parse, so it never reaches a shuffle.

A rule is ``(source, page_kind, field, priority, kind, selector, attr)``:

detail pages (``page_kind='detail'``), one value per field, rules tried by priority:
  css          text of the first element matching ``selector`` (PRJ-7: the first selector
               that matches wins even if its text is empty; no match gives null)
  attr         attribute ``attr`` of the first match
  parent_text  text of the parent of the first match
  page_text    text of the whole page (PRJ-16)
  const_url    the page URL
  spec_block   items ``selector``; ``attr`` = "label_sel||value_sel" (``sel[i]`` = i-th match)
               feeds the label/value map named by ``field`` (PRJ-8)
  spec_key     value of key ``attr`` in map ``selector``; '' falls through (PRJ-9)
  spec_contains  value of the first key containing ``attr`` ('ci:' any case, 'first:' the first
               matching entry's own value) (PRJ-10)
list pages (``page_kind='list'``): ``item`` selector, ``link`` selector inside the item
  ('&' = the item, 'a >> b' = b inside the first a) with ``attr='href'``, ``title`` rules
  (attr / css with ``attr`` naming the scope 'link' or 'item'), ``require_title`` flag.
"""

from __future__ import annotations

import re
from collections import defaultdict, namedtuple
from typing import Dict, Iterable, Iterator, List, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import html as H
from ..functions import postprocess as PP
from ..session import ship_package

Rule = namedtuple("Rule", "source page_kind field priority kind selector attr postprocess", defaults=[None])

RULE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("page_kind", T.StringType(), False),
    T.StructField("field", T.StringType(), False),
    T.StructField("priority", T.IntegerType(), False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("selector", T.StringType(), True),
    T.StructField("attr", T.StringType(), True),
    T.StructField("postprocess", T.StringType(), True),
])

DETAIL_FIELDS = ["title", "address", "seller", "description", "price_text", "area_text", "bedroom_text",
                 "bathroom_text", "frontage_text", "legal_text", "date_text", "phone_text", "link"]
SPEC_ENTRY = T.StructType([T.StructField("map", T.StringType()), T.StructField("k", T.StringType()),
                           T.StructField("v", T.StringType())])
LINK = T.StructType([T.StructField("url", T.StringType()), T.StructField("title", T.StringType())])
KINDS = {"css", "attr", "parent_text", "page_text", "const_url", "spec_block", "spec_key", "spec_contains",
         "item", "link", "flag"}

# ---------------------------------------------------------------- fixed values: site rules
# Selectors of the six supported sites, as the reference uses them (field, selectors in order).
_SPECS_ITEM = '.re__pr-specs-content-item'
_SPECS_FRONTAGE = ('.re__pr-specs-content-item:has(.re__pr-specs-content-item-title:-soup-contains("Mặt tiền")) '
                   '.re__pr-specs-content-item-value')
_LEGAL_GENERIC = ['.info-attr:nth-child(2) span:nth-child(2)', 'span:has(> span:-soup-contains("Pháp lý")) + span']

SITE_CSS = {
    "batdongsan.com.vn": {
        "title": ['h1.pr-title', 'h1.title', '.detail-title h1', 'h1', '.product-title'],
        "address": ['.re__pr-short-description'],
        "seller": ['.re__contact-name', '.seller-name', '.contact-name', '.agent-name'],
        "description": ['.re__section-body.js__pr-description', '.re__pr-description .re__section-body',
                        '.re__pr-des-content', '.description', '.content', '.detail-content'],
    },
    "nhatot.com": {
        "title": ['h1.title', 'h1'],
        "address": ['span.bwq0cbs.tunpaa5', 'div.address', 'span.address'],
        "price_text": ['div.plmkxo3 b.pyhk1dv'],
        "area_text": ['div.plmkxo3 span.brnpcl3.t19tc1ar'],
        "seller": ['div.SellerInfo_nameDiv__rWqQB b', 'span.seller-name', 'div.seller strong'],
        "bedroom_text": ["strong[itemprop='rooms']", 'div.rooms strong', 'span.rooms'],
        "bathroom_text": ["strong[itemprop='toilets']", 'div.toilets strong', 'span.toilets'],
        "frontage_text": [_SPECS_FRONTAGE],
        "legal_text": ["strong[itemprop='property_legal_document']", 'div.legal-doc strong', 'span.legal-doc'],
        "date_text": ['div.r9vw5if span.tpc9glo'],
        "description": ["p[itemprop='description']", 'div.description', 'span.description'],
    },
    "mogi.vn": {
        "title": ['.main-info .title h1'],
        "address": ['div.address', '.main-info .address'],
        "price_text": ['.main-info .price'],
        "seller": ['.agent-name a'],
        "description": ['.info-content-body'],
    },
    "bds123.vn": {
        "title": ['header h1'],
        "address": ["td:has(div:-soup-contains('Địa chỉ')) + td"],
        "seller": ['.agent-name a', '.agent-name', '.author-name', '.contact-name',
                   '.mt-3.text-center > span.fs-5.fw-medium'],
        "description": ['.post__main__content', '.info-content-body', '.description'],
        "price_text": ['header .d-flex > div.fs-6.fw-semibold.text-pink'],
        "area_text": ['header .d-flex > div.fs-6.d-flex.ms-5'],
        "frontage_text": [_SPECS_FRONTAGE],
        "legal_text": _LEGAL_GENERIC,
        "date_text": ["tr:has(div:-soup-contains('Ngày đăng')) time", 'tr td time'],
    },
    "sosanhnha.com": {
        "title": ['h1.text-xl.font-medium.text-slate-700'],
        "address": ['div.detail-params div.item:has(.label:-soup-contains("Địa chỉ")) .value'],
        "price_text": ['span.price.text-2xl'],
        "area_text": ['span.area'],
        "seller": ['.page-right .font-bold.text-gray-700'],
        "bedroom_text": ['div.detail-params div.item:has(.label:-soup-contains("Phòng ngủ")) .value'],
        "bathroom_text": ['div.detail-params div.item:has(.label:-soup-contains("Vệ sinh")) .value'],
        "frontage_text": [_SPECS_FRONTAGE],
        "legal_text": _LEGAL_GENERIC,
        "date_text": ['div.detail-params div.item:has(.label:-soup-contains("Cập nhật")) .value'],
        "description": ['.description'],
    },
    "muaban.net": {
        "title": ['h1.sc-6orc5o-8', 'h1.title', 'h1'],
        "address": ['div.address', '.address'],
        "price_text": ['div.price', '.price'],
        "area_text": ['li:has(.label:-soup-contains("Diện tích đất")) span:not(.label)'],
        "seller": ['.sc-lohvv8-4 .title', '.seller-name', '.author .title'],
        "bedroom_text": ['li:has(.label:-soup-contains("Số phòng ngủ")) span:not(.label)'],
        "bathroom_text": ['li:has(.label:-soup-contains("Số phòng vệ sinh")) span:not(.label)'],
        "frontage_text": [_SPECS_FRONTAGE],
        "legal_text": ['li:has(.label:-soup-contains("Giấy tờ pháp lý")) span:not(.label)'],
        "date_text": ['div.sc-6orc5o-21.ebxmhG div:has(span.label:-soup-contains("Ngày bắt đầu")) span.value'],
        "description": ['.sc-6orc5o-10.eRboKF'],
    },
}
# (source, map name, item selector, label selector, value selector)
SITE_SPEC_BLOCKS = [
    ("batdongsan.com.vn", "specs", _SPECS_ITEM,
     '.re__pr-specs-content-item-title', '.re__pr-specs-content-item-value'),
    ("batdongsan.com.vn", "info", '.re__pr-short-info-item', '.title', '.value'),
    ("mogi.vn", "info", '.info-attrs .info-attr', 'span[0]', 'span[1]'),
]
# (source, field, map name, [keys in order]) and (source, field, map name, phrase)
SITE_SPEC_KEYS = [
    ("batdongsan.com.vn", "price_text", "specs", ["Mức giá"]),
    ("batdongsan.com.vn", "area_text", "specs", ["Diện tích"]),
    ("batdongsan.com.vn", "bedroom_text", "specs", ["Số phòng ngủ", "Phòng ngủ"]),
    ("batdongsan.com.vn", "bathroom_text", "specs", ["Số phòng tắm, vệ sinh", "Phòng tắm"]),
    ("mogi.vn", "area_text", "info", ["Diện tích đất"]),
    ("mogi.vn", "bedroom_text", "info", ["Phòng ngủ"]),
    ("mogi.vn", "bathroom_text", "info", ["Nhà tắm"]),
    ("mogi.vn", "frontage_text", "info", ["Mặt tiền"]),
    ("mogi.vn", "legal_text", "info", ["Pháp lý"]),
    ("mogi.vn", "date_text", "info", ["Ngày đăng"]),
]
SITE_SPEC_CONTAINS = [
    ("batdongsan.com.vn", "frontage_text", "specs", "Mặt tiền"),
    ("batdongsan.com.vn", "legal_text", "specs", "Pháp lý"),
    ("batdongsan.com.vn", "date_text", "info", "ci:first:ngày đăng"),
]
SITE_PARENT_TEXT = [("bds123.vn", "bedroom_text", "i.icon.bed"), ("bds123.vn", "bathroom_text", "i.icon.bath")]
SITE_PAGE_TEXT = [("batdongsan.com.vn", "phone_text"), ("bds123.vn", "phone_text")]
# list pages: (source, item selector, link selector, [(kind, selector/attr, scope)], require_title)
SITE_LISTS = [
    ("batdongsan.com.vn", "a.js__product-link-for-product-id", "&",
     [("attr", "title", "link"), ("css", "span.pr-title.js__card-title", "item"),
      ("css", "h3.re__card-title span", "item")], True),
    ("nhatot.com", "div.c15fd2pn", "a[href]", [("css", "h3", "link")], False),
    ("mogi.vn", "div:class-re(prop-info)", "a[href]",
     [("css", "h1:class-re(prop-title), a:class-re(prop-title)", "item")], False),
    ("bds123.vn", "li:class-re(vip|normal|free)", "h3 >> a[href]", [("attr", "title", "link"), ("css", "&", "link")], False),
    ("sosanhnha.com", "div:class-re(w-full border-b)", "a:class-re(font-bold)",
     [("attr", "title", "link"), ("css", "&", "link")], False),
    ("muaban.net", "div.sc-c7upxc-3.cBJHnx", "a[href]", [("css", "h3", "link")], False),
]

# What a site does to a field's text once it is found (PRJ-13: the site gives 0 for "unknown").
SITE_POSTPROCESS = {
    **{("bds123.vn", f): "clean_text" for f in ("title", "address", "seller", "description")},
    **{("bds123.vn", f): "zero_as_null" for f in ("price_text", "area_text", "frontage_text", "bedroom_text", "bathroom_text")},
}


def site_rules() -> List[Rule]:
    """The rule rows of the six supported sites."""
    rules: List[Rule] = []
    after = SITE_POSTPROCESS
    for src, fields in SITE_CSS.items():
        for field, sels in fields.items():
            rules += [Rule(src, "detail", field, i + 1, "css", s, None) for i, s in enumerate(sels)]
        rules.append(Rule(src, "detail", "link", 1, "const_url", None, None))
    for src, name, item, lab, val in SITE_SPEC_BLOCKS:
        rules.append(Rule(src, "detail", name, 1, "spec_block", item, f"{lab}||{val}"))
    for src, field, name, keys in SITE_SPEC_KEYS:
        rules += [Rule(src, "detail", field, 10 + i, "spec_key", name, k) for i, k in enumerate(keys)]
    for src, field, name, phrase in SITE_SPEC_CONTAINS:
        rules.append(Rule(src, "detail", field, 10, "spec_contains", name, phrase))
    for src, field, sel in SITE_PARENT_TEXT:
        rules.append(Rule(src, "detail", field, 1, "parent_text", sel, None))
    for src, field in SITE_PAGE_TEXT:
        rules.append(Rule(src, "detail", field, 1, "page_text", None, None))
    for src, item, link, titles, req in SITE_LISTS:
        rules.append(Rule(src, "list", "item", 1, "item", item, None))
        rules.append(Rule(src, "list", "link", 1, "link", link, "href"))
        rules += [Rule(src, "list", "title", i + 1, k, s, scope) for i, (k, s, scope) in enumerate(titles)]
        if req:
            rules.append(Rule(src, "list", "require_title", 1, "flag", None, "true"))
    return [r._replace(postprocess=after.get((r.source, r.field))) if r.page_kind == "detail" else r for r in rules]


def generic_rules(source: str) -> List[Rule]:
    """Rules for plain article pages such as the given ``pages`` table."""
    return [
        Rule(source, "detail", "title", 1, "css", "h1.title", None),
        Rule(source, "detail", "title", 2, "css", "h1", None),
        Rule(source, "detail", "description", 1, "css", "article", None),
        Rule(source, "detail", "seller", 1, "css", "footer", None),
        Rule(source, "detail", "address", 1, "css", "div.ad", None),
        Rule(source, "detail", "phone_text", 1, "page_text", None, None),
        Rule(source, "detail", "link", 1, "const_url", None, None),
        Rule(source, "list", "item", 1, "item", "nav li", None),
        Rule(source, "list", "link", 1, "link", "a[href]", "href"),
        Rule(source, "list", "title", 1, "attr", "title", "link"),
        Rule(source, "list", "title", 2, "css", "&", "link"),
    ]


# ---------------------------------------------------------------- registry of rules (UDF-1/2)
class RuleSet:
    """Extraction rules by source; a small configuration table (broadcast with the tasks)."""

    REQUIRED_DETAIL = {"title", "link"}

    def __init__(self, rules: Iterable[Rule] = (), postprocessors: Dict[str, PP.Processor] | None = None):
        self.rules: List[Rule] = []
        self.postprocessors = {**PP.POSTPROCESSORS, **(postprocessors or {})}
        for r in rules:
            self._check(r)
            self.rules.append(r)

    def _check(self, r: Rule) -> None:
        PP.check(r.postprocess, self.postprocessors)
        if r.kind not in KINDS:
            raise ValueError(f"unknown rule kind {r.kind!r}")
        if r.kind in ("css", "attr", "parent_text", "spec_block", "item", "link") and r.selector not in (None, "&"):
            H.compile_selector(r.selector.split(" >> ")[0])

    def register(self, source: str, rules: Iterable[Rule]) -> "RuleSet":
        """UDF-1: add a site's rules (checked: known kinds, parseable selectors, title + link)."""
        new = [r._replace(source=source) for r in rules]
        fields = {r.field for r in new if r.page_kind == "detail"}
        missing = self.REQUIRED_DETAIL - fields
        if missing:
            raise ValueError(f"rules for {source} lack required fields {sorted(missing)}")
        return RuleSet(self.rules + new, self.postprocessors)

    def with_postprocessor(self, name: str, fn: PP.Processor) -> "RuleSet":
        """UDF-3: add a named post-processor that rules registered from now on may use."""
        return RuleSet(self.rules, {**self.postprocessors, name: fn})

    def sources(self) -> List[str]:
        return sorted({r.source for r in self.rules})

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(r) for r in self.rules], RULE_SCHEMA)

    def by_source(self) -> Dict[str, List[Rule]]:
        out: Dict[str, List[Rule]] = defaultdict(list)
        for r in sorted(self.rules, key=lambda r: (r.source, r.page_kind, r.field, r.priority)):
            out[r.source].append(r)
        return dict(out)


def supported_sources(rules_df: DataFrame) -> DataFrame:
    """UDF-2: sources that have rules."""
    return rules_df.select("source").distinct()


# ---------------------------------------------------------------- in-task evaluation
def _sel_one(scope: H.Node, sel: str):
    if sel == "&":
        return scope
    node = scope
    for part in sel.split(" >> "):
        node = H.select_one(node, part) if node is not None else None
    return node


_NTH = re.compile(r"^(.*)\[(\d+)\]$")


def _nth(scope: H.Node, spec: str):
    """``sel[i]``: the i-th element matching ``sel`` inside ``scope``; plain ``sel``: the first."""
    m = _NTH.match(spec)
    if m:
        found = H.select(scope, m.group(1))
        i = int(m.group(2))
        return found[i] if i < len(found) else None
    return H.select_one(scope, spec)


def _detail(doc: H.Node, url: str, rules: Sequence[Rule]):
    values, entries, page_text = {}, [], None
    by_field = defaultdict(list)
    for r in rules:
        if r.page_kind == "detail":
            by_field[r.field].append(r)
    for field, rs in by_field.items():
        for r in rs:
            if r.kind == "spec_block":
                lab_sel, val_sel = r.attr.split("||")
                for item in H.select(doc, r.selector):
                    lab, val = _nth(item, lab_sel), _nth(item, val_sel)
                    if lab is not None and val is not None:
                        entries.append((field, lab.text(strip=True), val.text(strip=True)))
                continue
            if r.kind in ("spec_key", "spec_contains"):
                continue                                     # resolved natively afterwards
            if r.kind == "const_url":
                values[field] = url
            elif r.kind == "page_text":
                page_text = doc.text() if page_text is None else page_text
                values[field] = page_text
            else:
                node = _sel_one(doc, r.selector)
                if node is None:
                    continue
                if r.kind == "css":
                    values[field] = node.text(strip=True)
                elif r.kind == "attr":
                    values[field] = node.attrs.get(r.attr)
                elif r.kind == "parent_text":
                    values[field] = node.parent.text(strip=True) if node.parent is not None else None
            if field in values:
                break                                        # PRJ-7: first matching rule wins
    return values, entries


def _links(doc: H.Node, rules: Sequence[Rule]):
    lr = [r for r in rules if r.page_kind == "list"]
    item = next((r for r in lr if r.field == "item"), None)
    link = next((r for r in lr if r.field == "link"), None)
    if item is None or link is None:
        return []
    titles = sorted((r for r in lr if r.field == "title"), key=lambda r: r.priority)
    require_title = any(r.field == "require_title" for r in lr)
    out = []
    for it in H.select(doc, item.selector):
        a = _sel_one(it, link.selector)
        if a is None or not a.attrs.get(link.attr or "href"):
            continue
        title = ""
        for t in titles:
            scope = a if t.attr == "link" else it
            if t.kind == "attr":
                title = (scope.attrs.get(t.selector) or "").strip()
            else:
                n = _sel_one(scope, t.selector)
                title = n.text(strip=True) if n is not None else ""
            if title:
                break
        if require_title and not title:
            continue
        out.append((a.attrs.get(link.attr or "href"), title))
    return out


#: Pages parsed at once inside a task hold about this much HTML (one larger page alone).
PART_BYTES = 1 << 20


def by_bytes(batch: pa.RecordBatch, column: str, most_bytes: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices (views, nothing is copied) with about ``most_bytes`` of ``column``: what a
    task makes of a slice stays small however many rows Spark hands over at once."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_pylist()
    begin = held = 0
    for i, size in enumerate(sizes):
        if i > begin and held + size > most_bytes:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield batch.slice(begin)


def _parser(rules_by_source: Dict[str, List[Rule]], page_kind: str, phone: bool = True):
    if not phone:
        rules_by_source = {s: [r for r in rs if r.field != "phone_text"] for s, rs in rules_by_source.items()}

    schema = to_arrow_schema(DETAIL_SCHEMA if page_kind == "detail" else LIST_SCHEMA)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "html"):
                rows = []
                for page_id, url, source, html in zip(*(part[c].to_pylist() for c in ("page_id", "url", "source", "html"))):
                    rules = rules_by_source.get(source)
                    if rules is None:
                        continue
                    row = {"page_id": page_id, "url": url, "source": source, "parse_error": None}
                    values, entries, links = {}, [], []
                    try:                          # a page that cannot be parsed fails alone
                        doc = H.parse(html)
                        if page_kind == "detail":
                            values, entries = _detail(doc, url, rules)
                        else:
                            links = _links(doc, rules)
                    except Exception as e:  # noqa: BLE001 - whatever the page provokes is its own outcome
                        row["parse_error"] = f"{type(e).__name__}: {e}"[:200]
                    if page_kind == "detail":
                        rows.append({**row, **{f: values.get(f) for f in DETAIL_FIELDS},
                                     "spec_entries": [{"map": m, "k": k, "v": v} for m, k, v in entries]})
                    else:
                        rows.append({**row, "links": [{"url": u, "title": t} for u, t in links]})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return fn


DETAIL_SCHEMA = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
     T.StructField("source", T.StringType())]
    + [T.StructField(f, T.StringType()) for f in DETAIL_FIELDS]
    + [T.StructField("spec_entries", T.ArrayType(SPEC_ENTRY)), T.StructField("parse_error", T.StringType())])
LIST_SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                            T.StructField("source", T.StringType()), T.StructField("links", T.ArrayType(LINK)),
                            T.StructField("parse_error", T.StringType())])


def parse_detail_pages(pages: DataFrame, rules: RuleSet, keep_errors: bool = False, phone: bool = True) -> DataFrame:
    """PRJ-6: ``(page_id, url, source, html)`` → raw detail fields + spec entries, then the
    spec lookups natively (PRJ-8/9/10).  Pages of sources without rules yield no row.

    A page that cannot be parsed never ends the job: with ``keep_errors`` it yields a row with
    null fields and its ``parse_error``, otherwise it is left out.  Without ``phone`` the text that
    phone numbers are looked for in (the whole page) is not sent back."""
    ship_package(pages.sparkSession)
    parsed = pages.select("page_id", "url", "source", "html").mapInArrow(
        _parser(rules.by_source(), "detail", phone), DETAIL_SCHEMA)
    if not keep_errors:
        parsed = parsed.filter(F.col("parse_error").isNull()).drop("parse_error")
    return postprocess(resolve_specs(parsed, rules), rules)


def postprocess(parsed: DataFrame, rules: RuleSet) -> DataFrame:
    """UDF-3: each source's named post-processors on its fields, in one native projection."""
    per_field: Dict[str, Dict[str, str]] = defaultdict(dict)
    for r in rules.rules:
        if r.page_kind == "detail" and r.postprocess and r.field in parsed.columns:
            if per_field[r.field].setdefault(r.source, r.postprocess) != r.postprocess:
                raise ValueError(f"rules for {r.source}.{r.field} name different post-processors")
    out = {}
    for field, by_source in per_field.items():
        expr = F.col(field)
        for source, names in by_source.items():
            expr = F.when(F.col("source") == source, PP.compiled(F.col(field), names, rules.postprocessors)).otherwise(expr)
        out[field] = expr
    return parsed.withColumns(out) if out else parsed


def parse_list_pages(pages: DataFrame, rules: RuleSet) -> DataFrame:
    """PRJ-3 with site rules: one row per link ``(page_id, source, pos, href, title)``; a page
    that cannot be parsed gives no link."""
    ship_package(pages.sparkSession)
    parsed = pages.select("page_id", "url", "source", "html").mapInArrow(
        _parser(rules.by_source(), "list"), LIST_SCHEMA)
    return parsed.select("page_id", "url", "source", F.posexplode("links").alias("pos0", "l")).select(
        "page_id", "url", "source", (F.col("pos0") + 1).alias("pos"),
        F.col("l.url").alias("href"), F.col("l.title").alias("title"))


# ---------------------------------------------------------------- native spec lookups
def spec_value(entries: Column, map_name: str, key: str) -> Column:
    """PRJ-8/9: value of ``key`` in the named label/value map; the last duplicate wins."""
    hits = F.filter(entries, lambda e: (e["map"] == map_name) & (e["k"] == key))
    return F.try_element_at(hits, F.lit(-1))["v"]


def spec_first_containing(entries: Column, map_name: str, phrase: str) -> Column:
    """PRJ-10: value of the first key (in first-seen order) containing ``phrase`` — the value
    last stored under that key, as a dict lookup gives.  Prefixes: ``ci:`` any case; ``first:``
    the value of the first matching entry itself (a loop that stops at the first match)."""
    ci = first_entry = False
    while phrase.startswith(("ci:", "first:")):
        if phrase.startswith("ci:"):
            ci, phrase = True, phrase[3:]
        else:
            first_entry, phrase = True, phrase[6:]
    p = phrase.lower() if ci else phrase

    def has(e):
        k = F.lower(e["k"]) if ci else e["k"]
        return (e["map"] == map_name) & k.contains(p)

    head = F.try_element_at(F.filter(entries, has), F.lit(1))
    if first_entry:
        return head["v"]
    hits = F.filter(entries, lambda e: (e["map"] == map_name) & (e["k"] == head["k"]))
    return F.try_element_at(hits, F.lit(-1))["v"]


def resolve_specs(parsed: DataFrame, rules: RuleSet) -> DataFrame:
    """Fill spec-based fields per source: ``m.get(a) or m.get(b)`` chains and key search."""
    by_field: Dict[str, Dict[str, List[Rule]]] = defaultdict(lambda: defaultdict(list))
    for r in rules.rules:
        if r.page_kind == "detail" and r.kind in ("spec_key", "spec_contains"):
            by_field[r.field][r.source].append(r)
    e = F.col("spec_entries")
    out = {}
    for field, per_source in by_field.items():
        expr = F.col(field)
        for source, rs in per_source.items():
            rs = sorted(rs, key=lambda r: r.priority)
            vals = [spec_value(e, r.selector, r.attr) if r.kind == "spec_key"
                    else spec_first_containing(e, r.selector, r.attr) for r in rs]
            chain = vals[-1]
            for v in reversed(vals[:-1]):
                chain = F.coalesce(F.nullif(v, F.lit("")), chain)
            expr = F.when(F.col("source") == source, F.coalesce(F.col(field), chain)).otherwise(expr)
        out[field] = expr
    return parsed.withColumns(out) if out else parsed


def dispatch(pages: DataFrame, rules_df: DataFrame) -> DataFrame:
    """JOIN-6: pages ⋈ the sources that have rules.  The rule table is configuration (one row
    per rule), so it is broadcast; pages of unknown sources are kept with ``has_rules=false``
    (the reference raises for them)."""
    srcs = supported_sources(rules_df).withColumn("has_rules", F.lit(True))
    j = pages.join(F.broadcast(srcs), "source", "left")
    return j.withColumn("has_rules", F.coalesce(F.col("has_rules"), F.lit(False)))
