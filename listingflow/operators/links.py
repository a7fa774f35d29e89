"""Result-page operators on stored snapshots, done with native expressions (PRJ-3/4/5, FLT-2).

Plain anchors and headings are pulled out with ``regexp_extract_all`` + ``posexplode`` so the
work stays in whole-stage codegen; the rule-driven CSS extraction of detail pages lives in
``operators/extract.py`` (``mapInPandas``).  The ``html`` column never reaches a shuffle: every
function here projects it away before any aggregation.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, py_strip, starts_with_http

ANCHOR = r"(?is)<a\s[^>]*>.*?</a>"
HREF = r"""(?is)\shref\s*=\s*"([^"]*)\""""
TITLE_ATTR = r"""(?is)\stitle\s*=\s*"([^"]*)\""""
ANCHOR_INNER = r"(?is)<a\s[^>]*>(.*?)</a>"
TAG = r"<[^>]*>"
H1 = r"(?is)<h1[^>]*>(.*?)</h1>"
ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]*@)?([^/?#:]*)"

# The standard table of named references (Python's ``html.entities``): names with their ';', and
# the legacy names that also count without it.
NAMED_ENTITIES = dict(html5)
LEGACY_PREFIX = "^&(" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")"
# The HTML5 replacements for numeric references to 0x00, 0x0D and 0x80-0x9F.
NUMERIC_REPLACEMENTS = {
    0x00: "\ufffd", 0x0D: "\r", 0x80: "\u20ac", 0x81: "\x81", 0x82: "\u201a", 0x83: "\u0192",
    0x84: "\u201e", 0x85: "\u2026", 0x86: "\u2020", 0x87: "\u2021", 0x88: "\u02c6", 0x89: "\u2030",
    0x8A: "\u0160", 0x8B: "\u2039", 0x8C: "\u0152", 0x8D: "\x8d", 0x8E: "\u017d", 0x8F: "\x8f",
    0x90: "\x90", 0x91: "\u2018", 0x92: "\u2019", 0x93: "\u201c", 0x94: "\u201d", 0x95: "\u2022",
    0x96: "\u2013", 0x97: "\u2014", 0x98: "\u02dc", 0x99: "\u2122", 0x9A: "\u0161", 0x9B: "\u203a",
    0x9C: "\u0153", 0x9D: "\x9d", 0x9E: "\u017e", 0x9F: "\u0178",
}
# Code points a numeric reference may not produce (they decode to nothing): C0/C1 controls other
# than tab, newline, form feed and CR, U+FDD0-U+FDEF, and the last two code points of each plane.
INVALID_RANGES = [(0x01, 0x08), (0x0B, 0x0B), (0x0E, 0x1F), (0x7F, 0x9F), (0xFDD0, 0xFDEF)]
NUMERIC_REF = r"&#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
NAMED_REF = r"&[^\t\n\f <&#;]{1,32};?"
ENTITY_TOKEN = NUMERIC_REF + "|" + NAMED_REF + "|[^&]+|&"


def _code_point_text(n: Column) -> Column:
    """The character of code point ``n`` (UTF-16 units decoded natively)."""
    def unit(v):
        return F.lpad(F.hex(v), 4, "0")
    v = n - 0x10000
    pair = F.concat(unit(F.shiftright(v, 10) + 0xD800), unit(v.bitwiseAND(0x3FF) + 0xDC00))
    return F.decode(F.unhex(F.when(n < 0x10000, unit(n)).otherwise(pair)), "UTF-16BE")


def _decode_token(t: Column) -> Column:
    hexd = F.nullif(F.regexp_extract(t, r"^&#[xX]([0-9a-fA-F]+)", 1), F.lit(""))
    n = F.coalesce(F.conv(hexd, 16, 10), F.regexp_extract(t, r"^&#([0-9]+)", 1)).try_cast("bigint")
    numeric = F.when(n.isin(*NUMERIC_REPLACEMENTS), F.element_at(
        F.create_map(*[x for k, v in NUMERIC_REPLACEMENTS.items() for x in (F.lit(k), F.lit(v))]), n))
    invalid = None
    for lo, hi in INVALID_RANGES:
        c = (n >= lo) & (n <= hi)
        invalid = c if invalid is None else invalid | c
    invalid = invalid | (n.bitwiseAND(0xFFFE) == 0xFFFE)
    numeric = (F.when(n.isin(*NUMERIC_REPLACEMENTS), numeric)
               .when(n.isNull() | (n > 0x10FFFF) | ((n >= 0xD800) & (n <= 0xDFFF)), F.lit("\ufffd"))
               .when(invalid, F.lit(""))
               .otherwise(_code_point_text(n)))
    return (F.when(t.rlike("^" + NUMERIC_REF + "$"), numeric)
            .when(t.startswith("&") & (F.length(t) > 2), _decode_named(t)).otherwise(t))


def _decode_named(t: Column) -> Column:
    """A name of the table, else the longest legacy name it begins with, else as written."""
    # one string literal that folds to a map once per query
    table = F.str_to_map(F.lit("\x01".join(f"{n}\x02{c}" for n, c in sorted(NAMED_ENTITIES.items()))), F.lit("\x01"), F.lit("\x02"))
    prefix = F.regexp_extract(t, LEGACY_PREFIX, 1)
    return F.coalesce(F.try_element_at(table, F.substring(t, 2, 40)),
                      F.concat(F.try_element_at(table, F.nullif(prefix, F.lit(""))), t.substr(F.length(prefix) + 2, F.lit(1 << 30))), t)


def decode_entities(c: Column) -> Column:
    """HTML character references in extracted text, in one pass (so '&amp;#39;' stays '&#39;'):
    every numeric and named reference as an HTML parser decodes it.  Only text holding an '&' is
    tokenised and decoded token by token."""
    tokens = F.regexp_extract_all(c, F.lit(ENTITY_TOKEN), 0)
    return (F.when(~c.contains("&"), c)
            .otherwise(F.array_join(F.transform(tokens, _decode_token), "")))


def host_of(url) -> Column:
    u = F.col(url) if isinstance(url, str) else url
    return F.lower(F.regexp_extract(u, HOST, 2))


AUTHORITY = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"


def remove_dot_segments(url: Column) -> Column:
    """Dot-segment removal (RFC 3986 §5.2.4) on the path (after the authority, before '?'/'#'):
    a fold over the path's segments, of any depth."""
    head = F.regexp_extract(url, r"^([^?#]*)", 1)
    tail = F.substring(url, F.length(head) + 1, 1 << 30)
    auth = F.regexp_extract(head, AUTHORITY, 1)
    path = F.substring(head, F.length(auth) + 1, 1 << 30)
    segments = F.split(path, "/")
    kept = F.aggregate(
        F.slice(segments, 2, F.greatest(F.size(segments) - 1, F.lit(0))), F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc).otherwise(F.concat(acc, F.array(s))))
    closing = F.when(path.rlike(r"/\.\.?$"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.concat(auth, F.lit("/"), F.array_join(F.concat(kept, closing), "/"), tail)


def absolute_url(href: Column, base: Column) -> Column:
    """PRJ-4: resolve ``href`` against ``base`` unless it has a scheme of its own."""
    origin = F.regexp_extract(base, ORIGIN, 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    base_dir = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"[^/]*$", "")
    has_path = F.regexp_replace(base, ORIGIN, "").startswith("/")
    no_query = F.regexp_replace(base, r"[?#].*$", "")
    no_frag = F.regexp_replace(base, r"#.*$", "")
    joined = (F.when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
              .when(href.startswith("/"), F.concat(origin, href))
              .when(href.startswith("?"), F.concat(no_query, href))
              .when(href.startswith("#"), F.concat(no_frag, href))
              .when(has_path, F.concat(base_dir, href))
              .otherwise(F.concat(origin, F.lit("/"), href)))
    # every dot rule needs a '/.' in the URL: skip the passes for the usual URL without one
    return (F.when(href.startswith("http") | href.rlike(SCHEME), href)
            .when(joined.contains("/."), remove_dot_segments(joined))
            .otherwise(joined))


def page_links(pages: DataFrame, base_col: str = "url") -> DataFrame:
    """PRJ-3/4/5 + FLT-2: one row per anchor with an href: ``(page_id, pos, url, title)``.

    Title falls back from the ``title`` attribute to the anchor text (PRJ-5).  Raw fragments
    are cut out first (``html`` is dropped there); entity decoding runs in the next projection
    over those narrow string columns."""
    anchors = pages.select(
        "page_id", F.col(base_col).alias("_base"),
        F.posexplode(F.regexp_extract_all("html", F.lit(ANCHOR), 0)).alias("pos0", "a"))
    raw = (anchors.select("page_id", "pos0", "_base",
                          F.regexp_extract("a", HREF, 1).alias("_href"),
                          F.regexp_extract("a", TITLE_ATTR, 1).alias("_tattr"),
                          F.regexp_replace(F.regexp_extract("a", ANCHOR_INNER, 1), TAG, "").alias("_inner"))
           .filter(F.col("_href") != ""))
    dec = raw.select("page_id", "pos0", "_base", *[decode_entities(F.col(c)).alias(c)
                                                   for c in ("_href", "_tattr", "_inner")])
    title = F.coalesce(F.nullif(py_strip(F.col("_tattr")), F.lit("")),
                       F.nullif(py_strip(F.col("_inner")), F.lit("")))
    return dec.select("page_id", (F.col("pos0") + 1).alias("pos"),
                      absolute_url(F.col("_href"), F.col("_base")).alias("url"), title.alias("title"))


def page_summary(pages: DataFrame) -> DataFrame:
    """Per page: host, cleaned h1 title, number of hrefs, link-validity (FLT-3 on the page).
    The h1 fragment is cut out first, so decoding never sees the whole page row."""
    raw = pages.select(
        "page_id", "url", host_of("url").alias("host"),
        F.regexp_replace(F.regexp_extract("html", H1, 1), TAG, "").alias("_h1"),
        F.size(F.regexp_extract_all("html", F.lit(HREF), 1)).alias("n_links"))
    title = clean_text(py_strip(decode_entities(F.col("_h1"))))
    return (raw.select("page_id", "url", "host", title.alias("title"), "n_links")
            .withColumn("valid", F.coalesce(F.col("title") != "", F.lit(False)) & starts_with_http("url")))


def page_listing_stats(pages: DataFrame) -> DataFrame:
    """Flagship: pages → (host, title, links) → clean title → validate → per-host counts."""
    s = page_summary(pages)
    return (s.groupBy("host")
            .agg(F.count(F.lit(1)).alias("pages"),
                 F.count_if("valid").alias("valid_pages"),
                 F.sum("n_links").cast("bigint").alias("links"),
                 F.max(F.length("title")).cast("bigint").alias("max_title_len")))
