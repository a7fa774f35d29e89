"""Text normalisation as native Spark Column expressions (no Python UDF).

Every function takes a Column (or column name) and returns a Column, so a whole listing is
typed by native expressions inside whole-stage codegen.  Heavy normalisers come in two halves,
``*_key`` (the cleaned text a rule chain reads many times) and ``*_from_key``; applying them as
two projections (``apply_keyed``) keeps Catalyst from inlining the key into every branch.
Semantics follow the reference's helpers, including their first-match-wins orders; see
``patterns.py`` for the fixed values.
"""

from __future__ import annotations

import functools

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .regex import STRIP, WS, needed


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def by_name(fn):
    """Memoise a Column builder called with column *names*: the expression only names its
    inputs, so it can be reused by every DataFrame of the same SparkContext.  Building the big
    normalisers costs hundreds of JVM calls; this makes repeated query construction cheap."""
    cache = {}

    @functools.wraps(fn)
    def wrapper(*args):
        sc = SparkContext._active_spark_context
        if sc is not None and args and all(isinstance(a, str) for a in args):
            key = (sc.applicationId, args)
            col = cache.get(key)
            if col is None:
                col = cache[key] = fn(*args)
            return col
        return fn(*args)
    return wrapper


def _extract(s: Column, pattern: str, group: int = 1) -> Column:
    """First match's group, null when there is no match (Spark gives '')."""
    return F.nullif(F.regexp_extract(s, pattern, group), F.lit(""))


def _found(s: Column, pattern: str, group: int = 1) -> Column:
    """First match's group, null when there is no match: never '', which a cast to double or a
    parsed date answers with an exception inside.  Most texts lack the words that a pattern needs;
    a search for those costs a small part of the regex."""
    out = F.get(F.regexp_extract_all(s, F.lit(pattern), F.lit(group)), F.lit(0))
    conds = [functools.reduce(Column.__or__, [s.contains(w) for w in words]) for words in needed(pattern)]
    return F.when(functools.reduce(Column.__and__, conds), out) if conds else out


def _number(s: Column, pattern: str, group: int, typ: str) -> Column:
    """The number in the first match's group, null when there is none."""
    return _found(s, pattern, group).try_cast(typ)


def py_strip(x) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace of any kind."""
    return F.regexp_replace(_c(x), STRIP, "")


@by_name
def clean_text(x) -> Column:
    """SCL-1: null/empty -> null; collapse whitespace; drop characters outside word chars,
    whitespace and the kept punctuation; trim.  May return ''."""
    s = _c(x)
    disallowed = r"[^\p{L}\p{N}_ " + P.CLEAN_KEEP_CLASS + "]"
    out = F.trim(F.regexp_replace(F.regexp_replace(s, WS + "+", " "), disallowed, ""))
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("string")).otherwise(out)


def _price_fallback(t: Column) -> Column:
    cands = []
    for pattern, mult, groups in P.PRICE_FALLBACK:
        g1 = _number(t, pattern, 1, "double")
        if groups == 2:
            g2 = _number(t, pattern, 2, "double")
            # same division as "b/10 if b < 10 else b/100", with b read in always-evaluated
            # positions so its code is generated once
            val = g1 + g2 / F.when(g2 < 10, F.lit(10.0)).otherwise(F.lit(100.0))
        else:
            val = g1
        cands.append(val * F.lit(mult))
    return F.coalesce(*cands)


@by_name
def price_key(x) -> Column:
    """The text extract_price works on: lower-cased, ',' read as '.' (null for null/empty)."""
    s = _c(x)
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("string")).otherwise(
        F.replace(F.lower(s), F.lit(","), F.lit(".")))


@by_name
def extract_price(x) -> Column:
    """SCL-2: Vietnamese price text -> VND as double (compat mode, quirks Q2 kept)."""
    return price_from_key(price_key(x))


@by_name
def price_sum_key(key) -> Column:
    """The sum of a ``price_key``'s unit parts, which ``price_from_key`` reads more than once."""
    t = _c(key)
    total = None
    for pattern, mult in P.PRICE_SUM_PARTS:
        part = F.coalesce(_number(t, pattern, 1, "double") * F.lit(mult), F.lit(0.0))
        total = part if total is None else total + part
    return total


@by_name
def price_from_key(key, sum_key=None) -> Column:
    t = _c(key)
    total = price_sum_key(t) if sum_key is None else _c(sum_key)
    out = F.when(total > 0, total).otherwise(_price_fallback(t))
    return F.when(t.isNull(), F.lit(None).cast("double")).otherwise(out)


@by_name
def extract_area(x) -> Column:
    """SCL-3: area in m² from text, first of four unit patterns."""
    return area_from_key(price_key(x))


@by_name
def area_from_key(key) -> Column:
    t = _c(key)
    return F.coalesce(*[_number(t, p, 1, "double") for p in P.AREA_PATTERNS])


@by_name
def extract_phone(x) -> Column:
    """SCL-4: Vietnamese phone number normalised to a leading 0 (personal data)."""
    s = _c(x)
    t = F.regexp_replace(s, r"[\t\n\x{0B}\f\r \p{Z}\x{85}\x{1C}-\x{1F}\-.]", "")
    raw = F.coalesce(*[_extract(t, p, 1) for p in P.PHONE_PATTERNS])
    # '+84…' and '84…' become '0…' (a match of the first pattern already starts with '0')
    norm = F.regexp_replace(raw, r"^(?:\+84|84)", "0")
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("string")).otherwise(norm)


@by_name
def mask_phone(x) -> Column:
    """Masked form of a phone number: first 3 and last 2 digits kept."""
    p = _c(x)
    return F.when(p.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.substring(p, 1, 3), F.repeat(F.lit("*"), F.length(p) - 5),
                 F.substring(p, -2, 2)))


@by_name
def lower_key(x) -> Column:
    """Lower-cased text, null for null/empty: the input of the room counters."""
    s = _c(x)
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("string")).otherwise(F.lower(s))


def _count_from_key(key, patterns) -> Column:
    t = _c(key)
    stripped = py_strip(t)
    cands = [_number(t, p, 1, "int") for p in patterns]
    cands.append(F.when(stripped.rlike("^[0-9]+$"), stripped.try_cast("int")))
    return F.coalesce(*cands)


@by_name
def rooms_from_key(key) -> Column:
    return _count_from_key(key, P.ROOM_PATTERNS)


@by_name
def bathrooms_from_key(key) -> Column:
    return _count_from_key(key, P.BATH_PATTERNS)


@by_name
def extract_rooms(x) -> Column:
    """SCL-5: bedroom count."""
    return rooms_from_key(lower_key(x))


@by_name
def extract_bathrooms(x) -> Column:
    """SCL-6: bathroom count (bare 'phòng' is tried first, quirk Q4 kept)."""
    return bathrooms_from_key(lower_key(x))


_DATE_FORMATS = {"dmy": "d{sep}M{sep}yyyy", "ymd": "yyyy{sep}M{sep}d"}


@by_name
def date_key(x) -> Column:
    """The text parse_date works on: lower-cased, then clean_text (null for null/empty)."""
    return clean_text(F.lower(_c(x)))


@by_name
def date_abs_key(key) -> Column:
    """The absolute part of SCL-7 on a ``date_key``: each date shape is matched whole and
    parsed with a strict format, so an impossible calendar date falls through to the next."""
    t = _c(key)
    cands = []
    for pattern, order in P.DATE_PATTERNS:
        sep = "/" if "/" in pattern else "-"
        whole = _found(t, pattern, 0)
        cands.append(F.try_to_timestamp(whole, F.lit(_DATE_FORMATS[order].format(sep=sep))))
    return F.coalesce(*cands).cast("timestamp_ntz")


#: Relative dates reach back at most this many days (a little less than 2,000 years, so the result is a valid date).
MOST_DAYS_AGO = 700_000


@by_name
def date_rel_key(key) -> Column:
    """The relative part of SCL-7 on a ``date_key``: a day-time interval to count back from the
    snapshot time, or null when the text names no relative date."""
    t = _c(key)
    # a count that would leave the calendar reads as no date at all
    def ago(pattern, unit_days):
        n = _number(t, pattern, 1, "bigint")
        return F.when(n <= MOST_DAYS_AGO * unit_days, n.try_cast("int"))

    days, hours, minutes = ago(P.DATE_DAYS_AGO, 1), ago(P.DATE_HOURS_AGO, 24), ago(P.DATE_MINUTES_AGO, 24 * 60)

    def has_any(words):
        cond = None
        for w in words:
            c = t.contains(w)
            cond = c if cond is None else (cond | c)
        return cond

    return (F.when(has_any(P.DATE_TODAY), F.make_dt_interval(F.lit(0)))
            .when(has_any(P.DATE_YESTERDAY), F.make_dt_interval(F.lit(1)))
            .when(t.contains(P.DATE_WEEK_WORDS[0]) & t.contains(P.DATE_WEEK_WORDS[1]), F.make_dt_interval(F.lit(7)))
            .when(days.isNotNull(), F.make_dt_interval(days))
            .when(hours.isNotNull(), F.make_dt_interval(F.lit(0), hours))
            .when(minutes.isNotNull(), F.make_dt_interval(F.lit(0), F.lit(0), minutes)))


def apply_date_parts(abs_ts, rel, as_of) -> Column:
    """Absolute date if any, else ``as_of`` minus the relative interval (each read once)."""
    return F.coalesce(_c(abs_ts), (_c(as_of) - _c(rel)).cast("timestamp_ntz"))


@by_name
def parse_date_key(key, as_of) -> Column:
    """SCL-7 on a ``date_key`` column: absolute shapes first, then relative phrases."""
    t = _c(key)
    out = apply_date_parts(date_abs_key(t), date_rel_key(t), as_of)
    return F.when(t.isNull(), F.lit(None).cast("timestamp_ntz")).otherwise(out)


@by_name
def parse_date(x, as_of) -> Column:
    """SCL-7: date text -> timestamp; relative phrases count back from ``as_of``.

    ``as_of`` (a timestamp column, e.g. the snapshot time) replaces the wall clock.  In wide
    projections prefer ``date_key`` in one select and ``parse_date_key`` in the next.
    """
    return parse_date_key(date_key(x), as_of)


@by_name
def posted_date(x, as_of) -> Column:
    """PRJ-15: parsed date cut to midnight, as a ``date``."""
    return F.to_date(parse_date(x, as_of))


@by_name
def posted_date_key(key, as_of) -> Column:
    return F.to_date(parse_date_key(key, as_of))


def format_date(x) -> Column:
    """SCL-11: dd/MM/yyyy."""
    return F.date_format(_c(x), "dd/MM/yyyy")


@by_name
def frontage_key(x) -> Column:
    """Stripped, lower-cased text with ',' as '.', the input of extract_frontage."""
    c = _c(x)
    return F.replace(F.lower(py_strip(c.cast("string"))), F.lit(","), F.lit("."))


@by_name
def frontage_from_key(key) -> Column:
    t = _c(key)
    plain = F.when(t.rlike(P.FRONTAGE_NUMBER), F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))
    return F.coalesce(plain, _number(t, P.FRONTAGE_METRES, 1, "double"))


@by_name
def extract_frontage(x) -> Column:
    """SCL-8: frontage in metres: a plain number, or a number followed by 'm' (not m²/m2)."""
    return frontage_from_key(frontage_key(x))


@by_name
def city_key(x) -> Column:
    """Last comma part of an address, stripped, administrative prefix removed."""
    s = _c(x)
    part = py_strip(F.regexp_extract(s, "[^,]*$", 0))
    part = F.regexp_replace(part, "(?iu)" + P.CITY_PREFIX, "")
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("string")).otherwise(part)


@by_name
def extract_city(x) -> Column:
    """SCL-9: canonical city from an address (text after the last comma)."""
    return city_from_key(city_key(x))


@by_name
def city_from_key(key, low_key=None) -> Column:
    """``low_key``: the key in lower case, which every name is looked for in."""
    part = _c(key)
    low = F.lower(part) if low_key is None else _c(low_key)
    chain = None
    for key, value in P.CITY_MAPPING:
        cond = low.contains(key.lower())
        chain = F.when(cond, F.lit(value)) if chain is None else chain.when(cond, F.lit(value))
    rest = py_strip(F.regexp_replace(py_strip(part), "(?iu)" + P.CITY_COUNTRY_SUFFIX, ""))
    out = chain.otherwise(F.nullif(rest, F.lit("")))
    return F.when(part.isNull(), F.lit(None).cast("string")).otherwise(out)


@by_name
def is_valid_url(x) -> Column:
    """FLT-7: URL shape test (scheme, domain/localhost/IP, port, path)."""
    s = _c(x)
    return F.when(s.isNull() | (s == ""), F.lit(False)).otherwise(s.rlike("(?i)" + P.URL_VALID))


def starts_with_http(x) -> Column:
    """SCL-14."""
    return F.coalesce(_c(x).startswith("http"), F.lit(False))


def contains_ci(x, needle: str) -> Column:
    """SCL-13: case-insensitive containment."""
    return F.lower(_c(x)).contains(needle.lower())


@by_name
def unit_price(price, area) -> Column:
    """PRJ-14: round(price / area, 2) when both are positive; half-up rounding."""
    p, a = _c(price), _c(area)
    return F.when((p > 0) & (a > 0), round_cents(p / a))


def round_cents(x: Column) -> Column:
    """Two decimals, half up; from 2^53 / 100 on a double has no cents and stays as it is."""
    return F.when(x < float(2 ** 53 // 100), F.floor(x * 100 + 0.5) / 100).otherwise(x)


@by_name
def map_property_type(x) -> Column:
    """SCL-10: exact type, else first allowed type contained either way, else the default."""
    s = _c(x)
    t = F.lower(s)
    chain = F.when(t.isin(*P.PROPERTY_TYPES), t)
    for allowed in P.PROPERTY_TYPES:
        chain = chain.when(t.contains(allowed) | F.lit(allowed).contains(t), F.lit(allowed))
    out = chain.otherwise(F.lit(P.PROPERTY_TYPE_DEFAULT))
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("string")).otherwise(out)


@by_name
def classify_type(x) -> Column:
    """ENR-8: property type from keywords in free text, first rule that matches."""
    t = F.lower(_c(x))
    chain = None
    for typ, words in P.TYPE_KEYWORDS:
        cond = None
        for w in words:
            c = t.contains(w)
            cond = c if cond is None else (cond | c)
        chain = F.when(cond, F.lit(typ)) if chain is None else chain.when(cond, F.lit(typ))
    return chain


@by_name
def legal_phrase(x) -> Column:
    """ENR-9: the first legal-document phrase, verbatim, or null."""
    pat = "(?iu)(" + "|".join(P.LEGAL_PHRASES) + ")"
    return _extract(_c(x), pat, 1)


@by_name
def amenities(x) -> Column:
    """ENR-10: nearby-amenity phrases found in the text, verbatim, in rule order."""
    s = _c(x)
    parts = [_extract(s, "(?iu)" + p, 0) for p in P.AMENITY_PHRASES]
    return F.nullif(F.concat_ws(", ", *parts), F.lit(""))


def response_array(x) -> Column:
    """SCL-12: outermost [...] of a model reply (fences ignored) as JSON text."""
    return _extract(_c(x), r"(?s)\[.*\]", 0)


# ------------------------------------------------------------------ two-step application
# (key builder, value-from-key builder) per normaliser.  Applying them as two projections lets
# Catalyst keep the key in its own projection (it is read many times by the second), which keeps
# every generated method well under the JVM's 64 KB limit.
KEYED = {
    "price": (price_key, price_from_key),
    "area": (price_key, area_from_key),
    "rooms": (lower_key, rooms_from_key),
    "bathrooms": (lower_key, bathrooms_from_key),
    "frontage": (frontage_key, frontage_from_key),
    "city": (city_key, city_from_key),
}


def apply_keyed(df, specs, keep=()):
    """``specs``: list of ``(kind, source column, output name)``; returns ``keep`` + outputs."""
    keep = list(keep)
    k = df.select(*keep, *[KEYED[kind][0](src).alias("_k_" + out) for kind, src, out in specs])
    return k.select(*keep, *[KEYED[kind][1]("_k_" + out).alias(out) for kind, src, out in specs])
