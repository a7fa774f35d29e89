"""DuckDB SQL expression builders mirroring ``functions/text.py``.

Used only to write the oracle SQL the driver runs on DuckDB.  Each builder takes a SQL
expression string and returns one.  DuckDB's ``regexp_extract`` gives '' for no match and
``regexp_replace`` needs the 'g' flag to replace every match.
"""

from __future__ import annotations

from ..functions import patterns as P
from ..functions.regex import STRIP, WS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ext(s: str, pattern: str, group: int = 1) -> str:
    return f"NULLIF(regexp_extract({s}, {q(pattern)}, {group}), '')"


def rep(s: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({s}, {q(pattern)}, {q(repl)}, 'g')"


def blank_null(s: str, out: str, typ: str) -> str:
    return f"CASE WHEN {s} IS NULL OR {s} = '' THEN CAST(NULL AS {typ}) ELSE {out} END"


def py_strip(s: str) -> str:
    return rep(s, STRIP, "")


def clean_text(s: str) -> str:
    disallowed = r"[^\p{L}\p{N}_ " + P.CLEAN_KEEP_CLASS + "]"
    out = f"trim({rep(rep(s, WS + '+', ' '), disallowed, '')})"
    return blank_null(s, out, "VARCHAR")


def extract_price(s: str) -> str:
    t = f"replace(lower({s}), ',', '.')"
    parts = [f"COALESCE(TRY_CAST({ext(t, p)} AS DOUBLE) * CAST({m!r} AS DOUBLE), CAST(0 AS DOUBLE))" for p, m in P.PRICE_SUM_PARTS]
    total = "(" + " + ".join(parts) + ")"
    cands = []
    for p, m, groups in P.PRICE_FALLBACK:
        g1 = f"TRY_CAST({ext(t, p, 1)} AS DOUBLE)"
        if groups == 2:
            g2 = f"TRY_CAST({ext(t, p, 2)} AS DOUBLE)"
            val = f"({g1} + CASE WHEN {g2} < 10 THEN {g2} / 10.0 ELSE {g2} / 100.0 END)"
        else:
            val = g1
        cands.append(f"{val} * CAST({m!r} AS DOUBLE)")
    out = f"CASE WHEN {total} > 0 THEN {total} ELSE COALESCE({', '.join(cands)}) END"
    return blank_null(s, out, "DOUBLE")


def extract_area(s: str) -> str:
    t = f"replace(lower({s}), ',', '.')"
    out = "COALESCE(" + ", ".join(f"TRY_CAST({ext(t, p)} AS DOUBLE)" for p in P.AREA_PATTERNS) + ")"
    return blank_null(s, out, "DOUBLE")


def extract_phone(s: str) -> str:
    t = rep(s, r"[\t\n\x{0B}\f\r \p{Z}\x{85}\x{1C}-\x{1F}\-.]", "")
    raw = "COALESCE(" + ", ".join(ext(t, p) for p in P.PHONE_PATTERNS) + ")"
    norm = (f"CASE WHEN starts_with({raw}, '+84') THEN '0' || substr({raw}, 4) "
            f"WHEN starts_with({raw}, '84') THEN '0' || substr({raw}, 3) ELSE {raw} END")
    return blank_null(s, norm, "VARCHAR")


def mask_phone(p: str) -> str:
    return (f"CASE WHEN {p} IS NULL THEN NULL ELSE substr({p}, 1, 3) || "
            f"repeat('*', CAST(length({p}) - 5 AS BIGINT)) || right({p}, 2) END")


def _count_from(s: str, pats) -> str:
    t = f"lower({s})"
    stripped = py_strip(t)
    cands = [f"TRY_CAST({ext(t, p)} AS INTEGER)" for p in pats]
    cands.append(f"CASE WHEN regexp_matches({stripped}, '^[0-9]+$') THEN TRY_CAST({stripped} AS INTEGER) END")
    return blank_null(s, "COALESCE(" + ", ".join(cands) + ")", "INTEGER")


def extract_rooms(s: str) -> str:
    return _count_from(s, P.ROOM_PATTERNS)


def extract_bathrooms(s: str) -> str:
    return _count_from(s, P.BATH_PATTERNS)


def parse_date(s: str, as_of: str) -> str:
    t = clean_text(f"lower({s})")
    cands = []
    for p, order in P.DATE_PATTERNS:
        g = [ext(t, p, i) for i in (1, 2, 3)]
        y, m, d = (g[2], g[1], g[0]) if order == "dmy" else (g[0], g[1], g[2])
        txt = f"concat_ws('-', {y}, {m}, {d})"
        cands.append(f"CASE WHEN TRY_CAST({y} AS INTEGER) >= 1 THEN try_strptime({txt}, '%Y-%m-%d') END")

    def has_any(words):
        return "(" + " OR ".join(f"contains({t}, {q(w)})" for w in words) + ")"

    days = f"TRY_CAST({ext(t, P.DATE_DAYS_AGO)} AS INTEGER)"
    hours = f"TRY_CAST({ext(t, P.DATE_HOURS_AGO)} AS INTEGER)"
    minutes = f"TRY_CAST({ext(t, P.DATE_MINUTES_AGO)} AS INTEGER)"
    rel = (f"CASE WHEN {has_any(P.DATE_TODAY)} THEN {as_of} "
           f"WHEN {has_any(P.DATE_YESTERDAY)} THEN {as_of} - to_days(1) "
           f"WHEN contains({t}, {q(P.DATE_WEEK_WORDS[0])}) AND contains({t}, {q(P.DATE_WEEK_WORDS[1])}) "
           f"THEN {as_of} - to_days(7) "
           f"WHEN {days} IS NOT NULL THEN {as_of} - to_days({days}) "
           f"WHEN {hours} IS NOT NULL THEN {as_of} - to_hours({hours}) "
           f"WHEN {minutes} IS NOT NULL THEN {as_of} - to_minutes({minutes}) END")
    out = "COALESCE(" + ", ".join(cands) + f", CAST({rel} AS TIMESTAMP))"
    return blank_null(s, out, "TIMESTAMP")


def posted_date(s: str, as_of: str) -> str:
    return f"CAST({parse_date(s, as_of)} AS DATE)"


def format_date(d: str) -> str:
    return f"strftime({d}, '%d/%m/%Y')"


def extract_frontage(s: str) -> str:
    t = f"replace(lower({py_strip(f'CAST({s} AS VARCHAR)')}), ',', '.')"
    plain = f"CASE WHEN regexp_matches({t}, {q(P.FRONTAGE_NUMBER)}) THEN TRY_CAST(replace({t}, '_', '') AS DOUBLE) END"
    out = f"COALESCE({plain}, TRY_CAST({ext(t, P.FRONTAGE_METRES)} AS DOUBLE))"
    return f"CASE WHEN {s} IS NULL THEN CAST(NULL AS DOUBLE) ELSE {out} END"


def extract_city(s: str) -> str:
    part = py_strip(f"regexp_extract({s}, '[^,]*$', 0)")
    part = f"regexp_replace({part}, {q('(?i)' + P.CITY_PREFIX)}, '')"
    low = f"lower({part})"
    whens = " ".join(f"WHEN contains({low}, {q(k.lower())}) THEN {q(v)}" for k, v in P.CITY_MAPPING)
    rest = py_strip(f"regexp_replace({py_strip(part)}, {q('(?i)' + P.CITY_COUNTRY_SUFFIX)}, '')")
    out = f"CASE {whens} ELSE NULLIF({rest}, '') END"
    return blank_null(s, out, "VARCHAR")


def is_valid_url(s: str) -> str:
    return f"CASE WHEN {s} IS NULL OR {s} = '' THEN false ELSE regexp_matches({s}, {q('(?i)' + P.URL_VALID)}) END"


def unit_price(p: str, a: str) -> str:
    return f"CASE WHEN {p} > 0 AND {a} > 0 THEN floor({p} / {a} * 100 + 0.5) / 100 END"


def map_property_type(s: str) -> str:
    t = f"lower({s})"
    inlist = ", ".join(q(x) for x in P.PROPERTY_TYPES)
    whens = " ".join(f"WHEN contains({t}, {q(a)}) OR contains({q(a)}, {t}) THEN {q(a)}" for a in P.PROPERTY_TYPES)
    out = f"CASE WHEN {t} IN ({inlist}) THEN {t} {whens} ELSE {q(P.PROPERTY_TYPE_DEFAULT)} END"
    return blank_null(s, out, "VARCHAR")


def classify_type(s: str) -> str:
    t = f"lower({s})"
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains({t}, {q(w)})" for w in words) + f" THEN {q(typ)}"
        for typ, words in P.TYPE_KEYWORDS)
    return f"CASE {whens} END"


def legal_phrase(s: str) -> str:
    return ext(s, "(?i)(" + "|".join(P.LEGAL_PHRASES) + ")", 1)


def amenities(s: str) -> str:
    parts = ", ".join(ext(s, "(?i)" + p, 0) for p in P.AMENITY_PHRASES)
    return f"NULLIF(concat_ws(', ', {parts}), '')"


def response_array(s: str) -> str:
    return ext(s, r"(?s)\[.*\]", 0)
