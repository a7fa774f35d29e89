"""Oracle SQL (DuckDB) for each registered query, same names and column aliases.

Tables ``pages documents orders events nation region part ...`` are the driver's views; the
derived listing views are inlined as CTEs from the very same SQL text Spark runs.
"""

from __future__ import annotations

from typing import Dict

from ..operators import links as L
from ..sources.views import duck_view_sql
from . import duck as D
from ..functions.regex import WS as _WS
from ..operators.enrich import DEFAULT_TEMPLATE
from ..functions import patterns as PT

ORACLES: Dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


def with_views(*names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({duck_view_sql(n)})" for n in names) + "\n"


def _entity(name: str) -> str:
    """Lookup in the table of named references, as one string: chr(1) name chr(2) characters."""
    table = D.q("".join(f"\x01{n}\x02{c}" for n, c in sorted(L.NAMED_ENTITIES.items())) + "\x01")
    return f"NULLIF(split_part(split_part({table}, chr(1) || {name} || chr(2), 2), chr(1), 1), '')"


def _decode_token_sql(t: str) -> str:
    n = (f"(CASE WHEN regexp_matches({t}, '^&#[xX]') "
         f"THEN TRY_CAST('0x' || regexp_extract({t}, '^&#[xX]([0-9a-fA-F]+)', 1) AS BIGINT) "
         f"ELSE TRY_CAST(regexp_extract({t}, '^&#([0-9]+)', 1) AS BIGINT) END)")
    table = " ".join(f"WHEN {k} THEN {D.q(v)}" for k, v in L.NUMERIC_REPLACEMENTS.items())
    invalid = " OR ".join(f"({n} BETWEEN {lo} AND {hi})" for lo, hi in L.INVALID_RANGES)
    invalid += f" OR ({n} % 65536 IN (65534, 65535))"
    keys = ", ".join(str(k) for k in L.NUMERIC_REPLACEMENTS)
    numeric = (f"CASE WHEN {n} IN ({keys}) THEN (CASE {n} {table} END) "
               f"WHEN {n} IS NULL OR {n} > 1114111 OR ({n} BETWEEN 55296 AND 57343) THEN {D.q(chr(0xFFFD))} "
               f"WHEN {invalid} THEN '' ELSE chr(CAST({n} AS INTEGER)) END")
    prefix = f"regexp_extract({t}, {D.q(L.LEGACY_PREFIX)}, 1)"
    named = (f"COALESCE({_entity(f'substr({t}, 2)')}, CASE WHEN {prefix} <> '' THEN {_entity(prefix)} || substr({t}, length({prefix}) + 2) END, {t})")
    return (f"CASE WHEN regexp_matches({t}, {D.q('^' + L.NUMERIC_REF + '$')}) THEN {numeric} "
            f"WHEN starts_with({t}, '&') AND length({t}) > 2 THEN {named} ELSE {t} END")


def decode_entities(s: str) -> str:
    tokens = f"regexp_extract_all({s}, {D.q(L.ENTITY_TOKEN)}, 0)"
    return (f"CASE WHEN NOT contains({s}, '&') THEN {s} "
            f"ELSE array_to_string(list_transform({tokens}, lambda tok: {_decode_token_sql('tok')}), '') END")


def node_text(frag: str) -> str:
    return D.py_strip(decode_entities(f"regexp_replace({frag}, {D.q(L.TAG)}, '', 'g')"))


def host_of(url: str) -> str:
    return f"lower(regexp_extract({url}, {D.q(L.HOST)}, 2))"


def remove_dot_segments(url: str) -> str:
    head = f"regexp_extract({url}, '^([^?#]*)', 1)"
    tail = f"substr({url}, length({head}) + 1)"
    auth = f"regexp_extract({head}, {D.q(L.AUTHORITY)}, 1)"
    path = f"substr({head}, length({auth}) + 1)"
    # every segment as a list of one, folded into the list of those kept
    kept = (f"list_reduce(list_transform(string_split({path}, '/')[2:], lambda s: [s]), "
            "lambda acc, x: CASE WHEN x[1] = '..' THEN acc[:greatest(len(acc) - 1, 0)] WHEN x[1] = '.' THEN acc "
            "ELSE list_concat(acc, x) END, CAST([] AS VARCHAR[]))")
    closing = f"CASE WHEN regexp_matches({path}, {D.q('/[.][.]?$')}) THEN [''] ELSE CAST([] AS VARCHAR[]) END"
    return f"({auth} || '/' || array_to_string(list_concat({kept}, {closing}), '/') || {tail})"


def absolute_url(href: str, base: str) -> str:
    origin = f"regexp_extract({base}, {D.q(L.ORIGIN)}, 1)"
    scheme = f"regexp_extract({base}, {D.q('^([A-Za-z][A-Za-z0-9+.-]*):')}, 1)"
    base_dir = (f"regexp_replace(regexp_replace({base}, {D.q('[?#].*$')}, ''), "
                f"{D.q('[^/]*$')}, '')")
    has_path = f"starts_with(regexp_replace({base}, {D.q(L.ORIGIN)}, ''), '/')"
    joined = (f"CASE WHEN starts_with({href}, '//') THEN {scheme} || ':' || {href} "
            f"WHEN starts_with({href}, '/') THEN {origin} || {href} "
            f"WHEN starts_with({href}, '?') THEN regexp_replace({base}, {D.q('[?#].*$')}, '') || {href} "
            f"WHEN starts_with({href}, '#') THEN regexp_replace({base}, {D.q('#.*$')}, '') || {href} "
            f"WHEN {has_path} THEN {base_dir} || {href} "
            f"ELSE {origin} || '/' || {href} END")
    return (f"CASE WHEN starts_with({href}, 'http') OR regexp_matches({href}, {D.q(L.SCHEME)}) THEN {href} "
            f"WHEN contains({joined}, '/.') THEN {remove_dot_segments(joined)} ELSE {joined} END")


# ------------------------------------------------------------------ pages
_title = D.clean_text(node_text(f"regexp_extract(html, {D.q(L.H1)}, 1)"))
oracle("page_listing_stats", f"""
WITH s AS (
  SELECT page_id, url, {host_of('url')} AS host, {_title} AS title,
         len(regexp_extract_all(html, {D.q(L.HREF)}, 1)) AS n_links
  FROM pages)
SELECT host,
       CAST(count(*) AS BIGINT) AS pages,
       CAST(count_if(COALESCE(title <> '', false) AND starts_with(url, 'http')) AS BIGINT) AS valid_pages,
       CAST(sum(n_links) AS BIGINT) AS links,
       CAST(max(length(title)) AS BIGINT) AS max_title_len
FROM s GROUP BY host
""")

_href = f"regexp_extract(a, {D.q(L.HREF)}, 1)"
_title_attr = f"NULLIF({D.py_strip(decode_entities(f'regexp_extract(a, {D.q(L.TITLE_ATTR)}, 1)'))}, '')"
_inner = f"NULLIF({node_text(f'regexp_extract(a, {D.q(L.ANCHOR_INNER)}, 1)')}, '')"
oracle("page_links_absolute", f"""
WITH x AS (
  SELECT page_id, url AS _base, regexp_extract_all(html, {D.q(L.ANCHOR)}, 0) AS arr FROM pages),
a AS (
  SELECT page_id, _base, unnest(arr) AS a, unnest(generate_series(1, len(arr))) AS pos FROM x)
SELECT page_id, CAST(pos AS INTEGER) AS pos,
       {absolute_url(decode_entities(_href), '_base')} AS url,
       COALESCE({_title_attr}, {_inner}) AS title
FROM a WHERE {_href} <> ''
""")

oracle("url_valid", f"""
SELECT page_id, {D.is_valid_url('url')} AS valid_url, COALESCE(starts_with(url, 'http'), false) AS is_http
FROM pages
""")

# ------------------------------------------------------------------ scalars
_clean = D.clean_text("text")
oracle("clean_text", f"""
SELECT doc_id, md5({_clean}) AS clean_md5, contains(lower({_clean}), 'contact') AS mentions_contact
FROM documents
""")

oracle("phone_masked", f"""
WITH p AS (SELECT doc_id, {D.extract_phone('text')} AS phone FROM documents)
SELECT doc_id, {D.mask_phone('phone')} AS phone_masked FROM p WHERE phone IS NOT NULL
""")

_tv = with_views("v_text")
oracle("price", _tv + f"SELECT id, {D.extract_price('price_text')} AS price FROM v_text")
oracle("area", _tv + f"SELECT id, {D.extract_area('area_text')} AS area FROM v_text")
oracle("rooms", _tv + f"SELECT id, {D.extract_rooms('rooms_text')} AS bedroom FROM v_text")
oracle("bathrooms", _tv + f"SELECT id, {D.extract_bathrooms('bath_text')} AS bathroom FROM v_text")
oracle("frontage", _tv + f"SELECT id, {D.extract_frontage('frontage_text')} AS frontage FROM v_text")
oracle("posted_date", _tv + f"""
, d AS (SELECT id, {D.posted_date('date_text', 'as_of')} AS posted_date FROM v_text)
SELECT id, posted_date, {D.format_date('posted_date')} AS posted_text FROM d""")
oracle("city", _tv + f"SELECT id, {D.extract_city('address_text')} AS city FROM v_text")
oracle("unit_price", _tv + f"""
, pa AS (SELECT id, {D.extract_price('price_text')} AS price, {D.extract_area('area_text')} AS area FROM v_text)
SELECT id, price, area, {D.unit_price('price', 'area')} AS unit_price FROM pa""")
oracle("type_class", _tv + f"SELECT id, {D.classify_type('description')} AS type FROM v_text")
oracle("legal_phrase", _tv + f"SELECT id, {D.legal_phrase('description')} AS legal FROM v_text")
oracle("amenities", _tv + f"SELECT id, {D.amenities('description')} AS amenityLocation FROM v_text")

# ------------------------------------------------------------------ frontier, joins, store
_NOW = "TIMESTAMP '2024-06-01 00:00:00'"
_REG = """
reg AS (
  SELECT s_name AS name, 'https://site' || CAST(s_suppkey AS VARCHAR) || '.example' AS base_url,
         CAST(s_nationkey % 3 + 1 AS INTEGER) AS n_urls, s_acctbal >= 0 AS enabled
  FROM supplier),
st AS (
  SELECT s_name AS name, s_suppkey % 3 <> 0 AS enabled, TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM supplier WHERE s_nationkey <= 18)"""
_URLS = _REG + """,
su AS (SELECT name, base_url, unnest(generate_series(1, n_urls)) AS i FROM reg),
su2 AS (SELECT name, base_url || '/search/' || CAST(i AS VARCHAR)
               || CASE WHEN i % 2 = 0 THEN '?sort=new' ELSE '' END AS search_url FROM su),
pg AS (SELECT name, search_url, unnest(generate_series(1, 3)) AS page FROM su2),
urls AS (
  SELECT name, search_url, CAST(page AS INTEGER) AS page, CAST(floor((page - 1) / 2) AS INTEGER) AS batch,
         CASE WHEN page = 1 THEN search_url
              ELSE search_url || CASE WHEN contains(search_url, '?') THEN '&' ELSE '?' END || 'p=' || CAST(page AS VARCHAR)
         END AS url
  FROM pg)"""

oracle("pagination_urls", "WITH " + _URLS + "\nSELECT name, search_url, page, batch, url FROM urls")
oracle("frontier_batches", "WITH " + _URLS + """
SELECT name, batch, CAST(count(*) AS BIGINT) AS n_urls, min(page) AS first_page, max(page) AS last_page
FROM urls GROUP BY name, batch""")
oracle("enabled_sites", "WITH " + _REG + """
SELECT r.name, r.base_url, r.n_urls AS n_search_urls FROM reg r JOIN st s ON r.name = s.name WHERE s.enabled""")
oracle("site_lookup", "WITH " + _REG + "\nSELECT name, enabled, updated_at FROM st WHERE name = 'Supplier#000000007'")
oracle("state_seed", "WITH " + _REG + f"""
SELECT name, enabled, updated_at FROM st
UNION ALL
SELECT r.name, COALESCE(r.enabled, true) AS enabled, {_NOW} AS updated_at
FROM reg r WHERE NOT EXISTS (SELECT 1 FROM st s WHERE s.name = r.name)""")
oracle("state_upsert", "WITH " + _REG + f""",
ch AS (SELECT s_name AS name, s_acctbal > 7500 AS enabled FROM supplier WHERE s_acctbal > 5000)
SELECT COALESCE(s.name, c.name) AS name,
       CASE WHEN c.name IS NOT NULL THEN c.enabled ELSE s.enabled END AS enabled,
       CASE WHEN c.name IS NOT NULL THEN {_NOW} ELSE s.updated_at END AS updated_at
FROM st s FULL OUTER JOIN ch c ON s.name = c.name""")
oracle("state_toggle", "WITH " + _REG + f""",
nm AS (SELECT s_name AS name FROM supplier WHERE s_nationkey IN (7, 20)
       UNION ALL SELECT 'unknown-' || s_name FROM supplier WHERE s_nationkey IN (7, 20)),
hits AS (SELECT DISTINCT name FROM nm)
SELECT s.name,
       CASE WHEN h.name IS NOT NULL THEN true ELSE s.enabled END AS enabled,
       CASE WHEN h.name IS NOT NULL THEN {_NOW} ELSE s.updated_at END AS updated_at,
       h.name IS NOT NULL AS changed
FROM st s LEFT JOIN hits h ON s.name = h.name""")

_LINKS = with_views("v_text", "v_listing") + """,
cand AS (SELECT link AS url FROM v_text UNION ALL SELECT link FROM v_text WHERE year(as_of) = 1999),
c AS (SELECT DISTINCT url FROM cand),
store AS (SELECT * FROM v_listing WHERE crawled_at < TIMESTAMP '1997-01-01 00:00:00')
"""
oracle("new_links", _LINKS + "SELECT url FROM c WHERE NOT EXISTS (SELECT 1 FROM store s WHERE s.link = c.url)")
oracle("known_links", _LINKS + "SELECT url FROM c WHERE EXISTS (SELECT 1 FROM store s WHERE s.link = c.url)")

oracle("url_page_join", """
WITH f AS (
  SELECT url AS su, unnest(generate_series(1, 2)) AS page FROM pages),
fu AS (
  SELECT CAST(page AS INTEGER) AS page,
         CASE WHEN page = 1 THEN su ELSE su || CASE WHEN contains(su, '?') THEN '&' ELSE '?' END || 'p=' || CAST(page AS VARCHAR) END AS url
  FROM f)
SELECT fu.url, fu.page, p.page_id, CAST(length(p.html) AS BIGINT) AS html_chars FROM fu JOIN pages p ON p.url = fu.url""")

_UPD = ("WITH " + ",\n".join(f"{n} AS ({duck_view_sql(n)})" for n in ("v_listing", "v_listing_updates")) + """,
upd AS (SELECT id + 100000000 AS id, link, title, price, area, bedroom, legal, source, crawled_at FROM v_listing_updates)
""")
oracle("append_unique", _UPD + """,
store AS (SELECT * FROM v_listing WHERE crawled_at < TIMESTAMP '1997-01-01 00:00:00'),
batch AS (SELECT * FROM v_listing WHERE year(crawled_at) = 1998 UNION ALL SELECT * FROM upd),
known AS (SELECT DISTINCT link FROM store),
first AS (SELECT link, min(id) AS first_id FROM batch GROUP BY link)
SELECT b.id, b.link,
       CASE WHEN k.link IS NOT NULL OR b.id <> f.first_id THEN 'duplicate' ELSE 'inserted' END AS status
FROM batch b LEFT JOIN known k ON b.link IS NOT DISTINCT FROM k.link
JOIN first f ON b.link IS NOT DISTINCT FROM f.link""")
oracle("upsert_latest", _UPD + """,
latest AS (
  SELECT link, arg_max(id, crawled_at) AS id, arg_max(title, crawled_at) AS title, arg_max(price, crawled_at) AS price,
         arg_max(area, crawled_at) AS area, arg_max(bedroom, crawled_at) AS bedroom, arg_max(legal, crawled_at) AS legal,
         arg_max(source, crawled_at) AS source, max(crawled_at) AS crawled_at
  FROM upd GROUP BY link)
SELECT s.* FROM v_listing s WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.link = s.link)
UNION ALL
SELECT COALESCE(s.id, l.id) AS id, l.link, l.title, l.price, l.area, l.bedroom, l.legal, l.source, l.crawled_at
FROM latest l LEFT JOIN v_listing s ON s.link = l.link""")

# ------------------------------------------------------------------ statistics
oracle("count_by_source", "SELECT source, CAST(count(*) AS BIGINT) AS count FROM documents GROUP BY source")
oracle("count_filtered", "SELECT CAST(count(*) AS BIGINT) AS count FROM documents WHERE source = 'src3'")
oracle("total_count", "SELECT CAST(count(*) AS BIGINT) AS count FROM documents")
oracle("union_sources", " UNION ALL ".join(
    f"SELECT doc_id, lang, source FROM documents WHERE lang = '{x}'" for x in ("en", "de", "fr", "es")))

_FEED = """
feed AS (
  SELECT event_id, ts, event_type, 'src' || CAST(user_id AS VARCHAR) AS source,
         'src' || CAST(user_id AS VARCHAR) || '/' || strftime(ts, '%Y-%m-%d') AS session_id,
         CASE event_type WHEN 'signup' THEN 'crawl_started' WHEN 'view' THEN 'property_extracted'
              WHEN 'click' THEN 'property_enriched' WHEN 'purchase' THEN 'crawl_completed'
              WHEN 'error' THEN 'crawl_failed' END AS event
  FROM events)"""
_SESS = "WITH " + _FEED + """,
g AS (
  SELECT source, session_id, min(ts) AS start_time,
         max(CASE WHEN event_type = 'purchase' THEN ts END) AS end_time,
         CAST(count_if(event_type = 'signup') AS BIGINT) AS total_pages,
         CAST(count_if(event_type = 'view') AS BIGINT) AS successful_items,
         CAST(count_if(event_type = 'error') AS BIGINT) AS failed_items,
         CAST(count_if(event_type = 'click') AS BIGINT) AS duplicate_items,
         max(CAST(event_type = 'purchase' AS INTEGER)) AS _done, 0 AS _failed
  FROM feed GROUP BY source, session_id),
sess AS (
  SELECT session_id, source, start_time, end_time, total_pages,
         successful_items + failed_items + duplicate_items AS total_items,
         successful_items, failed_items, duplicate_items,
         CASE WHEN _done = 1 THEN 'completed' WHEN _failed = 1 THEN 'failed' ELSE 'running' END AS status,
         CASE WHEN _failed = 1 THEN 'crawl failed' END AS error_message
  FROM g)
"""
oracle("session_stats", _SESS + "SELECT * FROM sess")
oracle("session_append", _SESS + "SELECT * FROM sess WHERE status = 'completed'")
oracle("recent_sessions", _SESS + """SELECT * FROM sess WHERE status = 'completed'
ORDER BY start_time DESC, source, session_id LIMIT 10""")
oracle("progress_by_source", "WITH " + _FEED + """,
f AS (
  SELECT source,
         max(CASE WHEN event = 'crawl_started' THEN ts END) AS start_time,
         max(CASE WHEN event IN ('crawl_completed', 'crawl_failed') THEN ts END) AS end_time,
         arg_max(CASE WHEN event IN ('crawl_started', 'crawl_completed', 'crawl_failed') THEN event END,
                 CASE WHEN event IN ('crawl_started', 'crawl_completed', 'crawl_failed') THEN (ts, event_id) END) AS _last,
         CAST(count_if(event = 'property_extracted') AS BIGINT) AS total_items
  FROM feed GROUP BY source),
s AS (
  SELECT feed.source,
         CAST(count_if(event = 'property_extracted' AND (f.start_time IS NULL OR feed.ts > f.start_time)) AS BIGINT)
           AS processed_items
  FROM feed JOIN f ON feed.source IS NOT DISTINCT FROM f.source GROUP BY feed.source)
SELECT f.source,
       CASE _last WHEN 'crawl_started' THEN 'running' WHEN 'crawl_completed' THEN 'completed'
                  WHEN 'crawl_failed' THEN 'failed' ELSE 'idle' END AS status,
       s.processed_items, f.total_items, f.start_time, f.end_time
FROM f JOIN s ON f.source IS NOT DISTINCT FROM s.source""")
oracle("event_counts", "WITH " + _FEED + "\nSELECT source, event, CAST(count(*) AS BIGINT) AS count FROM feed GROUP BY source, event")

# ------------------------------------------------------------------ typed listing, validation

_TYPED = with_views("v_text") + f""",
raw AS (
  SELECT id, link, description AS title, address_text AS address, description, price_text, area_text,
         rooms_text AS bedroom_text, bath_text AS bathroom_text, frontage_text, date_text,
         'site' || CAST(id % 6 AS VARCHAR) AS source, as_of AS crawled_at
  FROM v_text),
t0 AS (
  SELECT CAST(id AS VARCHAR) AS id,
         NULLIF({D.clean_text('title')}, '') AS title,
         NULLIF({D.clean_text('address')}, '') AS address,
         {D.extract_city('address')} AS city,
         CAST(NULL AS VARCHAR) AS seller, CAST(NULL AS VARCHAR) AS numberPhone,
         {D.extract_price('price_text')} AS price,
         {D.extract_area('area_text')} AS area,
         link,
         {D.posted_date('date_text', 'crawled_at')} AS postedDate,
         {D.extract_rooms('bedroom_text')} AS bedroom,
         {D.extract_bathrooms('bathroom_text')} AS bathroom,
         CAST(NULL AS VARCHAR) AS legal,
         {D.extract_frontage('frontage_text')} AS frontage,
         NULLIF({D.clean_text('description')}, '') AS description,
         CAST(NULL AS VARCHAR) AS amenityLocation, CAST(NULL AS VARCHAR) AS type,
         source, crawled_at, crawled_at AS updated_at
  FROM raw),
typed AS (SELECT *, {D.unit_price('price', 'area')} AS unit_price FROM t0)
"""
oracle("normalise_listing", _TYPED + "SELECT * FROM typed")

oracle("validate_split", with_views("v_listing") + f""",
v AS (SELECT *, {D.unit_price('price', 'area')} AS unit_price FROM v_listing),
e AS (
  SELECT id, concat_ws(',',
           CASE WHEN area < 0 THEN 'area' END, CASE WHEN unit_price < 0 THEN 'unit_price' END,
           CASE WHEN bedroom < 0 THEN 'bedroom' END,
           CASE WHEN link IS NULL OR NOT starts_with(link, 'http') THEN 'link' END) AS errors
  FROM v)
SELECT id, errors = '' AS valid, errors FROM e""")

oracle("conform_schema", with_views("v_listing") + """
SELECT sha256(link) AS id, title, CAST(NULL AS VARCHAR) AS address, CAST(NULL AS VARCHAR) AS city,
       CAST(NULL AS VARCHAR) AS seller, CAST(NULL AS VARCHAR) AS numberPhone, price, area,
       CAST(NULL AS DOUBLE) AS unit_price, link, CAST(NULL AS DATE) AS postedDate, bedroom,
       CAST(NULL AS INTEGER) AS bathroom, legal, CAST(NULL AS DOUBLE) AS frontage,
       CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS amenityLocation,
       CAST(NULL AS VARCHAR) AS type, source, crawled_at, crawled_at AS updated_at
FROM v_listing""")

# ------------------------------------------------------------------ enrichment
_STR = {"title", "address", "seller", "legal", "description", "link", "city", "amenityLocation", "type"}
_NUM = {"price", "area", "unit_price", "bedroom", "bathroom", "frontage"}


def _missing_cond(f: str) -> str:
    if f in _STR:
        return f"({f} IS NULL OR {f} = '')"
    if f in _NUM:
        return f"({f} IS NULL OR {f} = 0)"
    return f"({f} IS NULL)"


_MISSING = "concat_ws(',', " + ", ".join(f"CASE WHEN {_missing_cond(f)} THEN '{f}' END" for f in PT.ENRICH_FIELDS) + ")"
_N_MISSING = "(" + " + ".join(f"CASE WHEN {_missing_cond(f)} THEN 1 ELSE 0 END" for f in PT.ENRICH_FIELDS) + ")"

oracle("missing_fields", _TYPED + f"SELECT id, {_MISSING} AS missing, CAST({_N_MISSING} AS INTEGER) AS n_missing FROM typed")


def _fmt(f: str) -> str:
    if f in ("price", "area", "unit_price", "frontage"):
        v = f"CAST(CAST({f} AS DECIMAL(38,2)) AS VARCHAR)"
    elif f == "postedDate":
        v = f"strftime({f}, '%Y-%m-%d')"
    else:
        v = f"CAST({f} AS VARCHAR)"
    return f"'{f}: ' || COALESCE({v}, 'None')"


_BLOCK = ("concat_ws(chr(10), CAST(pos AS VARCHAR) || '. ID: ' || id, "
          + ", ".join(_fmt(f) for f in PT.ENRICH_FIELDS) + ")")
_BATCHED = _TYPED + f""",
b AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY link, id) - 1 AS rk FROM typed),
b2 AS (SELECT *, CAST(floor(rk / {PT.ENRICH_BATCH}) AS BIGINT) AS batch,
              CAST(rk % {PT.ENRICH_BATCH} + 1 AS INTEGER) AS pos, {_MISSING} AS miss FROM b),
m AS (SELECT source, batch, unnest(string_split(miss, ',')) AS f FROM b2 WHERE miss <> ''),
ma AS (SELECT source, batch, string_agg(DISTINCT f, ', ' ORDER BY f) AS missing FROM m GROUP BY source, batch),
c AS (SELECT source, batch, CAST(count(*) AS BIGINT) AS n_records, string_agg({_BLOCK}, chr(10) ORDER BY pos) AS body
      FROM b2 GROUP BY source, batch),
req AS (SELECT c.source, c.batch, c.n_records, COALESCE(ma.missing, '') AS missing, c.body
        FROM c LEFT JOIN ma ON c.source = ma.source AND c.batch = ma.batch)
"""
oracle("enrich_batches", _BATCHED + "SELECT source, batch, n_records, missing FROM req")
oracle("request_text", _BATCHED + f"""
SELECT source, batch, concat_ws(chr(10), replace({D.q(DEFAULT_TEMPLATE)}, '{{missing}}', missing), body) AS request
FROM req""")

_ITEMS = """
x AS (SELECT id, CAST(json_extract({arr}, '$[*]') AS JSON[]) AS items FROM {view}),
y AS (SELECT id, unnest(items) AS item, unnest(generate_series(1, len(items))) AS pos FROM x),
items AS (SELECT id, CAST(pos AS INTEGER) AS pos, json_extract_string(item, '$.id') AS item_id, item
          FROM y WHERE json_exists(item, '$.id'))
"""
_R1 = with_views("v_response") + "," + _ITEMS.format(arr=D.response_array("text"), view="v_response")
oracle("response_parse", _R1 + """
SELECT id, pos, item_id, json_exists(item, '$.legal') AS has_legal,
       json_extract_string(item, '$.legal') AS legal, json_extract_string(item, '$.type') AS type
FROM items""")
oracle("type_map", _R1 + f"""
, tm AS (SELECT id, json_extract_string(item, '$.type') AS type_raw FROM items)
SELECT id, type_raw, {D.map_property_type('type_raw')} AS type FROM tm""")


def _norm_value(f: str, v: str) -> str:
    if f in ("title", "address", "seller", "legal", "description", "link", "amenityLocation"):
        return D.clean_text(v)
    if f == "area":
        return D.extract_area(v)
    if f in ("price", "unit_price"):
        return D.extract_price(v)
    if f == "bedroom":
        return D.extract_rooms(v)
    if f == "bathroom":
        return D.extract_bathrooms(v)
    if f == "frontage":
        return D.extract_frontage(v)
    if f == "postedDate":
        return D.posted_date(v, "t.crawled_at")
    if f == "city":
        return D.extract_city(v)
    if f == "type":
        return D.map_property_type(v)
    raise ValueError(f)


_LISTING_COLS = ["id", "title", "address", "city", "seller", "numberPhone", "price", "area", "unit_price",
                 "link", "postedDate", "bedroom", "bathroom", "legal", "frontage", "description",
                 "amenityLocation", "type", "source", "crawled_at", "updated_at"]
_TYPES = {"price": "DOUBLE", "area": "DOUBLE", "unit_price": "DOUBLE", "frontage": "DOUBLE",
          "bedroom": "INTEGER", "bathroom": "INTEGER", "postedDate": "DATE"}


def _merged_col(f: str) -> str:
    if f not in PT.ENRICH_FIELDS:
        return f"t.{f}"
    v = f"json_extract_string(r.item, '$.{f}')"
    new = f"CAST({_norm_value(f, v)} AS {_TYPES.get(f, 'VARCHAR')})"
    return f"CASE WHEN r.item IS NOT NULL AND json_exists(r.item, '$.{f}') THEN {new} ELSE t.{f} END AS {f}"


_R2 = _TYPED.replace("WITH v_text AS", "WITH v_response_wide AS (" + duck_view_sql("v_response_wide") + "),\nv_text AS", 1)
oracle("response_merge", _R2 + "," + _ITEMS.format(arr=D.response_array("text"), view="v_response_wide") + f""",
latest AS (SELECT item_id, arg_max(item, (id, pos)) AS item FROM items GROUP BY item_id),
mg AS (
  SELECT {', '.join(_merged_col(f) for f in _LISTING_COLS)}, r.item IS NOT NULL AS enriched
  FROM typed t LEFT JOIN latest r ON t.id = r.item_id)
SELECT {', '.join(c for c in _LISTING_COLS if c != 'unit_price')}, enriched,
       CASE WHEN (unit_price IS NULL OR unit_price = 0) AND price IS NOT NULL AND price <> 0
                 AND area IS NOT NULL AND area <> 0
            THEN floor(price / area * 100 + 0.5) / 100 ELSE unit_price END AS unit_price
FROM mg""")

oracle("enrich_hook", _TYPED + f"""
SELECT id, {D.classify_type("concat_ws(' ', title, description)")} AS type,
       {D.clean_text(D.legal_phrase('description'))} AS legal,
       {D.clean_text(D.amenities('description'))} AS amenityLocation,
       true AS enriched
FROM typed""")

oracle("enrich_partial_failure", _BATCHED + f"""
SELECT id, CASE WHEN batch % 3 = 2 THEN type ELSE {D.classify_type("concat_ws(' ', title, description)")} END AS type,
       CASE WHEN batch % 3 = 2 THEN legal ELSE {D.clean_text(D.legal_phrase('description'))} END AS legal,
       CASE WHEN batch % 3 = 2 THEN amenityLocation ELSE {D.clean_text(D.amenities('description'))} END AS amenityLocation,
       batch % 3 <> 2 AS enriched
FROM b2""")
oracle("enrich_resume", _BATCHED + """
SELECT source || '/' || CAST(batch AS VARCHAR) AS batch_key, CAST(CASE WHEN batch % 3 = 2 THEN 2 ELSE 1 END AS BIGINT) AS asked,
       CAST(1 AS BIGINT) AS answered, batch % 3 = 2 AS failed_first, (SELECT count(*) FROM b2) AS listings_enriched
FROM (SELECT DISTINCT source, batch FROM b2) d""")

# ------------------------------------------------------------------ rule-driven extraction


def _inner(tag_re: str) -> str:
    return f"regexp_extract(html, {D.q('(?is)' + tag_re + '(.*?)</' + tag_re.split('[')[0].lstrip('<') + '>')}, 1)"


def _strip_join_text(frag: str) -> str:
    """get_text(strip=True): text nodes stripped and joined without separator."""
    no_tags = f"regexp_replace({frag}, {D.q(_WS + '*<[^>]*>' + _WS + '*')}, '', 'g')"
    return D.py_strip(decode_entities(no_tags))


def _page_text(html: str) -> str:
    t = f"regexp_replace({html}, {D.q('(?is)<!DOCTYPE[^>]*>')}, '', 'g')"
    t = f"regexp_replace({t}, {D.q('(?s)<!--.*?-->')}, '', 'g')"
    t = f"regexp_replace({t}, {D.q('(?is)<script[^>]*>.*?</script>')}, '', 'g')"
    t = f"regexp_replace({t}, {D.q('(?is)<style[^>]*>.*?</style>')}, '', 'g')"
    t = f"regexp_replace({t}, '<[^>]*>', '', 'g')"
    return decode_entities(t)


_H1 = f"NULLIF(regexp_extract(html, {D.q('(?is)<h1[^>]*>')} || '', 0), '')"
_h1_text = _strip_join_text(f"regexp_extract(html, {D.q(L.H1)}, 1)")
_footer = _strip_join_text(f"regexp_extract(html, {D.q('(?is)<footer[^>]*>(.*?)</footer>')}, 1)")
_ad = _strip_join_text(f"regexp_extract(html, {D.q('(?is)<div class=\"ad\">(.*?)</div>')}, 1)")
_article = _strip_join_text(f"regexp_extract(html, {D.q('(?is)<article[^>]*>(.*?)</article>')}, 1)")
oracle("page_text_rules", f"""
SELECT page_id,
       CASE WHEN regexp_matches(html, {D.q('(?is)<h1[^>]*>')}) THEN {_h1_text} END AS title,
       CASE WHEN regexp_matches(html, {D.q('(?is)<footer[^>]*>')}) THEN {_footer} END AS footer,
       CASE WHEN regexp_matches(html, {D.q('(?is)<div class="ad">')}) THEN {_ad} END AS ad_text,
       md5({_article}) AS article_md5,
       md5({_page_text('html')}) AS page_text_md5
FROM pages""")

oracle("rule_postprocess", f"""
SELECT page_id,
       CASE WHEN regexp_matches(html, {D.q('(?is)<h1[^>]*>')}) THEN NULLIF(regexp_replace({_h1_text}, '([A-Za-z])[a-z]*', '\\1', 'g'), '') END AS title,
       CASE WHEN regexp_matches(html, {D.q('(?is)<div class="ad">')}) THEN NULLIF(regexp_replace({_ad}, '[^0-9]', '', 'g'), '') END AS ad_text
FROM pages""")

oracle("zero_dropping_source", with_views("v_text") + f""",
z AS (SELECT id, CASE WHEN id % 5 = 0 THEN NULL ELSE NULLIF({D.extract_price('price_text')}, 0) END AS price,
             CASE WHEN id % 7 = 0 THEN NULL ELSE NULLIF({D.extract_area('area_text')}, 0) END AS area FROM v_text)
SELECT CAST(id AS VARCHAR) AS id, price, area, price IS NULL OR area IS NULL OR {D.unit_price('price', 'area')} IS NULL OR {D.unit_price('price', 'area')} = 0 AS no_unit_price
FROM z""")

oracle("enrichable_fields", _TYPED + "SELECT id, title, price, area, bedroom, bathroom, frontage, legal, city, type FROM typed")

oracle("rule_dispatch", f"""
WITH p AS (
  SELECT page_id, html,
         regexp_extract({host_of('url')}, {D.q('([a-z0-9-]+[.][a-z]+)$')}, 1) AS source
  FROM pages)
SELECT page_id, source, source IN ('example.com', 'example.org') AS has_rules,
       CASE WHEN source IN ('example.com', 'example.org') AND regexp_matches(html, {D.q('(?is)<h1[^>]*>')})
            THEN {_h1_text} END AS title
FROM p""")

_nav = f"regexp_extract(html, {D.q('(?is)<nav[^>]*>(.*?)</nav>')}, 1)"
oracle("page_links_rules", f"""
WITH x AS (
  SELECT page_id, url AS _base, regexp_extract_all({_nav}, {D.q('(?is)<li[^>]*>.*?</li>')}, 0) AS arr FROM pages),
li AS (SELECT page_id, _base, unnest(arr) AS li, unnest(generate_series(1, len(arr))) AS pos FROM x),
a AS (SELECT page_id, _base, pos, regexp_extract(li, {D.q(L.ANCHOR)}, 0) AS a FROM li)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) AS INTEGER) AS pos,
       {absolute_url(decode_entities(_href), '_base')} AS url,
       COALESCE({_title_attr}, {_strip_join_text(f"regexp_extract(a, {D.q(L.ANCHOR_INNER)}, 1)")}) AS title
FROM a WHERE {_href} <> ''""")

oracle("spec_map_lookup", f"""
WITH raw AS (
  SELECT p_partkey,
         CAST(p_size AS VARCHAR) || ' triệu' AS price_text,
         CASE WHEN p_partkey % 4 = 0 THEN CAST(p_size + 30 AS VARCHAR) || ' m2'
              ELSE CAST(p_partkey % 300 + 20 AS VARCHAR) || ' m²' END AS area_text,
         CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size % 5 + 1 AS VARCHAR) || ' PN'
              ELSE CAST(p_size % 4 + 1 AS VARCHAR) || ' phòng ngủ' END AS bedroom_text,
         CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size % 10 + 2 AS VARCHAR) || 'm' END AS frontage_text,
         p_brand AS legal_text
  FROM part)
SELECT p_partkey, {D.extract_price('price_text')} AS price, {D.extract_area('area_text')} AS area,
       {D.extract_rooms('bedroom_text')} AS bedroom, {D.extract_frontage('frontage_text')} AS frontage,
       {D.clean_text('legal_text')} AS legal
FROM raw""")

# ------------------------------------------------------------------ streaming
oracle("stream_ingest", f"""
WITH r AS (
  SELECT url,
         CASE WHEN regexp_matches(html, {D.q('(?is)<h1[^>]*>')}) THEN {_h1_text} END AS title_raw,
         CASE WHEN regexp_matches(html, {D.q('(?is)<div class="ad">')}) THEN {_ad} END AS address_raw,
         CASE WHEN regexp_matches(html, {D.q('(?is)<footer[^>]*>')}) THEN {_footer} END AS seller_raw,
         {_article} AS desc_raw
  FROM pages)
SELECT sha256(url) AS id, NULLIF({D.clean_text('title_raw')}, '') AS title,
       NULLIF({D.clean_text('address_raw')}, '') AS address, {D.extract_city(D.clean_text('address_raw'))} AS city,
       NULLIF({D.clean_text('seller_raw')}, '') AS seller, url AS link, 'generic' AS source,
       md5(NULLIF({D.clean_text('desc_raw')}, '')) AS description_md5
FROM r""")

oracle("stream_dedup", """
WITH l AS (SELECT 'https://listing.example/' || json_extract_string(props, '$.k') AS link,
                  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT DISTINCT link FROM l
WHERE link NOT IN (SELECT link FROM l WHERE k < 10)""")

oracle("stream_progress", "WITH " + _FEED + """
SELECT source,
       CASE arg_max(CASE WHEN event IN ('crawl_started', 'crawl_completed', 'crawl_failed') THEN event END,
                    CASE WHEN event IN ('crawl_started', 'crawl_completed', 'crawl_failed') THEN (ts, event_id) END)
            WHEN 'crawl_started' THEN 'running' WHEN 'crawl_completed' THEN 'completed'
            WHEN 'crawl_failed' THEN 'failed' ELSE 'idle' END AS status,
       max(CASE WHEN event = 'crawl_started' THEN ts END) AS start_time,
       max(CASE WHEN event IN ('crawl_completed', 'crawl_failed') THEN ts END) AS end_time,
       CAST(count_if(event = 'property_extracted') AS BIGINT) AS total_items,
       CAST(count(*) AS BIGINT) AS n_events
FROM feed GROUP BY source""")

oracle("stream_route", "WITH " + _FEED + """
SELECT 'listings' AS sink, CAST(count_if(event = 'property_enriched') AS BIGINT) AS rows FROM feed
UNION ALL SELECT 'sessions', CAST(count_if(event = 'crawl_completed') AS BIGINT) FROM feed
UNION ALL SELECT 'log', CAST(count_if(event NOT IN ('property_enriched', 'crawl_completed')) AS BIGINT) FROM feed""")

# ------------------------------------------------------------------ the full crawl
oracle("crawl_stats", f"""
WITH x AS (
  SELECT page_id, url AS _base, regexp_extract_all({_nav}, {D.q('(?is)<li[^>]*>.*?</li>')}, 0) AS arr FROM pages),
li AS (SELECT page_id, _base, unnest(arr) AS li, unnest(generate_series(1, len(arr))) AS pos FROM x),
a AS (SELECT page_id, _base, pos, regexp_extract(li, {D.q(L.ANCHOR)}, 0) AS a FROM li),
nav AS (
  SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS pos,
         {absolute_url(decode_entities(_href), '_base')} AS link
  FROM a WHERE {_href} <> ''),
cand AS (SELECT DISTINCT link FROM nav),
known AS (SELECT DISTINCT link FROM nav WHERE pos = 2),
snap AS (SELECT DISTINCT link FROM nav WHERE pos = 1),
o AS (
  SELECT c.link,
         CASE WHEN k.link IS NOT NULL THEN 'duplicate'
              WHEN s.link IS NOT NULL AND starts_with(c.link, 'http') THEN 'success'
              WHEN s.link IS NOT NULL THEN 'failed' ELSE 'not_fetched' END AS outcome
  FROM cand c LEFT JOIN known k ON c.link = k.link LEFT JOIN snap s ON c.link = s.link)
SELECT 'generic' AS source,
       (SELECT CAST(count(*) AS BIGINT) FROM pages) AS total_pages,
       CAST(count_if(outcome = 'success') AS BIGINT) AS successful_items,
       CAST(count_if(outcome = 'failed') AS BIGINT) AS failed_items,
       CAST(count_if(outcome = 'duplicate') AS BIGINT) AS duplicate_items,
       CAST(count_if(outcome = 'not_fetched') AS BIGINT) AS not_fetched_items,
       CAST(count_if(outcome IN ('success', 'failed', 'duplicate')) AS BIGINT) AS total_items,
       'completed' AS status
FROM o""")

oracle("stream_progress_fold", "WITH " + _FEED + """,
f AS (
  SELECT source,
         max(CASE WHEN event = 'crawl_started' THEN ts END) AS start_time,
         max(CASE WHEN event IN ('crawl_completed', 'crawl_failed') THEN ts END) AS end_time,
         arg_max(CASE WHEN event IN ('crawl_started', 'crawl_completed', 'crawl_failed') THEN event END,
                 CASE WHEN event IN ('crawl_started', 'crawl_completed', 'crawl_failed') THEN (ts, event_id) END) AS _last,
         CAST(count_if(event = 'property_extracted') AS BIGINT) AS total_items,
         CAST(count(*) AS BIGINT) AS n_events
  FROM feed GROUP BY source),
s AS (
  SELECT feed.source,
         CAST(count_if(event = 'property_extracted' AND (f.start_time IS NULL OR feed.ts > f.start_time)) AS BIGINT)
           AS processed_items
  FROM feed JOIN f ON feed.source = f.source GROUP BY feed.source)
SELECT f.source,
       CASE _last WHEN 'crawl_started' THEN 'running' WHEN 'crawl_completed' THEN 'completed'
                  WHEN 'crawl_failed' THEN 'failed' ELSE 'idle' END AS status,
       s.processed_items, f.total_items, f.start_time, f.end_time, f.n_events
FROM f JOIN s ON f.source = s.source""")

oracle("stream_enrich_upsert", f"""
WITH r AS (
  SELECT url,
         CASE WHEN regexp_matches(html, {D.q('(?is)<h1[^>]*>')}) THEN {_h1_text} END AS title_raw,
         {_article} AS desc_raw
  FROM pages),
t AS (
  SELECT sha256(url) AS id, url AS link, NULLIF({D.clean_text('title_raw')}, '') AS title,
         NULLIF({D.clean_text('desc_raw')}, '') AS description
  FROM r)
SELECT id, link, title, {D.classify_type("concat_ws(' ', title, description)")} AS type,
       {D.clean_text(D.legal_phrase('description'))} AS legal,
       {D.clean_text(D.amenities('description'))} AS amenityLocation, 'generic' AS source
FROM t""")

ORACLES["stream_dedup_exact"] = ORACLES["stream_dedup"]

oracle("crawl_failures", """
SELECT 'generic' AS source, 2 * count(*) AS total_pages, count(*) AS successful_items, count(*) AS failed_items,
       CAST(0 AS BIGINT) AS duplicate_items, CAST(0 AS BIGINT) AS not_fetched_items, 2 * count(*) AS total_items, 'completed' AS status
FROM pages""")

oracle("ruled_sources", """
SELECT DISTINCT regexp_extract(url, '^[a-z]+://(?:[^/]*[.])?([a-z0-9-]+[.][a-z]+)(?:[/:?#]|$)', 1) AS source FROM pages
WHERE regexp_extract(url, '^[a-z]+://(?:[^/]*[.])?([a-z0-9-]+[.][a-z]+)(?:[/:?#]|$)', 1) IN ('example.com', 'example.org')""")

ORACLES["progress_of_source"] = "SELECT * FROM (" + ORACLES["progress_by_source"] + ") p WHERE source = 'src7'"

oracle("successful_snapshots", """
SELECT page_id, CAST(length(html) AS BIGINT) AS html_chars FROM pages WHERE contains(lower(html), '<h1')""")

oracle("store_snapshot", with_views("v_listing") + """
SELECT source, count(*) AS listings, sum(price) AS price,
       (SELECT count(*) FROM (SELECT link FROM v_listing GROUP BY link HAVING count(*) > 1) d) AS duplicate_links
FROM v_listing GROUP BY source""")

ORACLES["stream_dedup_filter"] = ORACLES["stream_dedup"]

oracle("upsert_deltas", with_views("v_listing") + """
SELECT CAST(id AS BIGINT) AS id, link, CASE WHEN id % 3 = 0 THEN price + 1 ELSE price END AS price, source,
       CASE WHEN id % 3 = 0 THEN crawled_at + INTERVAL 1 DAY ELSE crawled_at END AS crawled_at
FROM v_listing""")
