"""Derived listing views over the given tables.

Each view is SQL text with ``{orders}``-style placeholders, built only from integers and
literals, so the very same text runs in Spark (``spark.sql(text, orders=df)``) and in DuckDB
(``text.format(orders="orders")``).  They grow with ``orders``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import read_table

# Noisy listing text: price, area, rooms, baths, frontage, address, date and description
V_TEXT = """
SELECT o_orderkey AS id,
  concat('https://listing.example/', cast(o_orderkey AS string)) AS link,
  CASE o_orderkey % 8
    WHEN 0 THEN concat(cast(o_orderkey % 20 + 1 AS string), ' tỷ ', cast(o_orderkey % 900 + 50 AS string), ' triệu')
    WHEN 1 THEN concat(cast(o_orderkey % 9 + 1 AS string), ',', cast(o_orderkey % 7 + 1 AS string), ' Tỷ')
    WHEN 2 THEN concat(cast(o_orderkey % 90 + 10 AS string), ' tr/tháng')
    WHEN 3 THEN concat(cast(o_orderkey % 900 + 100 AS string), 'k')
    WHEN 4 THEN 'Thỏa thuận'
    WHEN 5 THEN cast(o_orderkey * 1000000 AS string)
    WHEN 6 THEN concat(cast(o_orderkey % 80 + 20 AS string), ' TRIỆU/m²')
    ELSE NULL END AS price_text,
  CASE o_orderkey % 4
    WHEN 0 THEN concat(cast(o_orderkey % 300 + 20 AS string), ' m²')
    WHEN 1 THEN concat(cast(o_orderkey % 90 + 20 AS string), ',5m2')
    WHEN 2 THEN concat(cast(o_orderkey % 50 + 20 AS string), ' mét vuông')
    ELSE '' END AS area_text,
  CASE o_orderkey % 5
    WHEN 0 THEN concat(cast(o_orderkey % 6 + 1 AS string), ' phòng ngủ')
    WHEN 1 THEN concat(cast(o_orderkey % 6 + 1 AS string), 'PN')
    WHEN 2 THEN concat(cast(o_orderkey % 6 + 1 AS string), ' bedroom')
    WHEN 3 THEN cast(o_orderkey % 6 AS string)
    ELSE 'không rõ' END AS rooms_text,
  CASE o_orderkey % 4
    WHEN 0 THEN concat(cast(o_orderkey % 4 + 1 AS string), ' WC')
    WHEN 1 THEN concat(cast(o_orderkey % 4 + 1 AS string), ' phòng tắm')
    WHEN 2 THEN concat(cast(o_orderkey % 4 + 1 AS string), ' toilet')
    ELSE NULL END AS bath_text,
  CASE o_orderkey % 4
    WHEN 0 THEN concat('mặt tiền ', cast(o_orderkey % 15 + 3 AS string), 'm')
    WHEN 1 THEN concat(cast(o_orderkey % 15 + 3 AS string), ',5')
    WHEN 2 THEN concat(cast(o_orderkey % 15 + 3 AS string), 'm2')
    ELSE NULL END AS frontage_text,
  CASE o_orderkey % 6
    WHEN 0 THEN 'Quận 1, TP. Hồ Chí Minh'
    WHEN 1 THEN 'Cầu Giấy, Thành phố Hà Nội'
    WHEN 2 THEN 'Thủ Đức, TPHCM'
    WHEN 3 THEN 'Dĩ An, Tỉnh Bình Dương'
    WHEN 4 THEN 'Da Nang'
    ELSE '' END AS address_text,
  CASE o_orderkey % 6
    WHEN 0 THEN concat(cast(o_orderkey % 31 + 1 AS string), '/', cast(o_orderkey % 12 + 1 AS string), '/2024')
    WHEN 1 THEN concat('2024-', cast(o_orderkey % 12 + 1 AS string), '-', cast(o_orderkey % 28 + 1 AS string))
    WHEN 2 THEN 'Hôm qua'
    WHEN 3 THEN concat(cast(o_orderkey % 40 + 1 AS string), ' ngày trước')
    WHEN 4 THEN '2 tuần trước'
    ELSE NULL END AS date_text,
  CASE o_orderkey % 5
    WHEN 0 THEN 'Bán chung cư cao cấp gần trường học, có sổ hồng'
    WHEN 1 THEN 'Villa sân vườn gần công viên và bệnh viện'
    WHEN 2 THEN 'Lô đất thổ cư, sổ đỏ chính chủ'
    WHEN 3 THEN 'Cho thuê kho bãi'
    ELSE 'Tin rao' END AS description,
  o_orderdate AS as_of
FROM {orders}
"""

# Typed records with injected faults (bad link scheme, null title, negative area/bedroom)
V_LISTING = """
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 37 = 0 THEN concat('ftp://listing.example/', cast(o_orderkey AS string))
       ELSE concat('https://listing.example/', cast(o_orderkey AS string)) END AS link,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE concat('Tin ', cast(o_orderkey AS string)) END AS title,
  cast(o_orderkey % 5000 * 1000000 AS double) AS price,
  cast(CASE WHEN o_orderkey % 41 = 0 THEN -1 ELSE o_orderkey % 200 END AS double) AS area,
  cast(CASE WHEN o_orderkey % 43 = 0 THEN -2 ELSE o_orderkey % 6 END AS int) AS bedroom,
  CASE WHEN o_orderkey % 3 = 0 THEN 'sổ đỏ' WHEN o_orderkey % 3 = 1 THEN '' ELSE NULL END AS legal,
  concat('site', cast(o_custkey % 6 AS string)) AS source,
  o_orderdate AS crawled_at
FROM {orders}
"""

# Model replies: fenced JSON with a key present, present-null and absent
V_RESPONSE = """
SELECT o_orderkey AS id,
  concat('```json', chr(10), '[{{"id":"', cast(o_orderkey AS string), '"',
    CASE o_orderkey % 3 WHEN 0 THEN ',"legal":"sổ hồng"' WHEN 1 THEN ',"legal":null' ELSE '' END,
    ',"type":"', CASE o_orderkey % 3 WHEN 0 THEN 'Căn hộ' WHEN 1 THEN 'nhà' ELSE 'khác' END, '"}}]',
    chr(10), '```') AS text
FROM {orders}
"""

# Wider model replies: more fields, numbers, nulls and text around the fenced array; every
# seventh reply carries no JSON array at all (the enricher failed), so its listing passes through
V_RESPONSE_WIDE = """
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 7 = 0 THEN 'Xin lỗi, không có dữ liệu.'
  ELSE concat('Kết quả:', chr(10), '```json', chr(10), '[{{"id":"', cast(o_orderkey AS string), '"',
    CASE o_orderkey % 4
      WHEN 0 THEN ',"price":"2,5 tỷ","area":"80 m2"'
      WHEN 1 THEN ',"price":null,"area":75,"unit_price":0'
      WHEN 2 THEN ',"bedroom":"3 PN","bathroom":2,"frontage":"5,5m"'
      ELSE ',"postedDate":"12/05/2024","city":"Quận 3, TP.HCM","title":"  Nhà  đẹp ★ "' END,
    CASE o_orderkey % 3 WHEN 0 THEN ',"legal":"sổ hồng"' WHEN 1 THEN ',"legal":null' ELSE '' END,
    ',"type":"', CASE o_orderkey % 3 WHEN 0 THEN 'Căn hộ' WHEN 1 THEN 'nhà' ELSE 'khác' END, '"}}]',
    chr(10), '```') END AS text
FROM {orders}
"""

# Re-crawl copies for upsert tests: listings first crawled from 2000 on, again one day later
# with price + 1
V_LISTING_UPDATES = """
SELECT id, link, title, price + 1 AS price, area, bedroom, legal, source,
       crawled_at + INTERVAL 1 DAY AS crawled_at
FROM ({listing}) l
WHERE year(crawled_at) >= 2000
"""

VIEWS = {"v_text": V_TEXT, "v_listing": V_LISTING, "v_response": V_RESPONSE,
         "v_response_wide": V_RESPONSE_WIDE}


def text_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"], spread_out=True)
    return spark.sql(V_TEXT, orders=orders)


def listing_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return spark.sql(V_LISTING, orders=orders)


def listing_updates_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(V_LISTING_UPDATES, listing=listing_view(spark, sf_dir))


def response_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey"])
    return spark.sql(V_RESPONSE, orders=orders)


def response_wide_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey"], spread_out=True)
    return spark.sql(V_RESPONSE_WIDE, orders=orders)


def duck_view_sql(name: str) -> str:
    """The same view text for DuckDB, reading the pre-registered table names."""
    if name == "v_listing_updates":
        return V_LISTING_UPDATES.format(listing=V_LISTING.format(orders="orders"))
    return VIEWS[name].format(orders="orders")
