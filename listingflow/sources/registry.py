"""Site registry (SRC-1) and website state (FIXTURES §1 shapes).

The registry is configuration: a small table with one row per site.  ``default_registry``
holds the six sites the reference ships with; ``registry_from_suppliers`` derives a registry
from the given ``supplier`` table so tests and benchmarks scale with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTRY_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("base_url", T.StringType(), False),
    T.StructField("search_urls", T.ArrayType(T.StringType()), False),
    T.StructField("login", T.BooleanType(), True),
    T.StructField("login_url", T.StringType(), True),
    T.StructField("enabled", T.BooleanType(), True),
    T.StructField("delay", T.IntegerType(), True),
])

STATE_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("enabled", T.BooleanType(), True),
    T.StructField("updated_at", T.TimestampNTZType(), True),
])

# The reference's site registry (name, base URL, search URLs, login flag).
DEFAULT_SITES = [
    ("batdongsan.com.vn", "https://batdongsan.com.vn",
     ["https://batdongsan.com.vn/nha-dat-ban", "https://batdongsan.com.vn/nha-dat-cho-thue"], True),
    ("nhatot.com", "https://www.nhatot.com/",
     ["https://www.nhatot.com/mua-ban-bat-dong-san", "https://www.nhatot.com/thue-bat-dong-san"], True),
    ("muaban.net", "https://muaban.net/",
     ["https://muaban.net/bat-dong-san/ban-nha-dat-chung-cu", "https://muaban.net/bat-dong-san/cho-thue-nha-dat"], True),
    ("bds123.vn", "https://bds123.vn/", ["https://bds123.vn/ban-nha.html"], False),
    ("sosanhnha.com", "https://sosanhnha.com/",
     ["https://sosanhnha.com/nh%C3%A0-%C4%91%E1%BA%A5t-b%C3%A1n",
      "https://sosanhnha.com/nh%C3%A0-%C4%91%E1%BA%A5t-cho-thu%C3%AA"], False),
    ("mogi.vn", "https://mogi.vn/", ["https://mogi.vn/mua-nha-dat", "https://mogi.vn/thue-nha-dat"], False),
]


def default_registry(spark: SparkSession, delay: int = 2) -> DataFrame:
    rows = [(n, b, s, lg, None, True, delay) for n, b, s, lg in DEFAULT_SITES]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def registry_from_suppliers(supplier: DataFrame) -> DataFrame:
    """A registry with one site per supplier: 1-3 search URLs, every second one with a query."""
    base = F.concat(F.lit("https://site"), F.col("s_suppkey").cast("string"), F.lit(".example"))
    n_urls = (F.col("s_nationkey") % 3 + 1).cast("int")
    urls = F.transform(
        F.sequence(F.lit(1), F.col("_n")),
        lambda i: F.concat(F.col("_base"), F.lit("/search/"), i.cast("string"),
                           F.when(i % 2 == 0, F.lit("?sort=new")).otherwise(F.lit(""))))
    return (supplier
            .select(F.col("s_name").alias("name"), base.alias("_base"), n_urls.alias("_n"),
                    F.col("s_suppkey"), F.col("s_acctbal"))
            .select("name", F.col("_base").alias("base_url"), urls.alias("search_urls"),
                    (F.col("s_suppkey") % 2 == 0).alias("login"),
                    F.lit(None).cast("string").alias("login_url"),
                    (F.col("s_acctbal") >= 0).alias("enabled"),
                    F.lit(2).alias("delay")))


def state_from_suppliers(supplier: DataFrame) -> DataFrame:  # needs s_suppkey, s_name, s_nationkey
    """Stored website state for suppliers of nations 0-18 (the others are new sites)."""
    return (supplier.filter(F.col("s_nationkey") <= 18)
            .select(F.col("s_name").alias("name"),
                    (F.col("s_suppkey") % 3 != 0).alias("enabled"),
                    F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at")))
