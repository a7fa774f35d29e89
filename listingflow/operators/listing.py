"""Raw fields → typed listing, validation split, schema conformance (PRJ-11…18, FLT-1/3/5/6).

``normalise`` is a short chain of projections of native expressions: the whole typing step is
one whole-stage-codegen stage with no shuffle and no Python.
"""

from __future__ import annotations

import logging
from typing import Dict, Iterable, Tuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X

log = logging.getLogger(__name__)

LISTING_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("address", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("seller", T.StringType(), True),
    T.StructField("numberPhone", T.StringType(), True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("area", T.DoubleType(), True),
    T.StructField("unit_price", T.DoubleType(), True),
    T.StructField("link", T.StringType(), True),
    T.StructField("postedDate", T.DateType(), True),
    T.StructField("bedroom", T.IntegerType(), True),
    T.StructField("bathroom", T.IntegerType(), True),
    T.StructField("legal", T.StringType(), True),
    T.StructField("frontage", T.DoubleType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("amenityLocation", T.StringType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("crawled_at", T.TimestampNTZType(), True),
    T.StructField("updated_at", T.TimestampNTZType(), True),
])
LISTING_COLUMNS = [f.name for f in LISTING_SCHEMA.fields]

# Raw (string) field names produced by the HTML extraction step.
RAW_FIELDS = ["title", "address", "seller", "description", "price_text", "area_text", "bedroom_text",
              "bathroom_text", "frontage_text", "legal_text", "date_text", "phone_text", "link",
              "source", "crawled_at"]

# Known misspelt field names mapped onto the model (fixes Q1).
FIELD_ALIASES = {"numberphone": "numberPhone", "_id": "id"}


def listing_id(link) -> Column:
    """PRJ-11: deterministic surrogate id from the natural key (stable under task retry)."""
    c = F.col(link) if isinstance(link, str) else link
    return F.sha2(c, 256)


def _col_or_null(df: DataFrame, name: str, typ: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(typ)


def successful(snapshots: DataFrame) -> DataFrame:
    """FLT-1: keep successfully fetched snapshots (all of them when there is no flag)."""
    return snapshots.filter(F.col("success")) if "success" in snapshots.columns else snapshots


def zero_as_null(df: DataFrame, cols=("price", "area", "unit_price", "frontage")) -> DataFrame:
    """PRJ-13: the falsy → null coercion some sites apply (``value if value else None``)."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in cols if c in df.columns})


#: PRJ-13: sources whose listings read a zero as "not given".
ZERO_AS_NULL_SOURCES = ("bds123.vn",)


def split_methods(c: Column) -> Column:
    """``c`` unchanged, from an expression without generated code of its own.

    A projection that holds one is left out of whole-stage code generation: its other expressions
    are generated as many small methods, which the JVM compiles.  Inside a whole stage they make up
    one method of tens of kilobytes, and the JVM interprets methods beyond 8,000 bytes."""
    return F.element_at(F.transform(F.array(c), lambda x: x), 1)


def normalise(raw: DataFrame, keep_phone: bool = False, keep: Tuple[str, ...] = ()) -> DataFrame:
    """PRJ-6 output → typed listing (SCL-1…9, PRJ-12…15).  ``crawled_at`` is the ``as_of``
    for relative dates.  Empty strings become null, as in the reference's field assignment.

    Four projections: per-field keys (lower-cased / cleaned text), the keys that are made of
    these, then the typed fields from the keys, then the unit price.  Each key is read by many
    expressions of the next step, so Catalyst keeps the steps apart, and a key is made once a row.
    ``keep`` names further columns to carry through.
    """
    g = lambda n: _col_or_null(raw, n)
    keys = raw.select(
        (F.col("id").cast("string") if "id" in raw.columns else listing_id(F.col("link"))).alias("id"),
        split_methods(F.col("link").cast("string")).alias("link"),
        F.col("source").cast("string").alias("source"),
        _col_or_null(raw, "crawled_at", "timestamp_ntz").alias("crawled_at"),
        *[F.nullif(X.clean_text(g(c)), F.lit("")).alias(c)
          for c in ("title", "address", "seller", "description", "legal_text")],
        X.price_key(g("price_text")).alias("_price"),
        X.price_key(g("area_text")).alias("_area"),
        X.lower_key(g("bedroom_text")).alias("_rooms"),
        X.lower_key(g("bathroom_text")).alias("_baths"),
        X.frontage_key(g("frontage_text")).alias("_front"),
        X.date_key(g("date_text")).alias("_date"),
        (X.extract_phone(g("phone_text")) if keep_phone else F.lit(None).cast("string")).alias("numberPhone"),
        *keep,
    )
    keys = keys.select(
        "id", split_methods(F.col("link")).alias("link"), "source", "crawled_at", "title", "address", "seller", "description", "legal_text",
        X.city_key("address").alias("_city"), F.lower(X.city_key("address")).alias("_city_low"),
        "_price", X.price_sum_key("_price").alias("_price_sum"),
        "_area", "_rooms", "_baths", "_front", "_date", "numberPhone", *keep,
    )
    typed = keys.select(
        "id", "title", "address",
        X.city_from_key("_city", "_city_low").alias("city"),
        "seller", "numberPhone",
        X.price_from_key("_price", "_price_sum").alias("price"),
        X.area_from_key("_area").alias("area"),
        split_methods(F.col("link")).alias("link"),
        X.posted_date_key("_date", "crawled_at").alias("postedDate"),
        X.rooms_from_key("_rooms").alias("bedroom"),
        X.bathrooms_from_key("_baths").alias("bathroom"),
        F.col("legal_text").alias("legal"),
        X.frontage_from_key("_front").alias("frontage"),
        "description",
        F.lit(None).cast("string").alias("amenityLocation"),
        F.lit(None).cast("string").alias("type"),
        "source", "crawled_at",
        F.col("crawled_at").alias("updated_at"),
        *keep,
    )
    typed = typed.withColumn("unit_price", X.unit_price("price", "area"))
    drops_zero = F.coalesce(F.col("source").isin(*ZERO_AS_NULL_SOURCES), F.lit(False))
    return (typed.withColumns({c: F.when(drops_zero, F.nullif(F.col(c), F.lit(0.0))).otherwise(F.col(c))
                               for c in ("price", "area", "unit_price", "frontage")})
            .select(*LISTING_COLUMNS, *keep))


# ------------------------------------------------------------------ validation (FLT-3)
def validation_errors(df: DataFrame) -> Column:
    """FLT-3: names of failed rules (nulls pass, except for ``link``)."""
    def neg(c):
        return F.when(F.col(c) < 0, F.lit(c)) if c in df.columns else F.lit(None).cast("string")
    link_bad = F.when(F.col("link").isNull() | ~F.col("link").startswith("http"), F.lit("link"))
    return F.array_compact(F.array(neg("area"), neg("unit_price"), neg("bedroom"), neg("bathroom"), link_bad))


def with_errors(df: DataFrame) -> DataFrame:
    return df.withColumn("errors", validation_errors(df))


def split_valid(df: DataFrame) -> Tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``; ``valid + rejected = input``.  Both come from one projection;
    cache or checkpoint the input if both halves are written from an expensive lineage."""
    e = with_errors(df)
    return (e.filter(F.size("errors") == 0).drop("errors"), e.filter(F.size("errors") > 0))


# ------------------------------------------------------------------ conformance (PRJ-17/18)
def conform(df: DataFrame, schema: T.StructType = LISTING_SCHEMA,
            aliases: Dict[str, str] = FIELD_ALIASES) -> DataFrame:
    """Select/cast ``df`` to ``schema``: known aliases renamed, missing columns null, unknown
    columns dropped and logged (the reference drops them silently, Q1)."""
    renamed = df
    for src, dst in aliases.items():
        if src in renamed.columns and dst not in renamed.columns:
            renamed = renamed.withColumnRenamed(src, dst)
    wanted = {f.name for f in schema.fields}
    dropped = [c for c in renamed.columns if c not in wanted]
    if dropped:
        log.warning("conform: dropping columns not in schema: %s", dropped)
    return renamed.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in renamed.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def project(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """PRJ-17: the enrichable fields plus id."""
    return df.select("id", *fields)
