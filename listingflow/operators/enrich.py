"""Batch enrichment: missing fields, batches, request text, reply parsing, merge, hook.

ENR-1…7, AGG-5, AGG-8, WIN-2, FLT-5.  The model call of the reference becomes a pluggable
``mapInPandas`` function (ENR-7); everything around it is native Spark:

    listing ─missing_fields─► batch_ids (skew-safe) ─request_text─► enricher (mapInPandas)
            ─parse_replies─► latest reply per id ─merge_replies (left join)─► enriched listing
"""

from __future__ import annotations

import json
from typing import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import patterns as P
from ..functions import text as X
from ..session import ship_package
from .batching import batch_ids
from .listing import split_methods

DEFAULT_TEMPLATE = (
    "Fill in the missing fields of each listing below from its description.\n"
    "Missing fields: {missing}\n"
    "Rules:\n"
    "- price and unit_price in VND, area and frontage in metres, bedroom and bathroom as numbers\n"
    "- type is one of: " + ", ".join(P.PROPERTY_TYPES) + "\n"
    "- postedDate as dd/mm/yyyy; a field that the text does not give stays null\n"
    "- leave fields that are not missing as they are\n"
    "Reply with a JSON array of objects with an \"id\".")


def _is_missing(df: DataFrame, name: str) -> Column:
    """FLT-5: a field is missing when null, empty or zero (the reference's falsy test)."""
    if name not in df.columns:
        return F.lit(True)
    typ = df.schema[name].dataType
    c = F.col(name)
    if isinstance(typ, T.StringType):
        return c.isNull() | (c == "")
    if isinstance(typ, T.NumericType):
        return c.isNull() | (c == 0)
    return c.isNull()


def missing_fields(df: DataFrame, fields: Sequence[str] = P.ENRICH_FIELDS) -> Column:
    """ENR-1: the record's missing field names, in field order."""
    return F.array_compact(F.array(*[F.when(_is_missing(df, f), F.lit(f)) for f in fields]))


def with_batches(df: DataFrame, group: str = "source", order: Sequence[str] = ("link", "id"),
                 size: int = P.ENRICH_BATCH, row_key: str | None = None) -> DataFrame:
    """WIN-2/ENR-2: batches of ``size`` records per ``group`` (skew-safe ranking; with
    ``row_key`` only the keys are numbered, for inputs that are cheap to read again)."""
    return batch_ids(df, group, list(order), size, row_key=row_key)


def _fmt(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit("None")
    typ = df.schema[name].dataType
    c = F.col(name)
    if isinstance(typ, (T.DoubleType, T.FloatType)):
        s = F.coalesce(c.try_cast("decimal(38,2)").cast("string"), c.cast("string"))
    elif isinstance(typ, T.DateType):
        s = F.date_format(c, "yyyy-MM-dd")
    else:
        s = c.cast("string")
    return F.coalesce(s, F.lit("None"))


def record_block(df: DataFrame, fields: Sequence[str] = P.ENRICH_FIELDS) -> Column:
    """One record of the request: ``N. ID: id`` then ``field: value`` lines."""
    lines = [F.concat(F.col("pos").cast("string"), F.lit(". ID: "), F.col("id").cast("string"))]
    lines += [F.concat(F.lit(f + ": "), _fmt(df, f)) for f in fields]
    return F.concat_ws("\n", *lines)


def batch_requests(batched: DataFrame, group: str = "source", template: str = DEFAULT_TEMPLATE,
                   fields: Sequence[str] = P.ENRICH_FIELDS) -> DataFrame:
    """ENR-3 + AGG-5: one request per batch: ``(group, batch, n_records, missing, request)``.

    Groups hold at most one batch (``size`` rows), so the collect is bounded."""
    rec = batched.select(group, "batch", "pos",
                         record_block(batched, fields).alias("_block"),
                         missing_fields(batched, fields).alias("_missing"))
    g = rec.groupBy(group, "batch").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_missing")))).alias("_miss"),
        F.array_sort(F.collect_list(F.struct("pos", "_block"))).alias("_blocks"))
    missing = F.array_join("_miss", ", ")
    head = F.replace(F.lit(template), F.lit("{missing}"), missing)
    body = F.array_join(F.col("_blocks._block"), "\n")
    return g.select(group, "batch", "n_records", missing.alias("missing"),
                    F.concat_ws("\n", head, body).alias("request"))


# ------------------------------------------------------------------ replies (SCL-12, ENR-4, AGG-8)
REPLY_ITEMS = T.ArrayType(T.MapType(T.StringType(), T.StringType()))


def parse_replies(replies: DataFrame, text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Reply text → one row per JSON object: ``(*keep, pos, item_id, item)``; objects without
    an ``id`` are dropped, unparseable replies give no rows (pass-through, ENR-6)."""
    arr = F.from_json(X.response_array(F.col(text_col)), REPLY_ITEMS)
    ex = replies.select(*keep, F.posexplode_outer(arr).alias("pos", "item"))
    return (ex.filter(F.col("item").isNotNull() & F.map_contains_key("item", "id"))
            .select(*keep, (F.col("pos") + 1).alias("pos"),
                    F.element_at("item", F.lit("id")).alias("item_id"), "item"))


# Per-field normalisation of reply values (the reference's update rules), as
# (key expression on the raw value, final expression on the key).
def _IDENT(v):
    return F.col(v) if isinstance(v, str) else v


def _value_rule(field: str):
    if field in ("title", "address", "seller", "legal", "description", "link", "amenityLocation"):
        return X.clean_text, _IDENT
    if field == "area":
        return X.price_key, X.area_from_key
    if field in ("price", "unit_price"):
        return X.price_key, X.price_from_key
    if field == "bedroom":
        return X.lower_key, X.rooms_from_key
    if field == "bathroom":
        return X.lower_key, X.bathrooms_from_key
    if field == "frontage":
        return X.frontage_key, X.frontage_from_key
    if field == "postedDate":
        return X.date_key, None              # a date, not text (fixes Q8); needs as_of
    if field == "city":
        return X.city_key, X.city_from_key
    if field == "type":
        return X.map_property_type, _IDENT
    raise ValueError(field)


def _values(listing: DataFrame, cols):
    out = []
    for c in cols:
        k = "_k_" + c
        if c == "postedDate":
            out += [X.date_abs_key(k).alias("_va_" + c), X.date_rel_key(k).alias("_vr_" + c)]
        else:
            out.append(_value_rule(c)[1](k).cast(listing.schema[c].dataType).alias("_v_" + c))
    return out


def merge_reply_items(listing: DataFrame, items: DataFrame, order: Sequence[str] = (), as_of: str = "crawled_at",
                      fields: Sequence[str] = P.ENRICH_FIELDS) -> DataFrame:
    """ENR-5/6 + JOIN-4 + AGG-8 on parsed reply objects ``(item_id, *order, item)``.

    The last object per id wins (``max_by`` over ``order``, combined map-side).  Its values alone
    are then normalised, on the reply side and in methods small enough for the JVM to compile
    (``split_methods``), so the listing side only evaluates a cheap CASE per field after the left
    join.  A present key replaces the
    field (a JSON null clears it), an absent key keeps it, the unit price is recomputed when
    still empty, and ``enriched`` marks replied rows.  Row-wise: one bad value cannot abort a
    batch (fixes Q10).  A relative posted date is applied to the listing's ``as_of``."""
    merge_cols = [c for c in listing.columns if c in fields]
    m = F.col("item")
    ordering = F.struct(*[F.col(c) for c in order]) if order else F.struct(F.lit(0))
    latest = (items.select("item_id", ordering.alias("_ord"), "item").groupBy("item_id")
              .agg(F.max_by("item", "_ord").alias("item")))
    flags = ["_p_" + c for c in merge_cols]
    # a split column in both projections keeps them out of the whole stage's one method
    keyed = latest.select(
        F.col("item_id").alias("_rid"),
        *[split_methods(F.map_contains_key(m, c)).alias("_p_" + c) for c in merge_cols[:1]],
        *[F.map_contains_key(m, c).alias("_p_" + c) for c in merge_cols[1:]],
        *[_value_rule(c)[0](F.element_at(m, F.lit(c))).alias("_k_" + c) for c in merge_cols])
    typed = keyed.select("_rid", *[split_methods(F.col(f)).alias(f) for f in flags[:1]], *flags[1:], *_values(listing, merge_cols))
    j = listing.join(typed, F.col("id").cast("string") == F.col("_rid"), "left")
    out = []
    for c in listing.columns:
        if c in merge_cols:
            if c == "postedDate":
                new = F.to_date(X.apply_date_parts(F.col("_va_" + c), F.col("_vr_" + c), F.col(as_of)))
            else:
                new = F.col("_v_" + c)
            out.append(F.when(F.col("_p_" + c), new).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    merged = j.select(*out, F.col("_rid").isNotNull().alias("enriched"))
    if {"unit_price", "price", "area"} <= set(listing.columns):
        up, p, a = F.col("unit_price"), F.col("price"), F.col("area")
        recompute = ((up.isNull() | (up == 0)) & p.isNotNull() & (p != 0) & a.isNotNull() & (a != 0))
        merged = merged.withColumn("unit_price",
                                   F.when(recompute, X.round_cents(p / a)).otherwise(up))
    return merged


def merge_replies(listing: DataFrame, replies: DataFrame, as_of: str = "crawled_at",
                  fields: Sequence[str] = P.ENRICH_FIELDS) -> DataFrame:
    """ENR-5: merge replies that are already one per id ``(item_id, item)``."""
    return merge_reply_items(listing, replies.select("item_id", "item"), (), as_of, fields)


# ------------------------------------------------------------------ enricher hook (ENR-7, UDF-5)
GUARDED_SCHEMA = "batch_hash string, batch_key string, text string, error string"

Enricher = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def whole_frames(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same rows in frames that hold whole batches: the last batch of a frame, which the next
    frame may continue, is carried over."""
    carry = None
    for pdf in frames:
        pdf = pdf if carry is None else pd.concat([carry, pdf], ignore_index=True)
        if not len(pdf):
            continue
        keys = pdf["batch_key"].to_numpy()
        last = keys == keys[-1]
        first = 0 if last.all() else len(pdf) - int(last[::-1].argmin())
        if first:
            yield pdf.iloc[:first].reset_index(drop=True)
        carry = pdf.iloc[first:] if first else pdf
    if carry is not None:
        fresh = type(carry.index) is pd.RangeIndex and (carry.index.start, carry.index.step) == (0, 1)
        yield carry if fresh else carry.reset_index(drop=True)


def batch_parts(pdf: pd.DataFrame) -> Iterator[tuple]:
    """``(batch_key, rows)`` of the batches of a frame whose batches' rows follow each other."""
    keys = pdf["batch_key"].to_numpy()
    cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield keys[a], pdf if b - a == len(keys) else pdf.iloc[a:b]


def guarded(enricher: Enricher) -> Enricher:
    """ENR-6: ``enricher`` made safe per batch.  Frames of whole batches go to it; if it raises,
    the replies it has given are kept and the frame's other batches are handed over one by one,
    and a batch that raises again yields its error in place of a reply.  No batch ends the job."""
    def fn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_frames(frames):
            hashes = dict(zip(pdf["batch_key"], pdf["batch_hash"]))
            pdf = pdf.drop(columns="batch_hash")
            keys, texts, errors = [], [], []       # one frame of replies per frame: a frame costs more than its rows

            def keep(outs):
                for out in outs:
                    keys.extend(out["batch_key"])
                    texts.extend(out["text"])
                errors.extend([None] * (len(keys) - len(errors)))

            try:
                for out in enricher(iter([pdf])):
                    keep([out])
            except Exception:
                done = set(keys)
                for key, part in batch_parts(pdf):
                    if key in done:
                        continue
                    try:
                        keep(list(enricher(iter([part.reset_index(drop=True)]))))
                    except Exception as e:
                        keys.append(key)
                        texts.append(None)
                        errors.append(f"{type(e).__name__}: {e}"[:500])
            if keys:
                yield pd.DataFrame({"batch_hash": [hashes.get(k) for k in keys], "batch_key": keys, "text": texts, "error": errors}, dtype=object)

    return fn


def batch_records(batched: DataFrame, group: str = "source", request_cols: Sequence[str] = ("title", "description"),
                  fields: Sequence[str] = P.ENRICH_FIELDS) -> DataFrame:
    """ENR-3 for an enricher of records: one row per batch, ``(batch_key, batch_hash,
    batch_missing, records)``.  ``batch_missing`` holds the names that any record of the batch lacks,
    in field order; ``batch_hash`` identifies what is asked, so an unchanged batch has the same one in
    every run.  Groups hold at most one batch, so the collect is bounded."""
    rows = batched.select(group, "batch", F.struct(
        "pos", F.col("id").cast("string").alias("id"), missing_fields(batched, fields).alias("missing"),
        *[F.col(c).cast("string").alias(c) for c in request_cols]).alias("r"))
    g = rows.groupBy(group, "batch").agg(F.sort_array(F.collect_list("r")).alias("records"))
    joint = F.array_distinct(F.flatten(F.col("records.missing")))
    key = F.concat_ws("/", F.col(group), F.col("batch").cast("string"))
    return g.select(key.alias("batch_key"), F.sha2(F.to_json(F.struct(F.col(group).alias("group"), "records")), 256).alias("batch_hash"),
                    F.array_intersect(F.array(*[F.lit(f) for f in fields]), joint).alias("batch_missing"), "records")


def ask(requests: DataFrame, enricher: Enricher) -> DataFrame:
    """One guarded reply or error per batch of ``batch_records``: ``(batch_hash, batch_key, text, error)``.

    The enricher sees rows ``batch_key, batch_missing, id, missing`` and the request columns; a
    batch's rows follow each other, so they stay whole (``whole_batches``)."""
    ship_package(requests.sparkSession)
    names = [f for f in requests.schema["records"].dataType.elementType.names if f not in ("pos", "missing")]
    rows = requests.select("batch_hash", "batch_key", F.array_join("batch_missing", ",").alias("batch_missing"), F.explode("records").alias("r"))
    frames = rows.select("batch_hash", "batch_key", "batch_missing", F.array_join("r.missing", ",").alias("missing"), *[F.col("r." + n).alias(n) for n in names])
    return frames.mapInPandas(guarded(enricher), GUARDED_SCHEMA)


def enrich(listing: DataFrame, enricher: Enricher, group: str = "source",
           size: int = P.ENRICH_BATCH, as_of: str = "crawled_at",
           request_cols: Sequence[str] = ("title", "description"), row_key: str | None = None) -> DataFrame:
    """Run ``enricher`` over batches of records, then merge its replies.

    ``enricher`` is a ``mapInPandas`` function: it receives pandas frames with columns
    ``batch_key, id, missing, batch_missing`` and ``request_cols`` and yields ``(batch_key, text)``
    replies whose text holds a JSON array of objects with ``id``.  Every record is sent with the names
    of its own missing fields and with those that its batch lacks together; an enricher answers only
    what is missing.  A batch for which it raises passes through (``guarded``); ``reply_log`` keeps
    replies over runs.
    """
    batched = batch_ids(listing, group, ["link", "id"], size, row_key=row_key)   # checkpointed once
    base = batched.select(*listing.columns)                       # the merge reuses those rows
    replies = ask(batch_records(batched, group, request_cols), enricher)
    items = parse_replies(replies, "text", keep=["batch_key"])
    return merge_reply_items(base, items, ["batch_key", "pos"], as_of)


REQUEST_ENRICHER_SCHEMA = "batch_key string, text string"


def enrich_requests(listing: DataFrame, enricher: Enricher, group: str = "source", size: int = P.ENRICH_BATCH,
                    template: str = DEFAULT_TEMPLATE, as_of: str = "crawled_at",
                    row_key: str | None = None) -> DataFrame:
    """ENR-3 → ENR-7 as the reference does it: one request text per batch of ``size`` records
    (``batch_requests``), handed to ``enricher`` — a ``mapInPandas`` function over
    ``(batch_key, request)`` rows that yields ``(batch_key, text)`` replies (e.g. a model call) —
    then the replies are parsed and merged.  Each request row is one bounded batch."""
    batched = batch_ids(listing, group, ["link", "id"], size, row_key=row_key)
    base = batched.select(*listing.columns)
    req = batch_requests(batched, group, template).select(
        F.concat_ws("/", F.col(group), F.col("batch").cast("string")).alias("batch_key"), "request")
    replies = req.mapInPandas(enricher, REQUEST_ENRICHER_SCHEMA)
    items = parse_replies(replies, "text", keep=["batch_key"])
    return merge_reply_items(base, items, ["batch_key", "pos"], as_of)


def whole_batches(frames: Iterator[pd.DataFrame], size: int) -> Iterator[tuple]:
    """``(batch_key, rows)`` of whole batches from frames sorted by ``batch_key``: the open batch is
    carried from frame to frame, so it is cut where its key changes, where it is full and at the
    end of the input (STR-2), never where a frame happens to end."""
    key, rows = None, []
    for pdf in frames:
        names = pdf.columns.tolist()
        for values in pdf.to_numpy(dtype=object).tolist():        # to_dict costs a small frame ten times as much
            row = dict(zip(names, values))
            if rows and (row["batch_key"] != key or len(rows) >= size):
                yield key, rows
                rows = []
            key = row["batch_key"]
            rows.append(row)
    if rows:
        yield key, rows


def reply_frame(keys: list, texts: list) -> pd.DataFrame:
    """``(batch_key, text)`` rows: one block of objects, which costs a frame of a few rows far less than two columns."""
    block = np.empty((len(keys), 2), dtype=object)
    block[:, 0], block[:, 1] = keys, texts
    return pd.DataFrame(block, columns=["batch_key", "text"], dtype=object)


def rule_based_enricher(batch_size: int = P.ENRICH_BATCH) -> Enricher:
    """A deterministic enricher with no network: property type from keywords (ENR-8), legal
    phrase (ENR-9) and amenity phrases (ENR-10), asked only for the missing fields."""
    import re

    legal_re = re.compile("(" + "|".join(P.LEGAL_PHRASES) + ")", re.IGNORECASE)
    amen_res = [re.compile(p, re.IGNORECASE) for p in P.AMENITY_PHRASES]

    def classify(text: str):
        low = text.lower()
        for typ, words in P.TYPE_KEYWORDS:
            if any(w in low for w in words):
                return typ
        return None

    def answer(row) -> dict:
        missing = set((row["missing"] or "").split(","))
        desc = row.get("description") or ""
        text = " ".join(x for x in (row.get("title"), desc) if x)
        out = {"id": row["id"]}
        if "type" in missing:
            out["type"] = classify(text)
        if "legal" in missing:
            m = legal_re.search(desc)
            out["legal"] = m.group(1) if m else None
        if "amenityLocation" in missing:
            found = [m.group(0) for r in amen_res for m in [r.search(desc)] if m]
            out["amenityLocation"] = ", ".join(found) if found else None
        return out

    def fn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, texts = [], []
        for key, rows in whole_batches(frames, batch_size):
            keys.append(key)
            texts.append("```json\n" + json.dumps([answer(r) for r in rows], ensure_ascii=False) + "\n```")
            if len(keys) == 500:
                yield reply_frame(keys, texts)
                keys, texts = [], []
        yield reply_frame(keys, texts)

    return fn
