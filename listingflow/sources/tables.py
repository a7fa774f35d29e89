"""Readers for the given parquet tables (SRC-2, SRC-3, SRC-4).

Readers always name the columns they need so the parquet scan prunes the rest
(``ReadSchema`` in the plan); filters applied after a read are pushed to the scan by Catalyst.
"""

from __future__ import annotations

import os
from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Iterable[str] | None = None, where: Column | str | None = None,
               spread_out: bool = False) -> DataFrame:
    """SRC-3: scan a table; ``columns`` prunes, ``where`` is pushed down to parquet.
    ``spread_out`` is for CPU-heavy consumers (regex typing, HTML parsing): see ``spread``."""
    df = spark.read.parquet(table_path(sf_dir, name))
    if where is not None:
        df = df.filter(where)
    if columns:
        df = df.select(*columns)
    return spread(df) if spread_out else df


#: A scan of at most so many bytes (as the optimiser estimates it) is spread over more tasks.
SPREAD_BYTES = 64 << 20
SPREAD_TASKS = 16


def spread(df: DataFrame, tasks: int = SPREAD_TASKS) -> DataFrame:
    """Give a CPU-heavy stage over a small table enough tasks: one small file is one split, and a
    regex-heavy projection would run on one core.  Only scans of at most ``SPREAD_BYTES`` are
    spread round-robin; anything larger keeps its splits whatever the cluster's size, so at
    scale no row moves."""
    small = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= SPREAD_BYTES
    return df.repartition(tasks) if small else df


def register_tables(spark: SparkSession, sf_dir: str, names: Iterable[str] = TABLES,
                    prefix: str = "") -> list:
    """SRC-4: named-table access through session temp views (``spark.table(prefix + name)``)."""
    out = []
    for name in names:
        spark.read.parquet(table_path(sf_dir, name)).createOrReplaceTempView(prefix + name)
        out.append(prefix + name)
    return out


def named_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC-4: the reference's ``get_collection(name)``."""
    return spark.table(name)


def read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2: stored page snapshots ``(page_id, url, html)``; everything counts as fetched.
    Parsing is CPU-bound, so the scan is spread over enough tasks (no-op on split inputs)."""
    return read_table(spark, sf_dir, "pages", ["page_id", "url", "html"], spread_out=True)
