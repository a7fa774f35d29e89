"""Sharding with a hierarchical weighted hash tree: region, rack, shard.

A document descends the tree; on each level the child with the smallest weighted hash draw wins.
A shard's draw is ``-ln(u) / weight`` with ``u`` hashed from the document id and the shard's name
(an exponential race, so a shard wins in proportion to its weight); a rack's draw is the smallest
of its shards', a region's the smallest of its racks'.  A node's draw thus depends on its own
subtree alone: changing one weight leaves all other draws as they are, and documents move only
into the subtree that gained or out of the one that lost.  With the law ``key``, id and shard
count alone decide, and one more shard takes documents only into itself.

Slots count from 0 without gaps in each shard: tasks number their own documents per shard, and
prefix sums over the (task, shard) counts, at most tasks x shards rows, give each task its first
slot.  No shard's rows ever meet in one task.

Edge cases: a null text has size 8 and the checksum of the empty text; all null ids hash alike
and share a shard; repeated rows each get a slot; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import binaries, mix, partition_id, stage, table, U64

SHARDS = 24
RACK_SHARDS, REGION_RACKS = 4, 3


class ShardTree:
    """Shards named by number, ``RACK_SHARDS`` to a rack and ``REGION_RACKS`` racks to a region."""

    def __init__(self, weights: list[float], rack_shards: int = RACK_SHARDS, region_racks: int = REGION_RACKS):
        self.weights = np.asarray(weights, np.float64)
        shards = len(weights)
        self.racks = np.arange(0, shards, rack_shards)
        self.regions = np.arange(0, len(self.racks), region_racks)
        self.salts = np.array([xxhash.xxh3_64_intdigest(f"shard-{s}".encode()) for s in range(shards)], U64)

    def place(self, keys: np.ndarray) -> np.ndarray:
        """Shard of each 64-bit key."""
        if not len(keys):
            return np.empty(0, np.int32)
        u = (mix(keys[:, None] ^ self.salts[None, :]) >> U64(11)).astype(np.float64) + 0.5
        shard_draws = -np.log(u / 2.0 ** 53) / self.weights
        rack_draws = np.minimum.reduceat(shard_draws, self.racks, axis=1)
        region_draws = np.minimum.reduceat(rack_draws, self.regions, axis=1)
        region = region_draws.argmin(axis=1)
        rack = descend(rack_draws, self.regions, region)
        return descend(shard_draws, self.racks, rack).astype(np.int32)


def descend(draws: np.ndarray, begins: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """The child with the smallest draw among the children of each row's parent."""
    ends = np.append(begins[1:], draws.shape[1])
    child = np.arange(draws.shape[1])
    inside = (child >= begins[parent][:, None]) & (child < ends[parent][:, None])
    return np.where(inside, draws, np.inf).argmin(axis=1)


def keys_of(ids: list) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(b"" if i is None else str(i).encode()) for i in ids], U64)


def assign(weights: list[float]):
    """Task function: documents -> shard, and number among the task's documents of that shard."""
    def run(batches):
        tree, grown = ShardTree(weights), ShardTree([*weights, 1.0])
        taken = np.zeros(len(weights), np.int64)
        for batch in batches:
            texts = [t or b"" for t in binaries(batch.column("text"))]
            keys = keys_of(batch.column("doc_id").to_pylist())
            shard = tree.place(keys)
            order = np.argsort(shard, kind="stable")
            counts = np.bincount(shard, minlength=len(weights))
            number = np.empty(len(shard), np.int64)
            number[order] = np.arange(len(shard)) - np.repeat([0, *accumulate(counts[:-1])], counts) + np.repeat(taken, counts)
            taken += counts
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(t) + 8 for t in texts], pa.int64()),
                pa.array([zlib.crc32(t) for t in texts], pa.int64()), pa.array(shard), pa.array(grown.place(keys)),
                pa.array(number), pa.array([partition_id()] * len(texts), pa.int64()),
            ], names=["doc_id", "size", "text_crc32", "shard", "grown_shard", "number", "task"])
    return run


def shard_documents(docs: DataFrame, weights: list[float] | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard and slot of every document under the law ``key``; one row per input row.

    ``grown_shard`` is the shard once one more shard of weight 1 has joined.
    """
    weights = weights or [1.0] * SHARDS
    docs = docs.select(docs[id].alias("doc_id"), docs[text].alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    placed = stage(docs.mapInArrow(assign(weights), f"doc_id {kind}, size long, text_crc32 long, shard int, grown_shard int, "
                                                    "number long, task long"), "sharding")
    counts = placed.groupBy("task", "shard").agg(F.count("*").alias("n"))
    first = counts.select("task", "shard", (F.sum("n").over(Window.partitionBy("shard").orderBy("task")) - F.col("n")).alias("first"))
    first = stage(first, "sharding-first")  # its size is known when the join is planned
    return (placed.join(first, ["task", "shard"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("first") + F.col("number")).alias("slot"), "grown_shard"))


def query(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))
