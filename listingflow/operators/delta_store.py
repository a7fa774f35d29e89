"""A keyed table as a log of deltas, with compaction and a stored membership filter (SNK-3, STR-1, STR-3, JOIN-2).

* **Append.** A batch's rows, the newest per key, are written as one small segment cut by key hash; the
  table itself is not read or written.  What a batch writes follows the batch, not the table.
* **Read.** A bucket with one segment is read as it is; the others' segments are merged by an
  aggregation per key: the newest segment's row wins, with the id that the key had first.
* **Compact.** Buckets with many or large deltas alone are rewritten as one segment; a bucket that has
  grown past ``most_rows`` is split in two by the next bit of the key's hash.
* **Membership.** Beside every segment lies a sketch of its keys, a blocked Bloom filter as plain rows:
  a key sets one bit in each of four words of one block.  ``unknown`` joins candidates with their
  blocks, and only those whose four bits are set go to the exact anti join, which reads only the
  buckets they fall into.

All changes are commits of a manifest (``manifest``), so a replayed batch changes nothing and a
reader never sees half of one.  A null key is a key like any other.
"""

from __future__ import annotations

import os
import uuid
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from . import manifest as M
from .store import latest_per_key

#: Buckets of a new table are 2 ** FIRST_DEPTH; none is split beyond MOST_DEPTH bits.
FIRST_DEPTH, MOST_DEPTH = 4, 12
#: Bits of the sketch per key when a bucket is (re)written, and the words of a block.
KEY_BITS, WORDS = 12, 4
#: A bucket is rewritten when it has so many deltas, or deltas of this share of its base.
MOST_DELTAS, MOST_DELTA_SHARE = 8, 0.5
MOST_ROWS = 2_000_000
#: With more buckets than this, a segment is written by as many tasks as a shuffle has.
MANY_LEAVES = 32


class DeltaStore:
    """A table of ``schema`` under ``root``, one row per ``key``."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str = "link", id_col: str | None = "id",
                 order_cols: Sequence[str] = ("crawled_at",), depth: int = FIRST_DEPTH):
        self.spark, self.root, self.schema, self.key, self.order_cols, self.depth = spark, root, schema, key, list(order_cols), depth
        self.id_col = id_col if id_col in schema.names else None

    # ------------------------------------------------------------------ layout
    def manifest(self) -> dict:
        m = M.read_manifest(self.spark, self.root)
        # leaves: number -> [depth, low bits of the hash, blocks of its sketch]; segments: per leaf, oldest first
        m.setdefault("leaves", {str(i): [self.depth, i, 1] for i in range(1 << self.depth)})
        m.setdefault("segments", {})
        m.setdefault("next", 0)
        return m

    def _leaf(self, m: dict):
        """The leaf of a row: its hash's low bits looked up in a directory of at most 2 ** MOST_DEPTH entries."""
        most = max(d for d, _, _ in m["leaves"].values())
        directory = [0] * (1 << most)
        for leaf, (d, low, _) in m["leaves"].items():
            for i in range(low, 1 << most, 1 << d):
                directory[i] = int(leaf)
        at = F.pmod(F.xxhash64(self.key), F.lit(1 << most)) + 1
        return F.element_at(F.expr("array(" + ",".join(map(str, directory)) + ")"), at.cast("int"))

    def _blocks(self, m: dict):
        blocks = [1] * (1 + max(map(int, m["leaves"])))
        for leaf, (_, _, n) in m["leaves"].items():
            blocks[int(leaf)] = n
        return F.element_at(F.expr("array(" + ",".join(map(str, blocks)) + ")"), F.col("bucket") + 1)

    def _masks(self):
        return [F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{self.key}`, {i}), 64) AS int))") for i in range(WORDS)]

    def _with_place(self, rows: DataFrame, m: dict) -> DataFrame:
        """``bucket`` and ``block`` of each row's key."""
        return rows.withColumn("bucket", self._leaf(m)).withColumn("block", F.pmod(F.xxhash64(self.key, F.lit("block")), self._blocks(m)))

    def _paths(self, m: dict, kind: str, leaves: Iterable[str]) -> list[str]:
        return [os.path.join(self.root, kind, s["name"], f"bucket={leaf}") for leaf in leaves for s in m["segments"].get(leaf, [])]

    # ------------------------------------------------------------------ writing
    def _dealt(self, rows: DataFrame, m: dict) -> DataFrame:
        """The rows of a bucket together.  Few buckets are dealt by their size; of many, the files cost more
        than the bytes, so their writing is spread over all tasks however little they hold."""
        if len(m["leaves"]) <= MANY_LEAVES:
            return rows.hint("rebalance", F.col("bucket"))
        return rows.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), "bucket")

    def _write_segment(self, rows: DataFrame, m: dict, name: str) -> dict[str, dict]:
        """Write rows (with ``_seq``) and their sketch; what was written per leaf."""
        data, sketch = os.path.join(self.root, "data", name), os.path.join(self.root, "sketch", name)
        self._dealt(rows.withColumn("bucket", self._leaf(m)), m).write.partitionBy("bucket").parquet(data)
        sizes = {n[7:]: b for n, b in M.child_sizes(self.spark, data).items() if n.startswith("bucket=")}
        if not sizes:
            return {}
        keys = self.spark.read.schema(T.StructType([self.schema[self.key], T.StructField("bucket", T.IntegerType())])).parquet(data)
        counts = {str(r["bucket"]): r["count"] for r in keys.groupBy("bucket").count().collect()}    # one row per leaf
        for leaf, n in counts.items():
            if not m["segments"].get(leaf):                              # a first segment settles the sketch's size
                m["leaves"][leaf] = [*m["leaves"][leaf][:2], max(1, -(-2 * n * KEY_BITS // (64 * WORDS)))]
        words = self._with_place(keys.select(self.key), m).groupBy("bucket", "block").agg(*[F.bit_or(mask).alias(f"w{i}") for i, mask in enumerate(self._masks())])
        self._dealt(words, m).withColumn("leaf", F.col("bucket")).write.partitionBy("bucket").parquet(sketch)
        return {leaf: {"name": name, "bytes": b, "rows": counts[leaf]} for leaf, b in sizes.items()}

    def append(self, updates: DataFrame, job: str, batch_id: int) -> bool:
        """SNK-3: upsert a batch by appending it; False if the batch was applied before."""
        m = self.manifest()
        if M.applied(m, job, batch_id):
            return False
        rows = updates.select(*self.schema.names)
        rows = latest_per_key(rows, self.key, self.order_cols) if len(self.schema) > 1 else rows.distinct()
        rows = rows.withColumn("_seq", F.lit(m["next"]).cast("long"))
        for leaf, segment in self._write_segment(rows, m, f"delta-{m['next']:08d}-{uuid.uuid4().hex[:8]}").items():
            m["segments"].setdefault(leaf, []).append(segment)
        m["next"] += 1
        m["applied"][job] = batch_id
        M.commit(self.spark, self.root, m)
        return True

    def compact(self, most_deltas: int = MOST_DELTAS, most_share: float = MOST_DELTA_SHARE, most_rows: int = MOST_ROWS) -> list[int]:
        """Rewrite the buckets whose deltas are many or large, split those with too many rows; the old leaves' numbers."""
        m = self.manifest()
        fat = []
        for leaf, segments in m["segments"].items():
            deltas = [s for s in segments if s["name"].startswith("delta-")]
            base = sum(s["bytes"] for s in segments if s not in deltas)
            if len(deltas) >= most_deltas or (deltas and sum(s["bytes"] for s in deltas) >= most_share * max(base, 1) and len(segments) > 1):
                fat.append(leaf)
        if not fat:
            return []
        new = {**m, "leaves": dict(m["leaves"]), "segments": {k: v for k, v in m["segments"].items() if k not in fat}}
        for leaf in fat:
            depth, low, _ = m["leaves"][leaf]
            rows = sum(s["rows"] for s in m["segments"][leaf])          # at least as many as there are keys
            halves = [(leaf, depth, low)]
            while rows > most_rows * len(halves) and halves[0][1] < MOST_DEPTH:
                halves = [h for n, d, b in halves for h in ((n, d + 1, b), (None, d + 1, b + (1 << d)))]
            for number, d, b in halves:
                number = number or str(1 + max(map(int, new["leaves"])))
                new["leaves"][number] = [d, b, 1]
        merged = self._merged(self._scan(m, fat))
        for leaf, segment in self._write_segment(merged, new, f"base-{m['next']:08d}-{uuid.uuid4().hex[:8]}").items():
            new["segments"][leaf] = [segment]
        new["next"] += 1
        M.commit(self.spark, self.root, new)
        return sorted(map(int, fat))

    # ------------------------------------------------------------------ reading
    def _scan(self, m: dict, leaves: Iterable[str], columns: Sequence[str] | None = None) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("_seq", T.LongType())])
        paths = self._paths(m, "data", leaves)
        df = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return df.select(*columns) if columns else df

    def _merged(self, rows: DataFrame) -> DataFrame:
        """The newest row per key, with the key's first id."""
        others = [c for c in rows.columns if c != self.key]
        first = [F.min_by(self.id_col, "_seq").alias("_id")] if self.id_col else []
        g = rows.groupBy(self.key).agg(F.max_by(F.struct(*others), "_seq").alias("_r"), *first)
        return g.select(*[F.col("_id").alias(c) if first and c == self.id_col else F.col(self.key) if c == self.key else F.col("_r." + c).alias(c) for c in rows.columns])

    def read(self, leaves: Iterable[int] | None = None) -> DataFrame:
        """The table, or some of its buckets."""
        m = self.manifest()
        wanted = [k for k in m["segments"] if leaves is None or int(k) in set(leaves)]
        single = [k for k in wanted if len(m["segments"][k]) == 1]
        several = [k for k in wanted if k not in set(single)]
        out = self._scan(m, single)
        if several:
            out = out.unionByName(self._merged(self._scan(m, several)))
        return out.select(*self.schema.names)

    # ------------------------------------------------------------------ membership
    def candidates(self, keys: DataFrame) -> DataFrame:
        """Distinct keys with their ``bucket`` and whether the sketches say that they may be stored; staged."""
        m = self.manifest()
        placed = self._with_place(keys.select(self.key).distinct(), m).persist()
        touched = [str(r["bucket"]) for r in placed.select("bucket").distinct().collect()]          # at most one row per leaf
        words = [f"w{i}" for i in range(WORDS)]
        schema = T.StructType([T.StructField("block", T.LongType()), *[T.StructField(w, T.LongType()) for w in words], T.StructField("leaf", T.IntegerType())])
        paths = self._paths(m, "sketch", touched)
        sketch = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        sketch = sketch.groupBy(F.col("leaf").alias("_leaf"), F.col("block").alias("_block")).agg(*[F.bit_or(w).alias(w) for w in words])
        there = F.lit(True)
        for w, mask in zip(words, self._masks()):
            there = there & (F.col(w).bitwiseAND(mask) == mask)
        try:
            return stage(placed.join(sketch, (F.col("bucket") == F.col("_leaf")) & (F.col("block") == F.col("_block")), "left")
                         .select(self.key, "bucket", F.coalesce(there, F.lit(False)).alias("possible")), "possible")
        finally:
            placed.unpersist()

    def unknown(self, keys: DataFrame) -> DataFrame:
        """JOIN-2/STR-3: the distinct keys that are not stored, exactly.  Only the buckets into which a
        possible hit falls are read, and only their key column."""
        found = self.candidates(keys)
        hit = [str(r["bucket"]) for r in found.filter("possible").select("bucket").distinct().collect()]
        out = found.filter("not possible").select(self.key)
        if not hit:
            return out
        stored = self._scan(self.manifest(), hit, [self.key]).withColumnRenamed(self.key, "_known")
        return out.unionByName(found.filter("possible").join(stored, F.col(self.key).eqNullSafe(F.col("_known")), "left_anti").select(self.key))
