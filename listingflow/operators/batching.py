"""Skew-safe dense ranking within a group, used to cut records into batches (WIN-2).

``row_number() over (partition by source order by link)`` sends every row of a source to one
task: with one source holding a third of all rows that task holds a third of the data.  Here
the rank is computed without any per-group shuffle:

1. ``repartitionByRange(group, order..., tie)`` splits a hot group across many partitions
   (range bounds are sampled over the full key, not the group alone);
2. inside each partition the rows are sorted and numbered (``monotonically_increasing_id``
   offsets within a partition are the row positions);
3. a tiny table of per-(partition, group) counts – at most partitions + groups rows – gives
   each partition's starting offset per group by a window over that small table;
4. the offsets are written and joined back (their files' size tells the planner whether to
   broadcast them, so that few offsets move no row, and many are joined by a shuffle).

The input is persisted while the range shuffle samples and reads it (sampling is a job of its
own), then released; a ``stored`` input is read twice instead.  Steps 3 and 4 read the numbered rows twice.  Two reads of a
range shuffle are not guaranteed to agree (each exchange samples its own bounds), so the numbered
rows are written once as Parquet under the shared folder named by ``spark.checkpoint.dir`` and all
reads use that copy, each of the columns that it needs (rows that Parquet cannot hold go to a
reliable ``checkpoint()`` there).  This also cuts the lineage, so a lost executor does not
recompute the sort.

The result equals ``row_number() - 1`` over ``(group order by order_cols, tie_cols)``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, stage, storable


def rank_within(df: DataFrame, group: str, order_cols: Sequence[str], out: str = "rank",
                num_partitions: int | None = None, row_key: str | None = None, stored: bool = False) -> DataFrame:
    """``row_number() - 1`` over ``(group order by order_cols)`` without a per-group shuffle.

    With ``row_key`` (a unique column; use it when ``df`` is cheap to read again, e.g. a stored
    table) only ``group``, ``order_cols`` and the key are numbered and checkpointed, and the
    ranks are joined back on the key — a join on a unique key, so no hot partition.  A ``stored``
    ``df`` is read again where it is needed and not kept in memory."""
    if row_key is not None:
        cols = list(dict.fromkeys([group, *order_cols, row_key]))
        ranks = rank_within(df.select(*cols), group, order_cols, out, num_partitions, stored=stored)
        return df.join(ranks.select(F.col(row_key).alias("_rk"), out), F.col(row_key) == F.col("_rk"),
                       "inner").drop("_rk")
    keys = [group, *order_cols]
    # An explicit partition count: AQE never coalesces it, so both reads of this shuffle
    # (counts and rows) see the same partition ids.
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # range partitioning samples its input in a separate job: keep the input for the shuffle
    src = df if stored else df.persist(StorageLevel.MEMORY_AND_DISK)
    parts = src.repartitionByRange(n, *keys)
    numbered = (parts.sortWithinPartitions(*keys)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    # row position inside the partition: mono id minus the partition's base (pid << 33)
    numbered = numbered.withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
    if storable(numbered):
        numbered = stage(numbered, "numbered")
    else:
        ensure_checkpoint_dir(df.sparkSession)
        numbered = numbered.checkpoint(eager=True)
    if not stored:
        src.unpersist()
    counts = (numbered.groupBy("_pid", group)
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first")))
    w = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    o = offsets.select(F.col("_pid").alias("_opid"), F.col(group).alias("_ogroup"), "_first", "_before")
    o = stage(o, "offsets") if storable(o) else o
    # null-safe on the group: rows whose group is null are numbered too, never dropped
    ranked = numbered.join(o, (F.col("_pid") == F.col("_opid")) & F.col(group).eqNullSafe(F.col("_ogroup")), "inner")
    return (ranked.withColumn(out, F.col("_before") + F.col("_pos") - F.col("_first"))
            .drop("_pid", "_mid", "_pos", "_first", "_before", "_opid", "_ogroup"))


def batch_ids(df: DataFrame, group: str, order_cols: Sequence[str], size: int, out: str = "batch",
              pos_out: str = "pos", row_key: str | None = None, stored: bool = False) -> DataFrame:
    """WIN-2: ``batch = rank // size`` and 1-based ``pos`` inside the batch, per ``group``."""
    r = rank_within(df, group, order_cols, "_rank", row_key=row_key, stored=stored)
    return (r.withColumn(out, F.floor(F.col("_rank") / F.lit(size)).cast("bigint"))
            .withColumn(pos_out, (F.col("_rank") % F.lit(size) + 1).cast("int"))
            .drop("_rank"))
