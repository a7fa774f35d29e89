"""Mixture-controlled packing: deficit round-robin over source queues.

Every source is a queue of its documents' tokens.  A window (a sequence of 4096 tokens) takes
from each queue what its target share and the deficit carried from all earlier windows allow;
a queue that runs dry leaves the round and the rest share its part.  With integer weights the
amount queue ``j`` has given after ``t`` tokens is

    floor(W_j * t / W) - floor(W_{j-1} * t / W)        (W_j: weights of the queues up to j)

which sums to ``t`` exactly and differs from its target by less than one token: the deficit.
So any window's deficits follow from its number alone, and tasks cut their documents without
waiting for each other: deficits carry across windows and partitions in closed form.

Jobs: (1) tokenise and write ids with each document's position in its queue inside the task;
(2) sum tokens per task and queue, prefix sums give each task's first position per queue;
(3) cut every document where the schedule changes window.  Ids are written once, never shuffled
(unless the prefix sums are too many to broadcast, which Spark checks).

The last window, of r < 4096 tokens, becomes sequences whose lengths are the powers of two that
sum to r, so nothing is padded.

Edge cases: a null text is empty and gives its end token; null sources are one queue; repeated
rows are packed each; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_blocks, partition_id, stage, table
from .tokens import encoder

SEQUENCE_TOKENS = 4096
END_ID = 2


class Schedule:
    """Who gives which token: the deficit round-robin over ``totals`` tokens per queue.

    ``weights`` are the target shares (integers); by default each queue's own tokens, so that all
    queues run dry together and every window shows the proportions of the whole corpus.
    """

    def __init__(self, totals: list[int], weights: list[int] | None = None, size: int = SEQUENCE_TOKENS):
        weights = list(weights or totals)
        self.size, self.tokens = size, sum(totals)
        self.begins: list[int] = []
        self.phases: list[tuple[list[int], int, list[int], list[int]]] = []
        left, served, at = list(totals), [0] * len(totals), 0
        while any(left):
            # a queue without a target share waits until those with one are dry
            active = [w if n else 0 for w, n in zip(weights, left)]
            if not any(active):
                active = [1 if n else 0 for n in left]
            upto = list(accumulate(active, initial=0))
            whole = upto[-1]
            steps = min(n * whole // w for n, w in zip(left, active) if w)
            self.begins.append(at)
            self.phases.append((upto, whole, list(served), list(accumulate(served, initial=0))))
            for j in range(len(left)):
                given = upto[j + 1] * steps // whole - upto[j] * steps // whole
                left[j] -= given
                served[j] += given
            at += steps
        self.windows = -(-self.tokens // size)

    def served(self, queue: int, t: int) -> int:
        """Tokens the queue has given once ``t`` tokens are placed."""
        k = bisect_right(self.begins, t) - 1
        upto, whole, base, _ = self.phases[k]
        x = t - self.begins[k]
        return base[queue] + upto[queue + 1] * x // whole - upto[queue] * x // whole

    def before(self, queue: int, t: int) -> int:
        """Tokens all earlier queues have given once ``t`` tokens are placed."""
        k = bisect_right(self.begins, t) - 1
        upto, whole, _, base = self.phases[k]
        return base[queue] + upto[queue] * (t - self.begins[k]) // whole

    def deficit(self, queue: int, t: int) -> float:
        """What the queue's target is ahead of what it has given in the current phase."""
        k = bisect_right(self.begins, t) - 1
        upto, whole, base, _ = self.phases[k]
        return (upto[queue + 1] - upto[queue]) * (t - self.begins[k]) / whole - (self.served(queue, t) - base[queue])

    def pieces(self, queue: int, first: int, n: int):
        """Yield ``(start, length, sequence, offset)`` for tokens ``first .. first+n-1`` of a queue."""
        size, end = self.size, first + n
        window = bisect_right(range(self.windows), first, key=lambda w: self.served(queue, min(self.tokens, (w + 1) * size)))
        at = first
        while at < end:
            t = window * size
            until = min(end, self.served(queue, min(self.tokens, t + size)))
            if until > at:
                offset = self.before(queue, min(self.tokens, t + size)) - self.before(queue, t) + at - self.served(queue, t)
                if t + size <= self.tokens:
                    yield at - first, until - at, window, offset
                else:
                    yield from self._last(at - first, until - at, window, offset)
                at = until
            window += 1

    def _last(self, start: int, length: int, window: int, offset: int):
        rest = self.tokens - window * self.size
        begin = 0
        for k in reversed(range(rest.bit_length())):
            if rest >> k & 1:
                end = begin + (1 << k)
                a, b = max(offset, begin), min(offset + length, end)
                if a < b:
                    yield start + a - offset, b - a, window, a - begin
                window, begin = window + 1, end


def tokenise(path: str, end_id: int):
    """Task function: documents -> ids with the document's position in its queue in this task."""
    def run(batches):
        queued: dict = {}
        for rows, texts in in_blocks(batches, "text"):
            ids, lengths = encoder(path).encode(texts)
            ends = np.cumsum(lengths)
            ids = np.insert(ids, ends, end_id)
            width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
            raw = ids.astype(f"<u{width}").tobytes()
            bounds = ((ends + np.arange(1, len(ends) + 1)) * width).tolist()
            sources = rows.column("source").to_pylist()
            positions = []
            for source, n in zip(sources, lengths.tolist()):
                positions.append(queued.get(source, 0))
                queued[source] = positions[-1] + n + 1
            for i in range(0, len(texts), 2000):
                part = slice(i, i + 2000)
                yield pa.RecordBatch.from_arrays([
                    pa.array([partition_id()] * len(texts[part]), pa.int64()), pa.array(sources[part], pa.string()),
                    pa.concat_arrays(rows.column("doc_id").slice(i, 2000).chunks), pa.array(positions[part], pa.int64()),
                    pa.array(lengths[part] + 1), pa.array([width] * len(texts[part]), pa.int32()),
                    pa.array([raw[a:b] for a, b in zip([0, *bounds][part], bounds[part])], pa.binary()),
                ], names=["task", "source", "doc_id", "position", "doc_tokens", "width", "ids"])
    return run


def cut(shared):
    """Task function: placed documents -> pieces."""
    def run(batches):
        schedule = shared.value
        for batch in batches:
            rows, values = [], [[], [], [], [], []]
            starts, lengths, crcs, sequences, offsets = values
            columns = (batch.column(c).to_pylist() for c in ("queue", "first", "doc_tokens", "width", "ids"))
            for i, (queue, first, n, width, raw) in enumerate(zip(*columns)):
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
                for start, length, sequence, offset in schedule.pieces(queue, first, n):
                    rows.append(i)
                    starts.append(start)
                    lengths.append(length)
                    crcs.append(zlib.crc32(ids[start:start + length]))
                    sequences.append(sequence)
                    offsets.append(offset)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), *(pa.array(v, pa.int64()) for v in values[:3]),
                 batch.column("doc_tokens").take(take), *(pa.array(v, pa.int64()) for v in values[3:]),
                 batch.column("source").take(take)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])
    return run


def pack(docs: DataFrame, path: str, weights: dict | None = None, size: int = SEQUENCE_TOKENS, end_id: int = END_ID,
         id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Pack all documents into sequences of ``size`` tokens with ``weights`` (source -> integer
    target share; by default the sources' own token counts) in every sequence.

    Returns one row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source``.
    """
    docs = docs.select(docs[id].alias("doc_id"), docs[text].alias("text"), docs[source].cast("string").alias("source"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    tokens = stage(docs.mapInArrow(tokenise(path, end_id), "task long, source string, "
                                   f"doc_id {kind}, position long, doc_tokens long, width int, ids binary"), "packing-ids")
    sums = tokens.groupBy("task", "source").agg(F.sum("doc_tokens").alias("n"))
    own = {r["source"]: r["n"] for r in sums.groupBy("source").agg(F.sum("n").alias("n")).collect()}  # a row per source
    names = sorted(own, key=lambda s: (s is None, s))
    schedule = Schedule([own[s] for s in names], weights and [int(weights.get(s, 0)) for s in names], size)
    queues = tokens.sparkSession.createDataFrame([(s, i) for i, s in enumerate(names)], "name string, number int")
    first = (sums.join(queues, sums["source"].eqNullSafe(queues["name"]))
             .select("task", "name", F.col("number").alias("queue"), "n")
             .withColumn("earlier", F.sum("n").over(Window.partitionBy("queue").orderBy("task")) - F.col("n")))
    first = stage(first, "packing-first")  # its size is known when the join is planned
    placed = (tokens.join(first.select(F.col("task").alias("of"), "name", "queue", "earlier"),
                          (F.col("task") == F.col("of")) & F.col("source").eqNullSafe(F.col("name")))
              .select("doc_id", "source", "queue", (F.col("earlier") + F.col("position")).alias("first"), "doc_tokens", "width", "ids"))
    return placed.mapInArrow(cut(tokens.sparkSession.sparkContext.broadcast(schedule)), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                            "sequence_id long, offset long, source string")


def query(spark, sf_dir):
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents", "doc_id", "text", "source"), public_tokenizers.path("word_bpe_49k.json"))


def pipeline_stage(spark, docs, sf_dir):
    """The last stage of the corpus pipeline: the pieces of the packed sequences."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))
