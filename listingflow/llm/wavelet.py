"""Token ids in wavelet-matrix files: succinct bit-planes with rank and select.

A shard holds the ids of documents in ascending id order as one bit-plane per bit.  Plane ``l``
lists bit ``l`` (highest first) of all ids, in the order left by stably moving the ids with a 0
in each earlier plane before those with a 1.  Planes are cut into blocks, compressed one by one,
with the number of ones before each block, so access, counting and occurrence lookup touch a few
blocks of one compressed file.

File layout (little-endian): shards one after another, each followed by a line feed, with

    magic "WMX1" | body length u64 | task u32 | shard in task u32 | documents u64 | tokens u64 | planes u32
    document ids i64[], known u8[], token counts u32[]             (each: compressed length u64, zstd)
    zeros per plane u64[], ones before each block u64[], block lengths u32[]          (the same)
    compressed blocks

Files are written by Spark's writer (one per task, committed with the job) into a new folder, so
a lost executor leaves no half file; they are read back with Spark's ``binaryFile`` reader.

Edge cases: a null text gives its end id only; null ids come first and repeated ids stay
together in any order; an empty table gives no shard.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listingflow.session import ship_package

from .common import in_blocks, partition_id, squeeze, stage, stage_path, table, unsqueeze
from .tokens import encoder

END_ID = 2
SHARD_TOKENS = 4 << 20
BLOCK_BITS = 1 << 17
_HEAD = struct.Struct("<4sQIIQQI")


class WaveletMatrix:
    """Succinct sequence of ids over compressed bit-planes."""

    def __init__(self, n: int, zeros: np.ndarray, ones: np.ndarray, blocks: list[bytes]):
        self.n, self.zeros, self.ones, self.blocks = n, zeros, ones, blocks
        self.planes = len(zeros)
        self.per_plane = -(-n // BLOCK_BITS) if n else 0

    @classmethod
    def build(cls, ids: np.ndarray, planes: int) -> "WaveletMatrix":
        current = ids.astype(np.uint16 if planes <= 16 else np.uint32)
        zeros, ones, blocks = np.zeros(planes, np.uint64), [], []
        for level in range(planes):
            bits = current & current.dtype.type(1 << (planes - 1 - level)) != 0
            total = 0
            for i in range(0, len(bits), BLOCK_BITS):
                part = bits[i:i + BLOCK_BITS]
                ones.append(total)
                total += int(np.count_nonzero(part))
                blocks.append(squeeze(np.packbits(part)))
            zeros[level] = len(bits) - total
            current = np.concatenate((np.compress(~bits, current), np.compress(bits, current)))
        return cls(len(ids), zeros, np.array(ones, np.uint64), blocks)

    def _bits(self, level: int, block: int) -> np.ndarray:
        size = min(BLOCK_BITS, self.n - block * BLOCK_BITS)
        return np.unpackbits(unsqueeze(self.blocks[level * self.per_plane + block], np.uint8), count=size)

    def _plane(self, level: int) -> np.ndarray:
        raw = b"".join(unsqueeze(b) for b in self.blocks[level * self.per_plane:(level + 1) * self.per_plane])
        return np.unpackbits(np.frombuffer(raw, np.uint8), count=self.n).view(bool)

    def _ones_before(self, level: int, i: int) -> int:
        """Ones of a plane before position ``i``."""
        block, rest = divmod(i, BLOCK_BITS)
        if block == self.per_plane:
            return self.n - int(self.zeros[level])
        ones = int(self.ones[level * self.per_plane + block])
        return ones + int(np.count_nonzero(self._bits(level, block)[:rest])) if rest else ones

    def _find(self, level: int, bit: int, k: int) -> int:
        """Position of the ``k``-th (from 0) given bit of a plane."""
        low, high = 0, self.per_plane
        while high - low > 1:
            mid = (low + high) // 2
            ones = int(self.ones[level * self.per_plane + mid])
            low, high = (mid, high) if (ones if bit else mid * BLOCK_BITS - ones) <= k else (low, mid)
        ones = int(self.ones[level * self.per_plane + low])
        k -= ones if bit else low * BLOCK_BITS - ones
        return low * BLOCK_BITS + int(np.flatnonzero(self._bits(level, low) == bit)[k])

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        value = 0
        for level in range(self.planes):
            block, rest = divmod(i, BLOCK_BITS)
            bit = int(self._bits(level, block)[rest])
            ones = self._ones_before(level, i)
            i = int(self.zeros[level]) + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """The id's run after the last plane, and where occurrences before ``end`` stop in it."""
        begin = 0
        for level in range(self.planes):
            a, b = self._ones_before(level, begin), self._ones_before(level, end)
            zeros = int(self.zeros[level])
            begin, end = (zeros + a, zeros + b) if value >> (self.planes - 1 - level) & 1 else (begin - a, end - b)
        return begin, end

    def rank(self, value: int, end: int | None = None) -> int:
        """How often the id occurs before position ``end`` (by default anywhere)."""
        begin, stop = self._range(value, self.n if end is None else end)
        return stop - begin

    def select(self, value: int, k: int) -> int:
        """Position of the id's ``k``-th occurrence, from 0; IndexError beyond the last."""
        begin, stop = self._range(value, self.n)
        if not 0 <= k < stop - begin:
            raise IndexError(k)
        i = begin + k
        for level in reversed(range(self.planes)):
            bit = value >> (self.planes - 1 - level) & 1
            i = self._find(level, bit, i - int(self.zeros[level]) if bit else i)
        return i

    def decode(self) -> np.ndarray:
        """All ids: the planes' moves undone from the last plane to the first."""
        current = np.zeros(self.n, np.uint16 if self.planes <= 16 else np.uint32)
        for level in reversed(range(self.planes)):
            bits, zeros = self._plane(level), int(self.zeros[level])
            before = np.empty_like(current)
            # by place: a mask that follows no pattern is slower
            before[np.flatnonzero(~bits)] = current[:zeros]
            before[np.flatnonzero(bits)] = current[zeros:] | current.dtype.type(1 << (self.planes - 1 - level))
            current = before
        return current


def _sized(data: bytes) -> bytes:
    return struct.pack("<Q", len(data)) + data


def write_shard(task: int, number: int, doc_ids: list, counts: np.ndarray, ids: np.ndarray, planes: int) -> bytes:
    m = WaveletMatrix.build(ids, planes)
    body = b"".join([
        _sized(squeeze(np.array([i or 0 for i in doc_ids], np.int64))), _sized(squeeze(np.array([i is not None for i in doc_ids], np.uint8))),
        _sized(squeeze(counts.astype(np.uint32))), _sized(squeeze(m.zeros)), _sized(squeeze(m.ones)),
        _sized(squeeze(np.array([len(b) for b in m.blocks], np.uint32))), *m.blocks])
    return _HEAD.pack(b"WMX1", len(body), task, number, len(doc_ids), len(ids), planes) + body


def read_shards(data: bytes):
    """Yield ``(task, number, doc_ids, counts, matrix)`` for the shards of a file's content."""
    at = 0
    while at < len(data):
        magic, size, task, number, _, tokens, _ = _HEAD.unpack_from(data, at)
        if magic != b"WMX1":
            raise ValueError("not a wavelet shard")
        at += _HEAD.size
        end, parts = at + size, []
        for _ in range(6):
            (length,) = struct.unpack_from("<Q", data, at)
            parts.append(data[at + 8:at + 8 + length])
            at += 8 + length
        blocks = []
        for length in unsqueeze(parts[5], np.uint32).tolist():
            blocks.append(data[at:at + length])
            at += length
        known = unsqueeze(parts[1], np.uint8).tolist()
        doc_ids = [i if k else None for i, k in zip(unsqueeze(parts[0], np.int64).tolist(), known)]
        yield task, number, doc_ids, unsqueeze(parts[2], np.uint32), WaveletMatrix(tokens, unsqueeze(parts[3], np.uint64), unsqueeze(parts[4], np.uint64), blocks)
        if at != end:
            raise ValueError("damaged wavelet shard")
        at += 1


def encode_shards(path: str, end_id: int, most: int):
    """Task function: sorted documents -> the task's shards in the file format."""
    def run(batches):
        tokenizer = encoder(path)
        planes = max(tokenizer.tokenizer.get_vocab_size() - 1, end_id, 1).bit_length()
        number, docs, counts, parts = 0, [], [], []

        def close():
            return pa.RecordBatch.from_arrays([pa.array([write_shard(partition_id(), number, docs, np.concatenate(counts), np.concatenate(parts), planes)], pa.binary())], names=["shard"])

        for rows, texts in in_blocks(batches, "text", 2 << 20):
            ids, lengths = tokenizer.encode(texts)
            parts.append(np.insert(ids, np.cumsum(lengths), end_id))
            counts.append(lengths + 1)
            docs.extend(rows.column("doc_id").to_pylist())
            if sum(map(len, parts)) >= most:
                yield close()
                number, docs, counts, parts = number + 1, [], [], []
        if docs:
            yield close()
    return run


def write_ids(docs: DataFrame, path: str, folder: str, end_id: int = END_ID, id: str = "doc_id", text: str = "text",
              shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the ids of all documents as wavelet files, in ascending id order over the files."""
    ship_package(docs.sparkSession)
    docs = docs.select(docs[id].cast("long").alias("doc_id"), docs[text].alias("text"))
    # the text's hash spreads rows that share an id over several tasks
    (docs.repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id")
     .mapInArrow(encode_shards(path, end_id, shard_tokens), "shard binary")
     .select(F.col("shard").cast("string").alias("value")).write.text(folder))


def decode_file(batches):
    """Task function: files -> their documents with checksums of the decoded ids."""
    names = ["task", "number", "place", "doc_id", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for content in batch.column("content").to_pylist():
            for task, number, doc_ids, counts, matrix in read_shards(content):
                ids = matrix.decode().astype("<u4")
                ends = np.cumsum(counts, dtype=np.int64)
                starts = ends - counts
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array([task] * n, pa.int64()), pa.array([number] * n, pa.int64()), pa.array(range(n), pa.int64()),
                    pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(counts.astype(np.int64)), pa.array(crcs, pa.int64())], names=names)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of wavelet files: ``doc_id, start, n_tokens, ids_crc32``, all from the files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    docs = stage(files.mapInArrow(decode_file, "task long, number long, place long, doc_id long, start long, n_tokens long, ids_crc32 long"), "wavelet-docs")
    sizes = docs.groupBy("task", "number").agg(F.sum("n_tokens").alias("n"))
    # one row per shard of millions of ids
    before = sizes.select("task", "number", (F.sum("n").over(Window.orderBy("task", "number")) - F.col("n")).alias("before"))
    before = stage(before, "wavelet-before")  # its size is known when the join is planned
    return (docs.join(before, ["task", "number"])
            .select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"))


def query(spark, sf_dir):
    import public_tokenizers

    folder = stage_path(spark, "wavelet")
    write_ids(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_ids(spark, folder)
