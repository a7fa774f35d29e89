"""Small helpers shared by the training-data operators.

Words are byte strings throughout: ``bytes.split()`` cuts exactly at ``[\\x20\\x09-\\x0D]+`` and
``bytes.lower()`` lower-cases exactly A-Z, so both match the definitions the operators use.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.session import ensure_checkpoint_dir, ship_package

#: A block of documents handled at once inside a task holds about this much text.
BLOCK_BYTES = 8 << 20

U64 = np.uint64
_ODD = U64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    ship_package(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder of the cluster."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later passes then see one fixed result even if executors are lost, and column pruning applies.
    """
    spark = df.sparkSession
    ship_package(spark)
    path = stage_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_and_release(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``stage``, then have Spark's cleaner see that the job's large shuffle files are done with
    (it removes them when the driver collects garbage, by default every 30 minutes)."""
    out = stage(df, name, compression)
    del df
    gc.collect()
    out.sparkSession.sparkContext._jvm.System.gc()
    return out


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` staged with a number of each row's own, and the name of that column (which ``df`` has not)."""
    row = "row" + "_" * (1 + max(map(len, df.columns)))
    return stage(df.withColumn(row, F.monotonically_increasing_id()), name), row


def binaries(column: pa.Array) -> list:
    """Byte strings (or None) of a string or binary column, without decoding."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return column.to_pylist()


def partition_id() -> int:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0


def squeeze(data, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data if isinstance(data, bytes) else np.ascontiguousarray(data).tobytes())


def unsqueeze(data: bytes, dtype=None):
    raw = zstandard.ZstdDecompressor().decompress(data)
    return raw if dtype is None else np.frombuffer(raw, dtype=dtype)


def squeeze_sorted(values: np.ndarray) -> bytes:
    """Sorted unsigned integers as differences, split into byte planes so the high ones vanish."""
    deltas = np.diff(values, prepend=values.dtype.type(0))
    return squeeze(np.ascontiguousarray(deltas.view(np.uint8).reshape(len(values), values.itemsize).T))


def unsqueeze_sorted(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = unsqueeze(data, np.uint8).reshape(width, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view(dtype), dtype=dtype)


class Ids(dict):
    """Word -> number in order of first sight."""

    def __missing__(self, word):
        number = self[word] = len(self)
        return number


class Hashes(dict):
    """Word -> 64-bit hash, remembered; forgets everything when it has grown large."""

    LIMIT = 200_000

    def __missing__(self, word):
        if len(self) > self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = Hashes()


def word_hashes(words: list) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), U64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of every run of ``length`` consecutive words (empty when there is none)."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, U64)
    out = hashes[:n].copy()
    for i in range(1, length):
        out *= _ODD
        out += hashes[i:n + i]
    return mix(out)


def run_hashes(hashes: np.ndarray, lengths: Iterable[int], factor: np.uint64 = _ODD) -> list[np.ndarray]:
    """``window_hashes`` of several lengths, each put together from shorter runs (20 words in five steps).

    Entry ``i`` is the run from word ``i``; the arrays get shorter as the runs get longer, down to none.
    """
    known = {1: hashes}
    for wanted in lengths:
        open_ = [wanted]  # a loop: a function that calls itself would keep all arrays until garbage is collected
        while open_:
            length = open_[-1]
            head = max(k for k in known if k <= length)
            if head == length:
                open_.pop()
            elif length - head in known:
                n = max(0, len(hashes) - length + 1)
                known[length] = known[head][:n] * U64(pow(int(factor), length - head, 1 << 64)) + known[length - head][head:head + n]
            else:
                open_.append(length - head)
    return [mix(known[length]) for length in lengths]


def eights(raw) -> np.ndarray:
    """The eight bytes from every place of ``raw`` on, as numbers (nothing is copied)."""
    return np.ndarray(max(0, len(raw) - 7), "<u8", raw, strides=(1,))


class Words:
    """Where the words ``[^\\x20\\x09-\\x0D]+`` of several texts lie, found for all texts at once."""

    #: Longer words (in bytes) are hashed one by one.
    LONG = 64
    #: Words hashed at a time, so that what is computed on the way stays small.
    SEGMENT = 1 << 16

    def __init__(self, texts: list[bytes]):
        self.raw = b" ".join((b"", *texts, bytes(8)))  # a space before and behind each text; eight bytes can be read from any place
        self.bytes = np.frombuffer(self.raw, np.uint8)
        held = self.bytes[:-8]
        space = (held == 32) | (held - np.uint8(9) <= 4)
        self.starts = np.flatnonzero(space[:-1] > space[1:]) + 1
        self.lengths = np.flatnonzero(space[:-1] < space[1:]) + 1 - self.starts
        begins = np.cumsum([1, *(len(t) + 1 for t in texts)])
        #: Words per text.
        self.counts = np.diff(np.searchsorted(self.starts, begins))

    def hashes(self, seed: int = 0, begin: int = 0, end: int | None = None) -> np.ndarray:
        """A 64-bit hash of each word (from ``begin`` to ``end``), eight bytes at a step; equal words
        have equal hashes."""
        factor = U64(_SEEDS[seed])
        starts, lengths = self.starts[begin:end], self.lengths[begin:end]
        out = mix(lengths.astype(U64) + factor)
        lanes = eights(self.raw)
        short = lengths <= self.LONG
        at = np.flatnonzero(short)
        places, left = starts[at], lengths[at]
        while len(at):
            lane = lanes[places] & BYTE_MASKS[np.minimum(left, 8)]
            out[at] = mix((out[at] ^ lane) * factor)
            more = left > 8
            at, places, left = at[more], places[more] + 8, left[more] - 8
        for i in np.flatnonzero(~short).tolist():
            out[i] = xxhash.xxh3_64_intdigest(self.raw[starts[i]:starts[i] + lengths[i]], seed=seed)
        return out


    def windows(self, lengths: list[int], seed: int = 0, factor: np.uint64 = _ODD, within: int = 1) -> tuple[np.ndarray, list[np.ndarray]]:
        """The words from which at least ``within`` words follow in their text (themselves included), and
        the hashes of the runs of each length (at most ``within``) from there."""
        places, found = [np.empty(0, np.int64)], [[np.empty(0, U64)] for _ in lengths]
        ends, last = np.cumsum(self.counts), len(self.starts)
        for begin in range(0, last, self.SEGMENT):
            here = np.arange(begin, min(begin + self.SEGMENT, last))
            here = here[ends[np.searchsorted(ends, here, side="right")] - here >= within]
            hashes = self.hashes(seed, begin, begin + self.SEGMENT + within - 1)
            for out, values in zip(found, run_hashes(hashes, lengths, factor)):
                out.append(values[here - begin])
            places.append(here)
        return np.concatenate(places), [np.concatenate(out) for out in found]


#: Odd factors of the word hashes.
_SEEDS = (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F)
#: The lowest 0 to 8 bytes of a number.
BYTE_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)


def in_blocks(batches: Iterable[pa.RecordBatch], text: str, most_bytes: int = BLOCK_BYTES) -> Iterator[tuple[pa.Table, list[bytes]]]:
    """Regroup a task's batches into blocks of whole rows with about ``most_bytes`` of text.

    Yields the rows as a table and their texts as byte strings (null: empty).
    """
    rows: list[pa.RecordBatch] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        begin = 0
        for i, value in enumerate(binaries(batch.column(text))):
            value = value or b""
            if size and size + len(value) > most_bytes:
                rows.append(batch.slice(begin, i - begin))
                yield pa.Table.from_batches(rows), texts
                rows, texts, size, begin = [], [], 0, i
            texts.append(value)
            size += len(value)
        if begin < batch.num_rows:
            rows.append(batch.slice(begin))
    if texts:
        yield pa.Table.from_batches(rows), texts


def ragged(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    """A list column from concatenated values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
