"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over all
token windows of the documents, every hit verified word by word.

Words are runs of ``0-9 a-z`` (A-Z lower-cased) and of anything beyond ASCII.  A window is ten
consecutive words of a benchmark item; an item of fewer words is one window.

The benchmark is broadcast only while its text is at most ``MOST_BROADCAST_BYTES``, measured
first; beyond that the windows of both sides are joined by Spark (``hits_by_join``), with the
same result.

Edge cases: null or empty text has no words; items without words have no window; a null item id
is named by the empty string; repeated items count once per id; repeated documents each give a
row; an empty benchmark marks nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_blocks, numbered, stage, table, window_hashes, U64

WINDOW_WORDS = 10
MOST_BROADCAST_BYTES = 16 << 20
#: Bytes to word bytes: A-Z lower-cased, other ASCII outside 0-9 a-z to a space.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


class TestNgrams:
    """Windows of the benchmark: per window length a sorted hash array, and the exact windows."""

    __test__ = False

    def __init__(self, items: list[tuple[str, bytes]], length: int = WINDOW_WORDS):
        self.words: dict[bytes, int] = {}
        self.windows: dict[int, dict[bytes, set[str]]] = {}
        for name, text in items:
            codes = np.array([self.words.setdefault(w, len(self.words)) for w in words_of(text)], np.int64)
            size = min(length, len(codes))
            for i in range(len(codes) - size + 1 if size else 0):
                self.windows.setdefault(size, {}).setdefault(codes[i:i + size].tobytes(), set()).add(name)
        self.hashes = {size: np.sort(np.concatenate([window_hashes(np.frombuffer(k, np.int64).astype(U64), size) for k in found]))
                       for size, found in self.windows.items()}

    def scan(self, texts: list[bytes]) -> tuple[list[int], np.ndarray, list[set[str]], np.ndarray]:
        """Words and hit words per text, items per text, and the hit mask over all words."""
        cut = [words_of(t) for t in texts]
        counts = [len(c) for c in cut]
        get = self.words.get
        codes = np.fromiter(map(get, chain.from_iterable(cut), repeat(-1)), np.int64, sum(counts))
        doc = np.repeat(np.arange(len(texts)), counts)
        strange = np.concatenate(([0], np.cumsum(codes < 0)))
        change = np.zeros(len(codes) + 1, np.int64)
        items: list[set[str]] = [set() for _ in texts]
        for size, found in self.windows.items():
            n = len(codes) - size + 1
            if n <= 0:
                continue
            at = np.flatnonzero((strange[size:] == strange[:n]) & (doc[size - 1:] == doc[:n]))
            if not len(at):
                continue
            hashes = window_hashes_at(codes.astype(U64), at, size)
            place = np.minimum(np.searchsorted(self.hashes[size], hashes), len(self.hashes[size]) - 1)
            for i in at[self.hashes[size][place] == hashes].tolist():
                names = found.get(codes[i:i + size].tobytes())
                if names:
                    change[i] += 1
                    change[i + size] -= 1
                    items[doc[i]] |= names
        hit = np.cumsum(change[:-1]) > 0
        return counts, np.bincount(doc, weights=hit, minlength=len(texts)).astype(np.int64), items, hit


def window_hashes_at(codes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """``window_hashes`` at some positions only."""
    return window_hashes(codes[at[:, None] + np.arange(size)].T, size)[0]


def items_digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def scan_blocks(grams):
    """Task function: documents -> hits per document."""
    def run(batches):
        for rows, texts in in_blocks(batches, "text"):
            counts, hits, items, _ = grams.value.scan(texts)
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays(rows.column("doc_id").chunks), pa.array(counts, pa.int64()), pa.array(hits),
                pa.array([len(i) for i in items], pa.int64()), pa.array([items_digest(i) for i in items], pa.string()),
            ], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256"])
    return run


def _spark_words(column: str):
    lower = F.translate(F.coalesce(column, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))


def hits_by_join(docs: DataFrame, benchmark: DataFrame, length: int, row: str | None = None) -> DataFrame:
    """The same result for a benchmark of any size: windows of both sides meet in a join.

    ``row``: a column of ``docs`` with a number of each row's own, returned as well.
    """
    items = (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), _spark_words("text").alias("words"))
             .filter("size(words) > 0").withColumn("size", F.least(F.size("words"), F.lit(length))))
    windows = items.select("item", "size", F.explode(F.expr("transform(sequence(1, size(words) - size + 1), i -> concat_ws(' ', slice(words, i, size)))")).alias("window")).distinct()
    sizes = F.array(*(F.lit(n) for n in range(1, length + 1)))
    rows = stage(docs.select("doc_id", _spark_words("text").alias("words"), (F.col(row) if row else F.monotonically_increasing_id()).alias("row")), "decontam-rows")
    starts = (rows.select("row", "words", F.explode(sizes).alias("size")).filter("size(words) >= size")
              .selectExpr("row", "size", "posexplode(transform(sequence(1, size(words) - size + 1), i -> concat_ws(' ', slice(words, i, size)))) as (start, window)"))
    hits = starts.join(windows, ["size", "window"])
    covered = hits.select("row", F.explode(F.expr("sequence(start, start + size - 1)")).alias("at")).groupBy("row").agg(F.countDistinct("at").alias("n_hit"))
    found = hits.groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return (rows.select("row", "doc_id", F.size("words").cast("long").alias("n_words")).join(covered, "row", "left").join(found, "row", "left")
            .select(*([F.col("row").alias(row)] if row else []), "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")), 256).alias("items_sha256")))


def mark_benchmark(docs: DataFrame, benchmark: DataFrame, length: int = WINDOW_WORDS, most_bytes: int = MOST_BROADCAST_BYTES) -> DataFrame:
    """Benchmark hits of every document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    if (benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0) > most_bytes:
        found = hits_by_join(docs, benchmark, length)
    else:
        grams = docs.sparkSession.sparkContext.broadcast(_collect(benchmark, length))
        found = docs.select("doc_id", "text").mapInArrow(scan_blocks(grams), f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string")
    return found.withColumn("contaminated", F.col("n_hit") > 0)


def _collect(benchmark: DataFrame, length: int) -> TestNgrams:
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")).cast("binary")).collect()
    return TestNgrams([(r[0], bytes(r[1])) for r in rows], length)


def clean_documents(docs: DataFrame, benchmark: DataFrame, length: int = WINDOW_WORDS, most_bytes: int = MOST_BROADCAST_BYTES) -> DataFrame:
    """The documents, all columns, without those that hold a benchmark window."""
    if (benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0) > most_bytes:
        rows, row = numbered(docs, "decontam-input")
        dirty = hits_by_join(rows, benchmark, length, row).filter("n_hit > 0").select(row)
        return rows.join(dirty, row, "left_anti").select(*docs.columns)
    grams = docs.sparkSession.sparkContext.broadcast(_collect(benchmark, length))

    def run(batches):
        for rows, texts in in_blocks(batches, "text"):
            keep = grams.value.scan(texts)[1] == 0
            yield from rows.filter(pa.array(keep)).to_batches()
    return docs.mapInArrow(run, docs.schema)


def query(spark, sf_dir):
    return mark_benchmark(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def pipeline_stage(spark, docs, sf_dir):
    """Documents with a benchmark window go."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


ORACLE = r"""
WITH iw AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
ig AS (SELECT item, least(len(w), 10) AS k, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS g
       FROM iw WHERE len(w) > 0),
g AS (SELECT DISTINCT item, k, g FROM ig),
dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dg AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g
       FROM dw, (SELECT DISTINCT k FROM g) s WHERE len(w) >= k),
h AS (SELECT doc_id, i, g.k AS k, item FROM dg JOIN g ON dg.g = g.g AND dg.k = g.k),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) x GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) x GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
