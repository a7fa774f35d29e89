"""Substring dedup with prefix-partitioned suffix trees.

A repeat is a run of 20 words that also starts earlier (smaller document id, or earlier in the
same document); the words of later runs are removed.  In a suffix tree over all word suffixes
such runs are the paths to nodes 20 or more words deep with more than one leaf.  One tree does
not fit a task, so suffixes are split by variable-length prefixes into groups of bounded size:

1. Documents are gathered into blocks, written once; each block counts its suffixes per 2-word,
   5-word and 10-word prefix (hashed to 4096 cells each; the sums are 12,288 numbers).
2. A suffix belongs to the shortest prefix whose cell holds at most ``GROUP_SUFFIXES`` suffixes,
   and to its whole 20-word path if none does.  Suffixes with equal 20-word paths thus share a
   group.  Of a block's suffixes only the first on each path leaves for its group, so a passage
   that a third of all rows repeat is one row per block.
3. In a group the suffixes are sorted by path, so the leaves below each deep node are neighbours.
   The groups answer every block with one bit per path: whether it has leaves in other blocks too.
4. For these paths only, blocks send a second hash of the 20 words and the document.  Among equal
   words the smallest in document order is the original, the others are repeats; the answer is
   again one bit per path.
5. Blocks take their answers back and remove the covered words; text never moves beyond its block.

A path is found by a 64-bit hash of its 20 words, and suffixes are equal only if the second hash
(64 bits, from other word hashes and another factor) is equal too; so also within a block.

Edge cases: null, empty or short texts have no window and stay; a null id is later than all
others; of rows with one id the order is that of their blocks, so exactly one is the original;
an empty table gives no rows; other columns are carried through where documents are returned.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (in_blocks, mix, partition_id, shuffle_partitions, squeeze, squeeze_sorted, stage, stage_and_release, table, unsqueeze,
                     unsqueeze_sorted, Words, U64)

WINDOW_WORDS = 20
PREFIX_WORDS = (2, 5, 10)
CELLS = 4096
#: Suffixes that a group may hold before a longer prefix splits it.
GROUP_SUFFIXES = 1_000_000
#: Text of a block: all its suffixes are in memory at once.
BLOCK_BYTES = 4 << 20
_WORD = re.compile(rb"[^ \t-\r]+")
_LAST = np.iinfo(np.int64).max
#: Factor of the second hash.
_OTHER = U64(0xD6E8FEB86659FD93)


def suffixes(texts: list[bytes], window: int, whole: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Words per text; place (among all words) of each suffix of at least a window; its path hash and
    second hash (both only if ``whole``), and its prefix hashes."""
    words = Words(texts)
    prefixes = [min(length, window) for length in PREFIX_WORDS]
    if not whole:
        at, found = words.windows(prefixes, within=window)
        return words.counts, at, None, None, found
    at, (*prefix, paths) = words.windows([*prefixes, window], within=window)
    return words.counts, at, paths, words.windows([window], 1, _OTHER, window)[1][0], prefix


def cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U64(52)).astype(np.int64)


def gather(window: int, order: str):
    """Task function: documents -> blocks in document order, with suffixes counted per prefix."""
    def run(batches):
        for number, (rows, texts) in enumerate(in_blocks(batches, "text", BLOCK_BYTES)):
            ids = np.array([_LAST if i is None else i for i in rows.column(order).to_pylist()], np.int64)
            sort = np.argsort(ids, kind="stable")
            texts = [texts[i] for i in sort]
            *_, prefixes = suffixes(texts, window, False)
            counts = np.concatenate([np.bincount(cells(p), minlength=CELLS) for p in prefixes])
            rest = rows.take(pa.array(sort)).drop_columns(["text"])
            null = rows.column("text").is_null().take(pa.array(sort)).to_pylist()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest.schema) as out:
                out.write_table(rest.combine_chunks())
            yield pa.RecordBatch.from_arrays([
                pa.array([(partition_id() << 32) + number], pa.int64()), pa.array([squeeze(ids[sort])], pa.binary()),
                pa.array([squeeze(np.array([-1 if n else len(t) for t, n in zip(texts, null)], np.int64))], pa.binary()),
                pa.array([squeeze(b"".join(texts), 5)], pa.binary()), pa.array([squeeze(sink.getvalue().to_pybytes())], pa.binary()),
                pa.array([counts.tolist()], pa.list_(pa.int64())),
            ], names=["block", "ids", "lengths", "texts", "rest", "counts"])
    return run


def open_block(row: dict) -> tuple[list[bytes], np.ndarray]:
    lengths = unsqueeze(row["lengths"], np.int64)
    raw = unsqueeze(row["texts"])
    ends = np.cumsum(np.maximum(lengths, 0)).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)], lengths


class Groups:
    """Where each suffix goes: by its shortest prefix that is not too common."""

    def __init__(self, counts: np.ndarray, buckets: int, most: int):
        self.common = [c > most for c in counts.reshape(len(PREFIX_WORDS), CELLS)]
        self.buckets = buckets

    def bucket(self, paths: np.ndarray, prefixes: list[np.ndarray]) -> np.ndarray:
        group = mix(paths)
        open_ = np.ones(len(paths), bool)
        for level, (common, hashes) in enumerate(zip(self.common, prefixes)):
            cell = cells(hashes)
            here = open_ & ~common[cell]
            group[here] = mix((cell[here] + (level + 1) * CELLS).astype(U64))
            open_ &= ~here
        return (group % U64(self.buckets)).astype(np.int32)


def first_paths(paths: np.ndarray, checks: np.ndarray, bucket: np.ndarray):
    """The block's first suffix on each path, sorted by (bucket, path); suffix -> its path's place.

    ``checks``: second hashes, which tell unequal words with one path hash apart.
    """
    order = np.argsort(paths)
    new = np.diff(paths[order], prepend=U64(0)) != 0
    new[0] = True
    if (~new[1:] & (np.diff(checks[order]) != 0)).any():
        order = np.lexsort((checks, paths))
        new = (np.diff(paths[order], prepend=U64(0)) != 0) | (np.diff(checks[order], prepend=U64(0)) != 0)
        new[0] = True
    first = np.minimum.reduceat(order, np.flatnonzero(new))
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    number = bucket[first]
    order = np.argsort(number.astype(np.uint16) if not len(number) or number.max() < 1 << 16 else number, kind="stable")  # short keys sort in linear time
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    first = first[order]
    return paths[first], first, number[order], rank[place]


def by_bucket(bucket: np.ndarray):
    """``(bucket, begin, end)`` of each run of a sorted array."""
    used, begin = np.unique(bucket, return_index=True)
    return zip(used.tolist(), begin.tolist(), [*begin[1:].tolist(), len(bucket)])


def block_paths(texts: list[bytes], window: int, groups: Groups):
    """Words per text, places and second hashes of a block's suffixes, and ``first_paths`` (None without suffixes)."""
    counts, at, paths, checks, prefixes = suffixes(texts, window)
    return counts, at, checks, first_paths(paths, checks, groups.bucket(paths, prefixes)) if len(paths) else None


def send_suffixes(window: int, groups):
    """Task function: blocks -> per bucket the paths of the block."""
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("paths", pa.binary())])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = block_paths(open_block(row)[0], window, groups.value)[3]
                if found:
                    known, _, bucket, _ = found
                    yield pa.RecordBatch.from_pylist([{"block": row["block"], "bucket": number, "paths": squeeze_sorted(known[a:b])} for number, a, b in by_bucket(bucket)], schema=schema)
    return run


def deep_paths(paths: np.ndarray) -> np.ndarray:
    """For each path whether it is there more than once."""
    order = np.argsort(paths, kind="stable")
    same = np.diff(paths[order]) == 0
    out = np.empty(len(paths), bool)
    out[order] = np.concatenate((same, [False])) | np.concatenate(([False], same))  # below a node with more than one leaf
    return out


def answer_deep(batches):
    """Task function: the paths of some buckets -> one bit per path, in the order sent: whether it is deep."""
    rows, paths = [], []
    for batch in batches:
        for row in batch.to_pylist():
            paths.append(unsqueeze_sorted(row["paths"], np.uint64))
            rows.append((row["block"], row["bucket"]))
    if not rows:
        return
    deep = deep_paths(np.concatenate(paths))
    ends = np.cumsum([len(p) for p in paths]).tolist()
    yield pa.RecordBatch.from_arrays([
        pa.array([b for b, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.int32()),
        pa.array([squeeze(np.packbits(deep[a:b])) for a, b in zip([0, *ends], ends)], pa.binary())], names=["block", "bucket", "bits"])


def send_deep(window: int, groups):
    """Task function: blocks with the bits of their paths -> per bucket the deep ones with second hash and document."""
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("n", pa.int64()), ("deep", pa.binary()), ("paths", pa.binary()),
                        ("checks", pa.binary()), ("docs", pa.binary()), ("index", pa.binary())])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                bits = {a["bucket"]: a["bits"] for a in row["answers"]}
                texts, _ = open_block(row)
                counts, places, checks, (known, first, bucket, _) = block_paths(texts, window, groups.value)
                owner = np.repeat(np.arange(len(texts)), counts)[places]
                ids = unsqueeze(row["ids"], np.int64)
                out = []
                for number, a, b in by_bucket(bucket):
                    at = a + np.flatnonzero(np.unpackbits(unsqueeze(bits[number], np.uint8), count=b - a))
                    if not len(at):
                        continue
                    docs, index = np.unique(owner[first[at]], return_inverse=True)
                    out.append({"block": row["block"], "bucket": number, "n": b - a, "deep": bits[number], "paths": squeeze_sorted(known[at]),
                                "checks": squeeze(checks[first[at]]), "docs": squeeze(ids[docs]),
                                "index": squeeze(np.ascontiguousarray(index.astype("<u4").view(np.uint8).reshape(-1, 4).T))})
                yield pa.RecordBatch.from_pylist(out, schema=schema)
    return run


def originals(paths: np.ndarray, checks: np.ndarray, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """For each suffix whether it is the first in document order of those with its words."""
    out = np.ones(len(paths), bool)
    order = np.lexsort((blocks, docs, checks, paths))
    out[order[1:]] = (np.diff(paths[order]) != 0) | (np.diff(checks[order]) != 0)
    return out


def answer_groups(batches):
    """Task function: the deep paths of some buckets -> one bit per path of the bucket: whether it stays."""
    rows, paths, checks, docs = [], [], [], []
    for batch in batches:
        for row in batch.to_pylist():
            paths.append(unsqueeze_sorted(row["paths"], np.uint64))
            checks.append(unsqueeze(row["checks"], np.uint64))
            index = np.ascontiguousarray(unsqueeze(row["index"], np.uint8).reshape(4, -1).T).view("<u4").ravel()
            docs.append(unsqueeze(row["docs"], np.int64)[index])
            rows.append((row["block"], row["bucket"], row["n"], row["deep"]))
    if not rows:
        return
    sizes = [len(p) for p in paths]
    kept = originals(np.concatenate(paths), np.concatenate(checks), np.concatenate(docs), np.repeat(np.array([r[0] for r in rows], np.int64), sizes))
    bits, end = [], 0
    for (_, _, n, deep), size in zip(rows, sizes):
        whole = np.ones(n, bool)
        whole[np.flatnonzero(np.unpackbits(unsqueeze(deep, np.uint8), count=n))] = kept[end:end + size]
        bits.append(squeeze(np.packbits(whole)))
        end += size
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array(bits, pa.binary())],
                                     names=["block", "bucket", "bits"])


def removed_words(texts: list[bytes], answers: list[dict], window: int, groups: Groups) -> list[np.ndarray]:
    """Per text a mask of its words: those to remove."""
    counts, at, _, found = block_paths(texts, window, groups)
    change = np.zeros(int(counts.sum()) + 1, np.int64)
    if found:
        known, first, bucket, place = found
        original = np.ones(len(known), bool)
        bits = {a["bucket"]: a["bits"] for a in answers}  # none for a bucket without deep paths
        for number, a, b in by_bucket(bucket):
            if number in bits:
                original[a:b] = np.unpackbits(unsqueeze(bits[number], np.uint8), count=b - a)
        repeat = at[~(original[place] & (first[place] == np.arange(len(place))))]
        change[repeat] += 1
        change[repeat + window] -= 1
    return np.split(np.cumsum(change)[:-1] > 0, np.cumsum(counts)[:-1])


def kept_words(text: bytes, mask: np.ndarray) -> bytes:
    """The words that are not masked, joined by one space."""
    words = text.split()
    return b" ".join([w for w, gone in zip(words, mask.tolist()) if not gone] if mask.any() else words)


def kept_text(text: bytes, mask: np.ndarray) -> bytes:
    """The text without the masked words; what stood before each word goes with it."""
    parts, at = [], 0
    for gone, word in zip(mask.tolist(), _WORD.finditer(text)):
        if not gone:
            parts.append(text[at:word.end()])
        at = word.end()
    return b"".join(parts).strip(b" \t\n\r\x0b\f")


def cut_digests(window: int, groups, id: str):
    """Task function: answered blocks -> what was removed from each document."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                texts, _ = open_block(row)
                masks = removed_words(texts, row["answers"] or [], window, groups.value)
                rest = pa.ipc.open_stream(unsqueeze(row["rest"])).read_all()
                digests = [hashlib.sha256(kept_words(t, m)).hexdigest() for t, m in zip(texts, masks)]
                yield pa.RecordBatch.from_arrays([
                    rest.column(id).combine_chunks() if rest.num_rows else pa.array([], rest.schema.field(id).type), pa.array([len(m) for m in masks], pa.int64()),
                    pa.array([int(m.sum()) for m in masks], pa.int64()), pa.array(digests, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])
    return run


def cut_documents(window: int, groups, columns: list[str]):
    """Task function: answered blocks -> documents with the repeats cut out, without emptied ones."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                texts, lengths = open_block(row)
                masks = removed_words(texts, row["answers"] or [], window, groups.value)
                rest = pa.ipc.open_stream(unsqueeze(row["rest"])).read_all()
                new = [None if n < 0 else kept_text(t, m) if m.any() else t for t, m, n in zip(texts, masks, lengths.tolist())]
                whole = rest.append_column("text", pa.array([None if t is None else t.decode() for t in new], pa.string()))
                yield from whole.filter(pa.array([not (len(m) and m.all()) for m in masks])).select(columns).combine_chunks().to_batches()
    return run


def answered_blocks(docs: DataFrame, window: int, most: int) -> tuple[DataFrame, object]:
    """Blocks of ``docs`` (columns ``doc_id``, ``text`` and others) with the groups' answers."""
    spark = docs.sparkSession
    buckets = shuffle_partitions(spark)
    order = "order" + "_" * (1 + max(map(len, docs.columns)))  # a name that no column has
    ordered = docs.withColumn(order, F.col("doc_id").cast("long"))
    blocks = stage(ordered.mapInArrow(gather(window, order), "block long, ids binary, lengths binary, texts binary, rest binary, counts array<long>"), "repeat-blocks", "uncompressed")
    sums = blocks.select(F.posexplode("counts").alias("cell", "n")).groupBy("cell").agg(F.sum("n").alias("n")).collect()  # 12,288 rows
    counts = np.zeros(len(PREFIX_WORDS) * CELLS, np.int64)
    counts[[r["cell"] for r in sums]] = [r["n"] for r in sums]
    groups = spark.sparkContext.broadcast(Groups(counts, buckets, most))
    texts = blocks.select("block", "ids", "lengths", "texts")

    def by_block(rows):
        return rows.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers"))
    deep = stage_and_release(by_block(
        texts.mapInArrow(send_suffixes(window, groups), "block long, bucket int, paths binary")
        .repartition(buckets, "bucket").mapInArrow(answer_deep, "block long, bucket int, bits binary")), "repeat-deep")
    answers = stage_and_release(by_block(
        texts.join(deep, "block").mapInArrow(send_deep(window, groups), "block long, bucket int, n long, deep binary, paths binary, checks binary, docs binary, index binary")
        .repartition(buckets, "bucket").mapInArrow(answer_groups, "block long, bucket int, bits binary")), "repeat-answers")
    return blocks.select("block", "lengths", "texts", "rest").join(answers, "block", "left"), groups


def repeated_words(docs: DataFrame, window: int = WINDOW_WORDS, most: int = GROUP_SUFFIXES) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks, groups = answered_blocks(docs.select("doc_id", "text"), window, most)
    return blocks.mapInArrow(cut_digests(window, groups, "doc_id"), f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = WINDOW_WORDS, most: int = GROUP_SUFFIXES) -> DataFrame:
    """The documents, all columns, with repeats cut out of the text; emptied documents go."""
    blocks, groups = answered_blocks(docs, window, most)
    return blocks.mapInArrow(cut_documents(window, groups, docs.columns), docs.schema)


def query(spark, sf_dir):
    return repeated_words(table(spark, sf_dir, "documents", "doc_id", "text"))


def pipeline_stage(spark, docs, sf_dir):
    """Repeated passages are cut out of the texts."""
    out = remove_repeats(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, unnest(list_transform(range(1, len(w) - 18), lambda i: array_to_string(w[i:i + 19], ' '))) AS g FROM w WHERE len(w) >= 20),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM g),
p AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM r WHERE k > 1),
d AS (SELECT doc_id, list(p) AS gone FROM p GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(gone, []), i)), ' '), '')) AS kept_sha256
FROM w LEFT JOIN d USING (doc_id)
"""
