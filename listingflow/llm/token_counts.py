"""Token counts: pieces are counted once per distinct pre-token, joined to each document's
pre-token frequencies and summed; no id is ever materialised.

1. One pass cuts texts into pre-tokens.  A block of documents keeps its frequencies
   ``(document, pre-token, times)`` and lists its distinct pre-tokens by hash bucket.
2. The distinct lists are shuffled by bucket, so all sightings of a pre-token meet in one task,
   which counts its pieces once and answers each list with numbers in the same order.
3. The answers go back to their block, where frequencies times pieces are summed per document.

A pre-token is listed once per block however often it occurs, so a hot word or a hot group of
copies adds nothing to any bucket.  Memory in a task is one block, or one bucket's pre-tokens.

Edge cases: a null text counts as empty (0 bytes, 0 tokens); a null id is returned as null;
repeated rows each give a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (in_blocks, partition_id, ragged, shuffle_partitions, squeeze, squeeze_sorted, stage, table,
                     unsqueeze, unsqueeze_sorted, word_hashes, Ids, U64)
from .tokens import encoder

LIMIT_TOKENS = 2048


def block_frequencies(path: str, buckets: int):
    """Task function: documents -> one row per block with frequencies and distinct pre-tokens."""
    def run(batches):
        cut = encoder(path).chunks
        for number, (rows, texts) in enumerate(in_blocks(batches, "text")):
            ids = Ids()
            parts = [cut(t) for t in texts]
            lengths = np.array([len(p) for p in parts], np.int64)
            codes = np.fromiter(map(ids.__getitem__, chain.from_iterable(parts)), np.int64, int(lengths.sum()))
            words = list(ids)
            bucket = (word_hashes(words) % U64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            size = max(1, len(words))
            pairs, times = np.unique(np.repeat(np.arange(len(texts)), lengths) * size + rank[codes], return_counts=True)
            used, first, many = np.unique(bucket[order], return_index=True, return_counts=True)
            lists = []
            for b, i, n in zip(used.tolist(), first.tolist(), many.tolist()):
                part = [words[j] for j in order[i:i + n]]
                lists.append({"bucket": b, "lengths": squeeze(np.array([len(w) for w in part], np.uint32)),
                              "words": squeeze(b"".join(part))})
            yield pa.RecordBatch.from_arrays([
                pa.array([(partition_id() << 32) + number], pa.int64()),
                ragged_ids(rows.column("doc_id"), len(texts)),
                ragged(np.array([len(t) for t in texts], np.int64), np.array([len(texts)])),
                pa.array([len(words)], pa.int64()),
                pa.array([squeeze_sorted(pairs.astype(np.uint64))], pa.binary()),
                pa.array([squeeze(times.astype(np.uint32))], pa.binary()),
                pa.array([lists], pa.list_(pa.struct([("bucket", pa.int32()), ("lengths", pa.binary()), ("words", pa.binary())]))),
            ], names=["block", "doc_ids", "n_bytes", "n_words", "pairs", "times", "lists"])
    return run


def ragged_ids(column: pa.ChunkedArray, n: int) -> pa.ListArray:
    """All ids of a block as one list value, nulls kept."""
    return pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.concat_arrays(column.chunks))


def split_words(lengths: bytes, words: bytes) -> list[bytes]:
    ends = np.cumsum(unsqueeze(lengths, np.uint32)).tolist()
    raw = unsqueeze(words)
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def count_pieces(path: str):
    """Task function: lists of distinct pre-tokens -> number of pieces of each, in order."""
    def run(batches):
        tokenizer = encoder(path)
        known: dict[bytes, int] = {}
        for batch in batches:
            answers = []
            for lengths, words in zip(batch.column("lengths").to_pylist(), batch.column("words").to_pylist()):
                part = split_words(lengths, words)
                new = [w for w in part if w not in known]
                for i in range(0, len(new), 5000):
                    known.update(zip(new[i:i + 5000], map(len, tokenizer.pieces(new[i:i + 5000]))))
                answers.append(squeeze(np.array([known[w] for w in part], np.uint32)))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("bucket"), pa.array(answers, pa.binary())],
                                             names=["block", "bucket", "pieces"])
    return run


def sum_pieces(batches):
    """Task function: block frequencies with their answers -> tokens per document."""
    for batch in batches:
        for row in batch.to_pylist():
            answers = sorted(row["answers"] or [], key=lambda a: a["bucket"])
            pieces = np.concatenate([unsqueeze(a["pieces"], np.uint32) for a in answers] or [np.empty(0, np.uint32)]).astype(np.float64)
            n = len(row["doc_ids"])
            tokens = np.zeros(n, np.int64)
            if row["n_words"]:
                doc, word = np.divmod(unsqueeze_sorted(row["pairs"], np.uint64).astype(np.int64), row["n_words"])
                tokens = np.bincount(doc, weights=unsqueeze(row["times"], np.uint32) * pieces[word], minlength=n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type),
                                              pa.array(row["n_bytes"], pa.int64()), pa.array(tokens)],
                                             names=["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", limit: int = LIMIT_TOKENS) -> DataFrame:
    """Tokens of every document under the tokenizer file ``path`` (a ``tokenizers`` JSON).

    Returns ``doc_id, n_bytes, n_tokens, over_limit``, one row per input row.
    """
    spark = docs.sparkSession
    docs = docs.select(docs[id].alias("doc_id"), docs[text].alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    buckets = shuffle_partitions(spark)
    blocks = stage(docs.mapInArrow(
        block_frequencies(path, buckets),
        f"block long, doc_ids array<{kind}>, n_bytes array<long>, n_words long, pairs binary, times binary, "
        "lists array<struct<bucket:int,lengths:binary,words:binary>>"), "token-count-blocks")
    answers = (blocks.select("block", F.explode("lists").alias("part")).select("block", "part.*")
               .repartition(buckets, "bucket")
               .mapInArrow(count_pieces(path), "block long, bucket int, pieces binary")
               .groupBy("block").agg(F.collect_list(F.struct("bucket", "pieces")).alias("answers")))
    return (blocks.drop("lists").join(answers, "block", "left")
            .mapInArrow(sum_pieces, f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))


def query(spark, sf_dir):
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
