"""Ranked lexical search over posting lists in geometric blocks with exact bounds.

The documents are weighed for the terms that the items hold (``vectors``): one pass over the texts
counts every document's terms, and Spark sums what the weights need (documents, terms, documents
per term).  Every task cuts its documents into shards; within a shard every term's posting list
is cut into blocks of documents that lie close together (each posting goes to the nearest of
evenly spaced documents of the list, by a random projection of the weighed terms), and a block
keeps the coordinatewise maximum of its documents' impacts (one byte each, rounded up).  A shard's
blocks stay in its task's memory until all items are answered.

``search`` takes an item's terms from the heaviest on.  A block of a term's list is bounded by the
weights times its maximum over that term and the lighter ones alone: its documents that hold a
heavier term stand in that term's list, where the bound counts them in full.  Blocks are read best
bound first until enough documents are known, then all others whose bound reaches the score
that the last of the best needs; blocks below it are skipped.  Bounds and scores are exact integers
below 2^53, and a bound is never below a score, so no document is lost, ties included.  The needed score starts from a search of a few documents (the
best 50 of any part bound those of the whole from below), so most blocks of the others are skipped.

Items are taken in groups of about ``MOST_ITEM_BYTES`` of text, by a hash of their row; a group's
terms are what is broadcast.

Edge cases: null and empty texts hold no term and are never found; every benchmark row is an item of
its own, also with an id or a text that others have; items without terms, or whose terms no document
holds, give no rows; repeated documents are ranked each; null ids come after all others in ties; a
term that nearly every document holds can weigh 0 and then counts for nothing; empty tables give no
rows; other columns are ignored.  Ids must be integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listingflow.session import ship_package

from .common import in_blocks, ragged, stage, table
from .decontam import words_of

BEST = 50
#: Items of one group hold about this much text.
MOST_ITEM_BYTES = 256 << 10
#: Documents of a shard, as many as fit a matrix of that size with a column per term.
SHARD_DOCUMENTS, SHARD_BYTES = 4096, 32 << 20
#: Impacts are below 10^6; a block's maximum is kept in 255 steps, rounded up, so that it still bounds.
STEP = -(-1_000_000 // 255)
#: Shards that one task builds, documents of a block on average, coordinates of the projection.
TASK_SHARDS, BLOCK_DOCUMENTS, PROJECTION = 4, 32, 24
#: About so many documents, in so many tasks, give the first needed scores.
FIRST_DOCUMENTS, FIRST_TASKS = 8192, 4
NO_ID = np.iinfo(np.int64).max


# ------------------------------------------------------------------ documents as vectors
def vectors(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, term, tf`` per document with a term: all its terms, and those of ``terms`` with their counts; staged."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        get, wide = shared.value.get, max(1, len(shared.value))
        for rows, texts in in_blocks(batches, "text"):
            counts, known, place = [], [], []
            for i, text in enumerate(texts):
                words = words_of(text)
                counts.append(len(words))
                found = [c for c in map(get, words) if c is not None]
                known.extend(found)
                place.append(len(found))
            codes = np.repeat(np.arange(len(texts), dtype=np.int64), place) * wide + np.array(known, np.int64)
            pairs, tf = np.unique(codes, return_counts=True)
            lengths = np.bincount(pairs // wide, minlength=len(texts))
            some = pa.array(np.array(counts) > 0)
            out = pa.table([pa.chunked_array(rows.column("doc_id").chunks), pa.array(counts, pa.int64()),
                            ragged((pairs % wide).astype(np.int32), lengths), ragged(tf.astype(np.int32), lengths)], names=["doc_id", "n", "term", "tf"])
            yield from out.filter(some).to_batches()
    return stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, term array<int>, tf array<int>"), "lexical-vectors")


def term_documents(rows: DataFrame, n_terms: int) -> np.ndarray:
    """Documents per term, added up inside the tasks first."""
    def run(batches):
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["term", "df"])
    out = np.zeros(n_terms, np.int64)
    for r in rows.select("term").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) if f else 0 for f in df.tolist()], np.int64)


# ------------------------------------------------------------------ index
class Shard:
    """Documents of a shard, their impacts, and the posting blocks of every term."""

    def __init__(self, ids: np.ndarray, term: np.ndarray, impact: np.ndarray, lengths: np.ndarray, n_terms: int):
        self.ids, self.term, self.impact, self.lengths, self.n_terms = ids, term, impact, lengths, n_terms

    def matrix(self) -> np.ndarray:
        """Impacts as documents x terms: below 10^6, so exact."""
        out = np.zeros((len(self.ids), self.n_terms), np.float32)
        out[np.repeat(np.arange(len(self.ids)), self.lengths), self.term] = self.impact
        return out

    def cluster(self, weights: np.ndarray) -> None:
        """Cut every posting list into blocks of near documents and keep each block's maximum."""
        full = self.matrix()
        turn = np.random.default_rng(self.n_terms).normal(size=(self.n_terms, PROJECTION)).astype(np.float32)
        near = full @ (turn * weights[:, None].astype(np.float32))
        near /= np.maximum(np.linalg.norm(near, axis=1, keepdims=True), 1e-30)
        full = np.ceil(full / STEP).astype(np.uint8)
        doc = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.lengths)
        order = np.argsort(self.term, kind="stable")
        edges = np.searchsorted(self.term[order], np.arange(self.n_terms + 1))
        members, sizes, terms, tops = [], [], [], []
        for t in np.flatnonzero((np.diff(edges) > 0) & (weights > 0)).tolist():
            listed = doc[order[edges[t]:edges[t + 1]]]
            k = -(-len(listed) // BLOCK_DOCUMENTS)
            if k > 1:
                centres = near[listed[np.linspace(0, len(listed) - 1, k).astype(np.int64)]]
                block = (near[listed] @ centres.T).argmax(axis=1)
                by = np.argsort(block, kind="stable")
                listed, starts = listed[by], np.flatnonzero(np.diff(block[by], prepend=-1))
            else:
                starts = np.zeros(1, np.int64)
            tops.append(np.maximum.reduceat(full[listed], starts, axis=0))
            members.append(listed)
            sizes.append(np.diff(np.append(starts, len(listed))))
            terms.append(np.full(len(starts), t, np.int32))
        self.members = np.concatenate(members) if members else np.zeros(0, np.int32)
        self.sizes = np.concatenate(sizes).astype(np.int32) if sizes else np.zeros(0, np.int32)
        self.block_terms = np.concatenate(terms) if terms else np.zeros(0, np.int32)
        self.tops = np.concatenate(tops) if tops else np.zeros((0, self.n_terms), np.uint8)


def shards_of(batches, weights: np.ndarray, n_docs: int, n_words: int, most: int) -> Iterator[Shard]:
    """A task's ``vectors`` rows as indexed shards of at most ``most`` documents."""
    parts: list = []
    held = 0

    def close():
        ids, n, term, tf, lengths = (np.concatenate([p[i] for p in parts]) for i in range(5))
        m = 50 + (50 * n * n_docs) // n_words
        impact = (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, lengths))
        shard = Shard(ids, term, impact.astype(np.float32), lengths, len(weights))
        shard.cluster(weights)
        return shard
    for batch in batches:
        begin = 0
        while begin < batch.num_rows:
            part = batch.slice(begin, most - held)
            lengths = part.column("term").value_lengths().to_numpy(zero_copy_only=False)
            parts.append((part.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False), part.column("n").to_numpy(), part.column("term").flatten().to_numpy(),
                          part.column("tf").flatten().to_numpy().astype(np.int64), lengths))
            begin, held = begin + part.num_rows, held + part.num_rows
            if held == most:
                yield close()
                parts, held = [], 0
    if held:
        yield close()


# ------------------------------------------------------------------ search
class Query:
    """An item's terms from the heaviest on, their weights, and the score that a document needs."""

    def __init__(self, number: int, terms: np.ndarray, weights: np.ndarray, needed: int = 1):
        order = np.argsort(-weights, kind="stable")
        self.number, self.terms, self.weights, self.needed = number, terms[order], weights[order].astype(np.float64), needed


def best_of(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Positions of the best: highest score, then smallest id."""
    return np.lexsort((ids, -scores))[:most]


def search_shard(shard: Shard, full: np.ndarray, query: Query, known: tuple[np.ndarray, np.ndarray], most: int) -> tuple[tuple[np.ndarray, np.ndarray], int]:
    """The item's best ``(scores, ids)`` among those known and the shard's; and how many blocks were read."""
    mine = np.flatnonzero(np.isin(shard.block_terms, query.terms))
    place = np.zeros(shard.n_terms, np.int64)
    place[query.terms] = np.arange(len(query.terms))
    most_each = shard.tops[np.ix_(mine, query.terms)] * (query.weights * STEP)
    bounds = np.cumsum(most_each[:, ::-1], axis=1)[np.arange(len(mine)), len(query.terms) - 1 - place[shard.block_terms[mine]]]
    ends = np.cumsum(shard.sizes)
    scores, ids = known
    needed = max(query.needed, scores[-1] if len(scores) == most else 0)
    seen = np.zeros(len(shard.ids), bool)
    read = 0
    ahead = np.argsort(-bounds, kind="stable")
    ahead = ahead[bounds[ahead] >= needed]
    first = int(np.searchsorted(np.cumsum(shard.sizes[mine[ahead]]), 2 * most)) + 1
    for part in (ahead[:first], ahead[first:]):
        part = part[bounds[part] >= needed]
        if not len(part):
            continue
        read += len(part)
        blocks = mine[part]
        docs = np.unique(np.concatenate([shard.members[ends[b] - shard.sizes[b]:ends[b]] for b in blocks.tolist()]))
        docs = docs[~seen[docs]]
        seen[docs] = True
        got = full[np.ix_(docs, query.terms)].astype(np.float64) @ query.weights
        enough = got >= needed
        scores, ids = np.concatenate([scores, got[enough]]), np.concatenate([ids, shard.ids[docs[enough]]])
        keep = best_of(scores, ids, most)
        scores, ids = scores[keep], ids[keep]
        if len(scores) == most:
            needed = max(needed, scores[-1])
    return (scores, ids), read


def shard_size(n_terms: int) -> int:
    return max(64, min(SHARD_DOCUMENTS, SHARD_BYTES // (4 * max(1, n_terms))))


def search(rows: DataFrame, queries: list[Query], weights: np.ndarray, n_docs: int, n_words: int, most: int = BEST) -> DataFrame:
    """``item, doc_id, score``: each task's best documents that reach what the queries need.

    A task indexes its ``vectors`` rows shard by shard and answers all queries on each.
    """
    shared = rows.sparkSession.sparkContext.broadcast((queries, weights))
    size = shard_size(len(weights))

    def run(batches):
        queries, weights = shared.value
        best = {q.number: (np.zeros(0), np.zeros(0, np.int64)) for q in queries}
        for shard in shards_of(batches, weights, n_docs, n_words, size):
            full = shard.matrix()
            for q in queries:
                best[q.number], _ = search_shard(shard, full, q, best[q.number], most)
        for number, (scores, ids) in best.items():
            if len(scores):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), number, np.int64)), pa.array(ids, mask=ids == NO_ID),
                                                  pa.array(scores.astype(np.int64))], names=["item", "doc_id", "score"])
    return rows.mapInArrow(run, "item long, doc_id long, score long")


def ranked(found: DataFrame, most: int) -> DataFrame:
    """``found`` cut to every item's best with their ``rank``; first within parts, so that no item is one task."""
    by = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(16))
    first = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*by))).filter(F.col("rank") <= most)
    return first.drop("part").withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*by))).filter(F.col("rank") <= most)


def item_groups(items: DataFrame, most_bytes: int) -> Iterator[list[tuple]]:
    """Groups of ``(id, text)``, each with about ``most_bytes`` of text."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // most_bytes)
    numbered = items.filter(F.length("text") > 0).withColumn("group", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, n))))
    for g in range(n):
        yield [(r["item_id"], r["text"].encode()) for r in numbered.filter(F.col("group") == g).select("item_id", "text").collect()]


def rank_documents(docs: DataFrame, items: DataFrame, most: int = BEST, most_item_bytes: int = MOST_ITEM_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: every item's highest-scoring documents."""
    spark = docs.sparkSession
    ship_package(spark)
    kind = items.schema["item_id"].dataType
    schema = f"item_id {kind.simpleString()}, rank int, doc_id long, score long"
    out = None
    for group in item_groups(items.select("item_id", "text"), most_item_bytes):
        terms: dict[bytes, int] = {}
        for _, text in group:
            for w in words_of(text):
                terms.setdefault(w, len(terms))
        if not terms:
            continue
        rows = vectors(docs, terms)
        n_docs, n_words = rows.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        weights = term_weights(term_documents(rows, len(terms)), n_docs)
        queries = []
        for number, (_, text) in enumerate(group):
            mine = np.array(sorted({terms[w] for w in words_of(text)}), np.int64)
            mine = mine[weights[mine] > 0]
            if len(mine):
                queries.append(Query(number, mine, weights[mine]))
        if not queries:
            continue
        part = rows.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(-(-n_docs // FIRST_DOCUMENTS))) == 0).repartition(FIRST_TASKS)
        first = ranked(search(part, queries, weights, n_docs, n_words, most), most)
        needed = {r["item"]: r["score"] for r in first.filter(F.col("rank") == most).select("item", "score").collect()}
        for q in queries:
            q.needed = max(1, needed.get(q.number, 1))
        # neighbours share a task, so that shards are full however the rows are cut; nothing is shuffled
        tasks = max(1, -(-n_docs // (shard_size(len(terms)) * TASK_SHARDS)))
        found = ranked(search(rows.coalesce(tasks), queries, weights, n_docs, n_words, most), most)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(group)], f"item long, item_id {kind.simpleString()}")
        part = stage(found.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "lexical-ranked")
        out = part if out is None else out.union(part)
    return spark.createDataFrame([], schema) if out is None else out


def query(spark, sf_dir):
    return rank_documents(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
dn AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, w FROM d WHERE len(w) > 0),
s AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS l FROM dn),
p AS (SELECT r, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS t FROM dn) x GROUP BY r, t),
i AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
it AS (SELECT DISTINCT q, item_id, t FROM (SELECT q, item_id, unnest(w) AS t FROM i) x),
df AS (SELECT t, count(*) AS f FROM p GROUP BY t),
wt AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * f + 1))) AS BIGINT) AS wt FROM df, s),
m AS (SELECT r, doc_id, 50 + (50 * n * nn) // l AS m FROM dn, s),
sc AS (SELECT it.q, it.item_id, m.doc_id, m.r, CAST(sum(wt.wt * ((1000000000 * p.tf) // (1000 * p.tf + 20 * m.m))) AS BIGINT) AS score
       FROM it JOIN p USING (t) JOIN wt USING (t) JOIN m ON m.r = p.r GROUP BY it.q, it.item_id, m.doc_id, m.r),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM sc WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 50
"""
