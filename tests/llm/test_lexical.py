"""Ranked search against scoring every pair, bounds and blocks, and its edge cases."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from listingflow.llm import lexical
from listingflow.llm.common import table

from . import reference as ref

SF = "/root/testdata/sf0.01"


def brute(docs, items, most=50):
    """Per item ``(item_id, rank, doc_id, score)``, all pairs scored."""
    bags = [(i, Counter(ref.NORMAL.findall(ref.lower(t or "")))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n, words = len(bags), sum(s for *_, s in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item, text in items:
        terms = set(ref.NORMAL.findall(ref.lower(text or "")))
        scored = []
        for i, bag, size in bags:
            m = 50 + (50 * size * n) // words
            score = sum(weight[t] * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in terms if bag[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, k, None if none else i, -score) for k, (score, none, i) in enumerate(sorted(scored)[:most], 1)]
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_given_tables_equal_brute_force(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents", "doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, SF, "benchmark", "item_id", "text").collect()]
    assert rows_of(lexical.query(spark, SF)) == sorted(brute(docs, items), key=str)


ITEMS = [(1, "the zebra naïve 中文"), (1, "alpha beta gamma"), (2, "the zebra naïve 中文"), (3, None), (4, "  ,, "), (5, "nowhere-to-be found1"), (None, "pass7 pass8 the the"), (6, "same ONE w" + "w" * 4999)]


@pytest.mark.parametrize("small", [False, True])
def test_awkward_rows(spark, monkeypatch, small):
    if small:  # many shards, many blocks, two groups of items
        monkeypatch.setattr(lexical, "SHARD_DOCUMENTS", 16)
        monkeypatch.setattr(lexical, "BLOCK_DOCUMENTS", 2)
        monkeypatch.setattr(lexical, "FIRST_DOCUMENTS", 10)
    rows = [(i, t, *rest) for i, t, *rest in ref.awkward_documents()]
    docs = spark.createDataFrame(rows, ref.DOCUMENT_SCHEMA).selectExpr("*", "1 AS term", "2 AS tf", "3 AS n", "4 AS shard", "5 AS item").repartition(3)
    items = spark.createDataFrame([(*i, 0, 0) for i in ITEMS], "item_id long, text string, item long, doc_id long")
    got = lexical.rank_documents(docs, items, most=5 if small else 50, most_item_bytes=40 if small else 1 << 20)
    assert rows_of(got) == sorted(brute([r[:2] for r in rows], ITEMS, 5 if small else 50), key=str)
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    none = items.filter("item_id = 99")
    assert lexical.rank_documents(docs, none).collect() == [] and lexical.rank_documents(docs.filter("doc_id = 99"), items).collect() == []


def shard_of(rng, n_docs=600, n_terms=80):
    weights = rng.integers(1, 9000, n_terms)
    weights[3] = 0
    lengths = rng.integers(1, 20, n_docs)
    topic = rng.integers(0, 8, n_docs)
    term = [np.sort(rng.choice(np.arange(k * 10, k * 10 + 30) % n_terms, s, replace=False)) for k, s in zip(topic, lengths)]
    shard = lexical.Shard(rng.permutation(n_docs).astype(np.int64), np.concatenate(term).astype(np.int32), rng.integers(1, 10 ** 6, lengths.sum()).astype(np.float32), lengths, n_terms)
    shard.cluster(weights)
    return shard, weights


def test_blocks_cover_every_list_and_bound_every_document():
    rng = np.random.default_rng(3)
    shard, weights = shard_of(rng)
    full = shard.matrix()
    ends = np.cumsum(shard.sizes)
    for t in range(shard.n_terms):
        blocks = np.flatnonzero(shard.block_terms == t)
        listed = np.concatenate([shard.members[ends[b] - shard.sizes[b]:ends[b]] for b in blocks] or [np.zeros(0, int)])
        assert sorted(listed) == (np.flatnonzero(full[:, t]).tolist() if weights[t] else [])
        for b in blocks:
            top = full[shard.members[ends[b] - shard.sizes[b]:ends[b]]].max(axis=0).astype(np.int64)
            assert (shard.tops[b] == -(-top // lexical.STEP)).all()


def test_search_is_exact_and_skips_blocks():
    rng = np.random.default_rng(4)
    shard, weights = shard_of(rng, 3000)
    full = shard.matrix()
    read = there = 0
    for number in range(40):
        terms = np.sort(rng.choice(shard.n_terms, 6, replace=False))
        terms = terms[weights[terms] > 0]
        scores = full[:, terms].astype(np.int64) @ weights[terms]
        want = sorted((-s, i) for s, i in zip(scores.tolist(), shard.ids.tolist()) if s > 0)[:10]
        for needed in (1, -want[-1][0]):  # ties with the needed score stay
            (got, ids), blocks = lexical.search_shard(shard, full, lexical.Query(number, terms, weights[terms], needed), (np.zeros(0), np.zeros(0, np.int64)), 10)
            assert [(-int(s), i) for s, i in zip(got, ids.tolist())] == want
        read, there = read + blocks, there + int(np.isin(shard.block_terms, terms).sum())
    assert read < 0.5 * there


def test_near_documents_share_blocks():
    rng = np.random.default_rng(5)
    shard, weights = shard_of(rng, 3000)
    alike = shard.tops.astype(bool).sum(axis=1).mean()
    by_chance = []
    full, ends = shard.matrix(), np.cumsum(shard.sizes)
    for b in range(len(shard.sizes)):
        listed = np.flatnonzero(full[:, shard.block_terms[b]])
        by_chance.append(full[rng.choice(listed, shard.sizes[b], replace=False)].max(axis=0).astype(bool).sum())
    assert alike < 0.95 * np.mean(by_chance) and ends[-1] == len(shard.members)
