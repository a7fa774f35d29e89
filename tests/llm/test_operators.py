"""Every operator against brute force on awkward documents and on a small given table."""

from __future__ import annotations

import math
import os
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from listingflow.llm import brown, common, components, decontam, jaccard_join, packing, quality, sharding, substring, token_counts, tokens, warc, wavelet
from listingflow.llm.common import stage_path, squeeze_sorted, table, unsqueeze_sorted

from . import reference as ref

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


@pytest.fixture(scope="module")
def rows():
    return ref.awkward_documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, ref.DOCUMENT_SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], ref.DOCUMENT_SCHEMA)


@pytest.fixture(scope="module")
def given(spark):
    return [(r[0], r[1]) for r in table(spark, SF, "documents", "doc_id", "text").collect()]


# ------------------------------------------------------------------ shared pieces
@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_encoder_equals_the_library(path, rows, given):
    texts = [t or "" for _, t, *_ in rows] + [t or "" for _, t in given]
    library = Tokenizer.from_file(path)
    ids, lengths = tokens.Encoder(path).encode([t.encode() for t in texts])
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert lengths.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_encoder_equals_the_library_on_20000_fuzzed_texts(path):
    rng = random.Random(11)
    pieces = ["W", "H", "a", "E", "The", "word", "9", ".", "'s", "=", "<|", "|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|endoftext|>", "<|STARTOFTEXT|>", "endoftext", " ", "  ", "\n", "\t", "\x00", "\x1c", "\x85",
              "\u030a", "\u0331", "\u0301", "\u0327", "\u0338", "\u212a", "\u037e", "é", "E\u0301", "中文", "ß", "İ", "\u00a0", "\u3000", "\u200d", "😀", "ﬁ", "Å", "!!", "--", "_", "@"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9))) for _ in range(20_000)]
    library = Tokenizer.from_file(path)
    encoder = tokens.Encoder(path)
    for begin in range(0, len(texts), 2000):
        part = texts[begin:begin + 2000]
        ids, lengths = encoder.encode([t.encode() for t in part])
        ids, ends = ids.tolist(), np.cumsum(lengths).tolist()
        for text, a, b, want in zip(part, [0, *ends], ends, library.encode_batch(part, add_special_tokens=False)):
            assert ids[a:b] == want.ids, repr(text)


def test_sorted_numbers_round_trip():
    for n in (0, 1, 1000):
        a = np.sort(np.random.default_rng(1).integers(0, 1 << 63, n, dtype=np.uint64))
        assert (unsqueeze_sorted(squeeze_sorted(a), np.uint64) == a).all()


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {}
    for a, b in edges:
        x, y = label.setdefault(a, {a}), label.setdefault(b, {b})
        if x is not y:
            x |= y
            for n in y:
                label[n] = x
    assert got == {n: min(s) for n, s in label.items() if n != min(s)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ 1 WARC
def test_warc_round_trip(spark):
    long = "é<p>" + "x" * 40_000 + "\r\n\r\nWARC/1.1\r\n" + "y" * 9000
    pages = [(3, "http://a/1", "same"), (1, "http://a/2", "same"), (1, "http://a/2", "same"), (2, None, None), (4, "http://a/ü\r\nx", ""), (5, "u", long),
             (6, "u", long), (None, "u", "only"), (None, "u", "same"), (7, "u", "0\r\n\r\n")]
    folder = stage_path(spark, "warc-test")
    warc.write_warc(spark.createDataFrame([(*p, 0) for p in pages], "page_id long, url string, html string, digest int"), folder)
    got = [tuple(r) for r in warc.read_warc(spark, folder).collect()]
    least = {}
    for p, _, h in pages:
        if p is not None:
            least[h or ""] = min(p, least.get(h or "", p))
    assert Counter((p, b, d) for p, b, d, *_ in got) == Counter((p, len((h or "").encode()), ref.sha1_base32((h or "").encode())) for p, _, h in pages)
    assert all(problem is None for *_, problem in got)
    for digest in {g[2] for g in got}:
        group = [g for g in got if g[2] == digest]
        assert [g[3] for g in group].count("response") == 1
        first = next(g for g in group if g[3] == "response")
        assert all(g[4] == (first[0] if g[3] == "revisit" else None) for g in group)
    assert {g[0] for g in got if g[3] == "response"} == {1, 2, 5, 7, None}
    records = [(h, b) for f in spark.read.format("binaryFile").load(folder).collect() for h, b in warc.parse(bytes(f.content))]
    assert sum(h["warc-type"] == "continuation" for h, _ in records) >= 3


def test_warc_damage_is_named(spark):
    block = warc._HTTP + warc.frame(b"z" * 9000)
    base = {"origin": "o", "page_id": 1, "total": len(block), "digest": warc.digest32(b"z" * 9000)}

    def read(segments, **change):
        import pyarrow as pa
        row = base | {"segments": segments} | change
        return list(warc.reassemble([pa.RecordBatch.from_pylist([row])]))[0].to_pylist()[0]
    whole = [{"segment": 1, "block": block[:5000]}, {"segment": 2, "block": block[5000:]}]
    assert read(whole) == {"record_id": "o", "page_id": 1, "payload_bytes": 9000, "payload_digest": base["digest"], "problem": None}
    assert read([whole[0], {"segment": 3, "block": block[5000:]}])["problem"] == "segments missing or repeated"
    assert read(whole[:1])["problem"] == "total length differs"
    assert read(whole, digest="X")["problem"] == "payload digest differs"
    assert read([{"segment": 1, "block": block[:-7]}], total=len(block) - 7)["problem"].startswith("framing")
    assert warc.write_warc is not None


def test_warc_least_bytes_and_empty(spark):
    folder = stage_path(spark, "warc-test")
    warc.write_warc(spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "long enough"), (4, "u", "long enough")], "page_id long, url string, html string"), folder, least_bytes=5)
    assert sorted((r.page_id, r.record_type) for r in warc.read_warc(spark, folder).collect()) == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]
    folder = stage_path(spark, "warc-test")
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.read_warc(spark, folder).count() == 0


# ------------------------------------------------------------------ 2 packing
def check_packed(got, ids, size=4096):
    full = Counter((d, ref.crc_ids(i)) for d, i in ids)
    by_sequence, by_doc = {}, Counter()
    for p in got:
        by_sequence.setdefault(p.sequence_id, []).append(p)
        by_doc[p.doc_id] += p.length
    total = sum(len(i) for _, i in ids)
    assert sum(by_doc.values()) == total
    want = Counter()
    for d, i in ids:
        want[d] += len(i)
    assert by_doc == want and full
    lengths = []
    for s in range(len(by_sequence)):
        at = 0
        for p in sorted(by_sequence[s], key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        lengths.append(at)
    assert all(n == size or n & (n - 1) == 0 for n in lengths) and sum(lengths) == total
    by_id = {}
    for d, i in ids:
        by_id.setdefault(d, []).append(i)
    for p in got:
        assert any(len(i) == p.doc_tokens and ref.crc_ids(i[p.start:p.start + p.length]) == p.ids_crc32 for i in by_id[p.doc_id])


def test_packing(spark, docs, rows, no_docs):
    library = Tokenizer.from_file(WORDS)
    ids = [(d, library.encode(t or "", add_special_tokens=False).ids + [2]) for d, t, *_ in rows]
    check_packed(packing.pack(docs, WORDS).collect(), ids)
    check_packed(packing.pack(docs, WORDS, weights={"a": 1, "b": 3}, size=128).collect(), ids, 128)
    assert packing.pack(no_docs, WORDS).count() == 0


def test_every_source_is_a_queue_of_its_own(spark):
    rows = [(i, "one two three", f"s{i:04d}") for i in range(1050)] + [(1050, "a", "zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = packing.pack(docs, WORDS, weights={"zz": 1, "s0000": 1}, size=64).collect()
    assert sum(r.length for r in got if r.source == "zz") == max(r.doc_tokens for r in got if r.source == "zz")
    assert {r.sequence_id for r in got if r.source in ("zz", "s0000")} == {0}  # the smallest source has its target too


def test_schedule_carries_deficits():
    totals = [100_000, 3, 41_234, 999]
    s = packing.Schedule(totals, size=512)
    for t in range(0, s.tokens, 512):
        assert sum(s.served(j, t) for j in range(4)) == t
        assert all(abs(s.deficit(j, t)) <= 1 for j in range(4))
    assert [s.served(j, s.tokens) for j in range(4)] == totals
    s = packing.Schedule(totals, [1, 1, 1, 0], size=512)
    assert [s.served(j, s.tokens) for j in range(4)] == totals
    assert s.served(0, 9) == s.served(1, 9) == s.served(2, 9) == 3  # equal shares until a queue is dry
    assert s.served(3, s.tokens - 2000) == 0  # no target: only at the end


# ------------------------------------------------------------------ 3 Brown classes
def test_brown_scores(spark, docs, rows, no_docs):
    got = brown.score_documents(docs, clustered_words=30, k=6, rounds=4).collect()
    token_lists = [(d, ref.WORD.findall(ref.lower(t or "")) + [" "]) for d, t, *_ in rows]
    train = [w for d, w in token_lists if not brown.held_out(d)]
    c = Counter(x for w in train for x in w)
    N, V = sum(c.values()), len(c)
    want = Counter()
    for d, w in token_lists:
        want[(d, brown.held_out(d), len(w), sum(c[x] > 0 for x in w), N, round(sum(math.log10((c[x] + 0.1) / (N + 0.1 * (V + 1))) for x in w), 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert brown.score_documents(no_docs).count() == 0


def test_brown_is_a_distribution_and_beats_the_base(spark, monkeypatch):
    made = []
    init = brown.Model.__init__
    monkeypatch.setattr(brown.Model, "__init__", lambda self, *a: (init(self, *a), made.append((self, a)))[0])
    got = brown.score_documents(table(spark, "/root/testdata/sf0.01", "documents", "doc_id", "text"), clustered_words=1000, k=16).collect()
    test = [r for r in got if r.held_out]
    assert sum(r.score for r in test) > sum(r.base_score for r in test)
    m, (_, classes, pairs, *_) = made[-1]
    assert np.allclose((10 ** m.transition).sum(axis=1), 1)
    # exchange only accepted classes that are no worse than where it began
    start = np.concatenate(([0], 1 + np.arange(len(classes) - 1) % 15))
    assert brown.information(pairs) > 0 or (classes != start).any()


def test_exchange_gain_is_the_change_of_information():
    rng = np.random.default_rng(5)
    n, k = 12, 4
    grams = rng.integers(0, 9, (n, n)).astype(float)
    classes = np.concatenate(([0], 1 + rng.integers(0, k - 1, n - 1)))

    def pairs_of(c):
        out = np.zeros((k, k))
        for i in range(n):
            for j in range(n):
                out[c[i], c[j]] += grams[i, j]
        return out
    for u in range(1, n):
        pairs = pairs_of(classes)
        right = np.bincount(classes, grams[u], minlength=k)
        left = np.bincount(classes, grams[:, u], minlength=k)
        b, gain = brown.best_class(pairs, classes[u], right, left, grams[u, u])
        tried = []
        for c in range(1, k):
            moved = classes.copy()
            moved[u] = c
            tried.append(brown.information(pairs_of(moved)) - brown.information(pairs))
        assert b == 1 + int(np.argmax(tried)) and gain == pytest.approx(max(tried))


def test_best_classes_of_many_units_are_those_of_each():
    rng = np.random.default_rng(6)
    n, k = 40, 5
    grams = rng.integers(0, 9, (n, n)) * (rng.random((n, n)) < 0.2).astype(float)
    classes = np.concatenate(([0], 1 + rng.integers(0, k - 1, n - 1)))
    member = np.eye(k)[classes]
    pairs, right, left = member.T @ grams @ member, grams @ member, grams.T @ member
    b, gain = brown.best_classes(pairs, classes[1:], right[1:], left[1:], grams.diagonal()[1:])
    want = [brown.best_class(pairs, classes[u], right[u], left[u], grams[u, u]) for u in range(1, n)]
    assert b.tolist() == [w for w, _ in want] and np.allclose(gain, [g for _, g in want])


def test_brown_clusters_every_word_above_the_floor(spark, monkeypatch):
    made = []
    init = brown.Model.__init__
    monkeypatch.setattr(brown.Model, "__init__", lambda self, *a: (init(self, *a), made.append((self, a)))[0])
    # 6,000 words of one shape, in two kinds that never stand at the same place, and one word seen once
    lines = [f"a {i:05d}x b {i:05d}y" for i in range(3000)] * 2 + ["a once b"]
    held = next(i for i in range(10 ** 6) if brown.held_out(i))
    train = [i for i in range(10 ** 6, 10 ** 6 + 9000) if not brown.held_out(i)]
    docs = spark.createDataFrame([*zip(train, lines), (held, "a unseen b 00007y")], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in brown.score_documents(docs, k=6).collect()}
    m = made[-1][0]
    assert len(m.classes) == brown.FIRST_WORD + 6002  # the vocabulary, not a fixed number, sets the units
    assert m.distinct == 6004 and m.tokens == 4 * 6000 + 3 + 6001
    assert got[held].held_out and got[held].n_known == 4
    assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())


# ------------------------------------------------------------------ 4 token counts
def test_token_counts(spark, docs, rows, no_docs):
    library = Tokenizer.from_file(WORDS)
    want = []
    for d, t, *_ in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), n, n > 100))
    same(token_counts.token_counts(docs, WORDS, limit=100).collect(), want)
    assert token_counts.token_counts(no_docs, WORDS).count() == 0


# ------------------------------------------------------------------ 5 decontamination
ITEMS = [(1, " ".join(f"Pass{i}" for i in range(30))), (2, "One, two: THREE"), (2, "One, two: THREE"), (3, None), (4, "!!!"), (None, "naïve alpha"), (10, "zebra"), (11, "same " * 12)]


def test_decontamination(spark, docs, rows, no_docs):
    items = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, doc_id int")
    want = ref.benchmark_hits([(d, t) for d, t, *_ in rows], ITEMS)
    same(decontam.mark_benchmark(docs, items).collect(), want)
    same(decontam.mark_benchmark(docs, items, most_bytes=1).collect(), want)
    clean = decontam.clean_documents(docs, items)
    assert clean.columns == docs.columns
    same(clean.select("doc_id").collect(), [(d,) for d, *_, hit in want if not hit])
    assert decontam.mark_benchmark(no_docs, items).count() == 0
    assert not any(r.contaminated for r in decontam.mark_benchmark(docs, items.limit(0)).collect())


def test_clean_documents_judges_each_row_whatever_its_id(spark):
    rows = [(None, "so zebra goes"), (None, "plain words"), (5, "a zebra"), (5, "no stripes"), (6, "nothing here"), (6, "nothing here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(i, t) for i, t in ITEMS], "item_id long, text string")
    want = [(d, t) for d, t in rows if "zebra" not in t]
    for most in (1, decontam.MOST_BROADCAST_BYTES):
        clean = decontam.clean_documents(docs, items, most_bytes=most)
        assert clean.columns == docs.columns
        same(clean.collect(), want)


def test_clean_documents_by_join_on_awkward_rows(docs, spark):
    items = spark.createDataFrame([(i, t) for i, t in ITEMS], "item_id long, text string")
    same(decontam.clean_documents(docs, items, most_bytes=1).collect(), decontam.clean_documents(docs, items).collect())


# ------------------------------------------------------------------ 6 Jaccard join
def test_near_duplicates_stage_keeps_one_row_of_each_group(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (2, a + " end"), (2, b), (None, a), (None, None), (None, ""), (4, c), (4, c), (None, b + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = jaccard_join.pipeline_stage(spark, docs, SF)
    assert out.columns == docs.columns
    same(out.collect(), [(1, a), (2, b), (None, None), (None, ""), (4, c)])


@pytest.mark.parametrize("size, similarity", [(4, 85), (5, 80), (2, 60)])
def test_jaccard_join(spark, docs, rows, size, similarity):
    want = ref.component_ids([(d, t) for d, t, *_ in rows], size, similarity)
    same(jaccard_join.link_documents(docs, size, similarity).collect(), want)
    same(jaccard_join.link_documents(docs, size, similarity, chunk_shingles=300).collect(), want)


def test_jaccard_join_with_hot_keys(spark, docs, rows, monkeypatch):
    from listingflow.llm.common import in_blocks
    import pyarrow as pa
    # two sets under a key are hot here; the task function is run as it is on the executors
    monkeypatch.setattr(jaccard_join, "HOT_IN_BLOCK", 2)
    texts = pa.RecordBatch.from_arrays([pa.array([t for _, t, *_ in rows], pa.string())], names=["text"])
    sent = list(jaccard_join.send_keys(4, 85, 3)(iter([texts.slice(0, 30), texts.slice(30)])))
    met = list(jaccard_join.meet(iter(sent)))
    got = pa.Table.from_batches(met).to_pylist()
    assert any(r["a"] is not None for r in got) and list(in_blocks(iter([texts]), "text"))
    about = {}
    for _, t, *_ in rows:
        s, = jaccard_join.shingle_sets([(t or "").encode()], 4)
        if len(s):
            about[int(jaccard_join.node_of(s).view(np.int64))] = (len(s), jaccard_join.bit_sketch(s), ref.shingles(t, 4))
    keyed = sorted((r for r in got if r["node"] is not None), key=lambda r: r["key"])
    batch = pa.RecordBatch.from_pylist([{"key": r["key"], "node": r["node"], "slack": r["slack"], "size": about[r["node"]][0], "sketch": about[r["node"]][1]} for r in keyed]) if keyed else None
    ties = [(r["a"], r["b"]) for r in got if r["a"] is not None]
    ties += [(t["a"], t["b"]) for b in jaccard_join.tie_keys(85)(iter([batch] if batch else [])) for t in b.to_pylist()]
    label = {n: n for n in about}

    def find(n):
        while label[n] != n:
            n = label[n]
        return n
    for a, b in ties:
        label[find(a)] = find(b)
    for a in about:
        for b in about:
            x, y = about[a][2], about[b][2]
            if 100 * len(x & y) >= 85 * len(x | y):
                assert find(a) == find(b)


def test_words_of_many_texts_at_once():
    rng = random.Random(3)
    texts = [b"", b" ", b"one", b"\x0b\tone  two\r\n", "ba\u00f1o \u3000 x".encode(), b"a\x00 a\x00\x00 a", b"x" * 63 + b" " + b"x" * 64 + b" " + b"x" * 65 + b" " + b"x" * 5000, b""]
    texts += [bytes(rng.choice(b"ab \t\x00\x1c\xc3") for _ in range(rng.randrange(60))) for _ in range(400)]
    found = common.Words(texts)
    words = [w for t in texts for w in t.split()]
    assert found.counts.tolist() == [len(t.split()) for t in texts] and found.lengths.tolist() == [len(w) for w in words]
    for seed in (0, 1):
        hashes = found.hashes(seed).tolist()
        assert len(set(zip(words, hashes))) == len(set(hashes)) == len(set(words))
    assert not set(found.hashes(0).tolist()) & set(found.hashes(1).tolist())
    for part in (texts, [], [b""]):
        hashes = common.Words(part).hashes()
        for got, length in zip(common.run_hashes(hashes, (1, 2, 3, 5, 10, 20, 33)), (1, 2, 3, 5, 10, 20, 33)):
            assert got.tolist() == common.window_hashes(hashes, length).tolist()


@pytest.mark.parametrize("segment", [1, 7, 1 << 16])
def test_windows_of_many_texts_by_segments(monkeypatch, segment):
    monkeypatch.setattr(common.Words, "SEGMENT", segment)
    rng = random.Random(4)
    for texts in ([], [b""], [" ".join(rng.choice("abc") for _ in range(rng.randrange(30))).encode() for _ in range(40)]):
        whole = [common.Words([t]).hashes() for t in texts]
        at, (two, five) = common.Words(texts).windows([2, 5], within=5)
        starts = np.cumsum([0] + [len(t.split()) for t in texts])
        assert at.tolist() == [s + i for s, h in zip(starts.tolist(), whole) for i in range(len(h) - 4)]
        assert two.tolist() == [x for h in whole for x in common.window_hashes(h, 2)[:max(0, len(h) - 4)].tolist()]
        assert five.tolist() == [x for h in whole for x in common.window_hashes(h, 5).tolist()]


def test_shingle_sets_of_many_texts():
    texts = [b"", b" ", b"a B c D", b"A b C d", b"a b c", b"A b  c ", b"a", b"a b c d a b c d a", b"d a b c"]
    sets = jaccard_join.shingle_sets(texts, 4)
    assert [len(s) for s in sets] == [len(ref.shingles(t.decode(), 4)) for t in texts]
    assert [set(s.tolist()) for s in sets] == [set(jaccard_join.shingle_sets([t], 4)[0].tolist()) for t in texts]
    assert sets[2].tolist() == sets[3].tolist() and sets[4].tolist() == sets[5].tolist() and set(sets[8].tolist()) < set(sets[7].tolist())
    assert len(jaccard_join.shingle_sets([], 4)) == 0


def test_a_leader_is_tied_to_whatever_links_with_a_follower():
    # sizes straddle 64 and 128, where sketches double their width
    rng, followed = np.random.default_rng(5), 0
    for trial in range(60):
        n = (66, 130)[trial % 2]
        base = rng.integers(0, 1 << 64, n, dtype=np.uint64)

        def near():
            kept = base[rng.permutation(n)[:n - rng.integers(0, n // 10)]]
            return np.unique(np.concatenate((kept, rng.integers(0, 1 << 64, rng.integers(0, n // 12), dtype=np.uint64))))
        known = {int(jaccard_join.node_of(s)): s for s in (near() for _ in range(40))}
        nodes = np.array(list(known), np.uint64)
        slack, ties = jaccard_join.thin(nodes, known, [jaccard_join.bit_sketch(known[n]) for n in known], 85, {})
        radius = dict(zip(nodes.tolist(), slack.tolist()))
        assert {a for a, _ in ties} == {n for n, r in radius.items() if r < 0} and all(radius[b] > 0 for _, b in ties)
        for other in (near() for _ in range(40)):
            for follower, leader in ties:
                f, lead = known[follower], known[leader]
                both = len(np.intersect1d(f, other))
                if 100 * both >= 85 * (len(f) + len(other) - both):
                    followed += 1
                    label = jaccard_join.connect(np.array([len(lead), len(other)]), [jaccard_join.bit_sketch(lead), jaccard_join.bit_sketch(other)],
                                                 85, slack=np.array([radius[leader], 0]))
                    assert label[0] == label[1]
    assert followed > 1000


def test_jaccard_join_of_hot_keys_whose_sizes_straddle_a_power_of_two(spark):
    rng = random.Random(23)
    base = [f"w{i}" for i in range(68)]
    rows = []
    for i in range(640):
        words = list(base)
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(words[rng.randrange(0, 4):len(words) - rng.randrange(0, 4)] + [f"t{i}_{k}" for k in range(rng.randrange(0, 5))])))
    want = ref.component_ids(rows, 4, 85)
    assert min(n for _, n, _ in want) < 64 < max(n for _, n, _ in want) and 1 < len({c for *_, c in want}) < 640
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)  # 256 sets of a block under a key make it hot
    same(jaccard_join.link_documents(docs, 4, 85).collect(), want)


def test_jaccard_join_near_the_bound(spark):
    rng = random.Random(11)
    rows = []
    for n in (3, 6, 9, 15, 40, 100, 260):
        for _ in range(4):
            base = [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
            for edits in range(0, 1 + n // 4):
                words = list(base)
                for _ in range(edits):
                    k = rng.randrange(4)
                    at = rng.randrange(len(words))
                    words = words[:at] + ([f"e{rng.randrange(99)}"] if k < 3 else []) + words[at + 1:] if k else words + [rng.choice(base)]
                    words = words or base
                rows.append((len(rows), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    same(jaccard_join.link_documents(docs, 4, 85).collect(), ref.component_ids(rows, 4, 85))
    assert jaccard_join.link_documents(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ 7 quality rules
def test_quality_base(spark, docs, rows, no_docs):
    labels = spark.createDataFrame([(1, 1, 0, 5), (1, 0, 0, 5), (None, 1, 0, 5), (2, None, 0, 5)], "doc_id long, quality int, toxic int, text int")
    rules = quality.train(docs, labels)
    assert rules.trees is None
    want = []
    for d, t, *_ in rows:
        b = ref.quality_base(t)
        bad = b[0] < 10 or 100 * b[4] > 20 * b[0]
        want.append((d, *b, bad, not bad))
    same(quality.judge_documents(docs, rules).collect(), want)
    assert quality.judge_documents(no_docs, quality.train(no_docs, labels.limit(0))).count() == 0


def test_quality_trees_hold_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "labels")
    rules = quality.train(docs, labels.filter("doc_id % 2 = 0"))
    got = {r.doc_id: r for r in quality.judge_documents(docs, rules).collect()}
    test = [(bool(r.quality == 1 and r.toxic == 0), got[r.doc_id].kept) for r in labels.filter("doc_id % 2 = 1").collect()]
    good = [kept for truth, kept in test if truth]
    bad = [kept for truth, kept in test if not truth]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.1, (np.mean(good), np.mean(bad))


def test_trees_are_monotonic_and_flat():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 3))
    y = (x[:, 0] - x[:, 1] + 0.3 * np.sin(9 * x[:, 2]) + 0.3 * rng.standard_normal(3000)) > 0
    trees = quality.fit_trees(x, y, [1, -1, 0], trees=30)
    assert ((trees.score(x) > 0) == y).mean() > 0.8
    at = rng.random((200, 3))
    for f, sign in ((0, 1), (1, -1)):
        grid = np.linspace(0, 1, 40)
        scores = []
        for g in grid:
            moved = at.copy()
            moved[:, f] = g
            scores.append(trees.score(moved))
        assert (np.diff(np.array(scores), axis=0) * sign >= -1e-12).all()


# ------------------------------------------------------------------ 8 sharding
def test_sharding(spark, docs, rows, no_docs):
    import zlib
    got = sharding.shard_documents(docs).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    slots = {}
    for r in got:
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24) and r.law == "key"
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(no_docs).count() == 0


def test_hash_tree_moves_only_into_what_grew():
    keys = sharding.keys_of(list(range(40_000)))
    for n in (1, 3, 4, 11, 12, 13, 24):
        before = sharding.ShardTree([1.0] * n).place(keys)
        after = sharding.ShardTree([1.0] * (n + 1)).place(keys)
        assert set(after[after != before]) <= {n}
        assert np.bincount(after, minlength=n + 1).std() < 0.1 * 40_000 / (n + 1)
    heavy = [1.0] * 24
    heavy[7] = 2.5
    before, after = sharding.ShardTree([1.0] * 24).place(keys), sharding.ShardTree(heavy).place(keys)
    assert set(after[after != before]) == {7}
    assert np.bincount(after)[7] / 40_000 == pytest.approx(2.5 / 25.5, rel=0.1)


# ------------------------------------------------------------------ 9 wavelet files
def test_wavelet_matrix():
    rng = np.random.default_rng(4)
    for n, top in ((0, 7), (1, 1), (5000, 50_257), (300_000, 9)):
        ids = rng.integers(0, top, n).astype(np.uint32)
        data = wavelet.write_shard(3, 1, list(range(3)), np.array([n, 0, 0]), ids, max(1, (top - 1).bit_length())) + b"\n"
        ((task, number, docs, counts, m),) = wavelet.read_shards(data)
        assert (task, number, docs, counts.tolist()) == (3, 1, [0, 1, 2], [n, 0, 0])
        assert (m.decode() == ids).all()
        for i in (rng.integers(0, n, 20) if n else []):
            assert m.access(int(i)) == ids[i]
            value = int(ids[i])
            places = np.flatnonzero(ids == value)
            assert m.rank(value) == len(places) and m.rank(value, int(i)) == (places < i).sum()
            assert m.select(value, 0) == places[0] and m.select(value, len(places) - 1) == places[-1]
            with pytest.raises(IndexError):
                m.select(value, len(places))
        assert m.rank(0, 0) == 0


def test_wavelet_files(spark, docs, rows, no_docs):
    library = Tokenizer.from_file(BYTES)
    folder = stage_path(spark, "wavelet-test")
    wavelet.write_ids(docs, BYTES, folder, shard_tokens=5000)
    got = sorted(wavelet.read_ids(spark, folder).collect(), key=lambda r: r.start)
    ids = [(d, library.encode(t or "", add_special_tokens=False).ids + [2]) for d, t, *_ in rows]
    assert [r.doc_id for r in got] == sorted((d for d, _ in ids), key=lambda d: (d is not None, d or 0))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(i), ref.crc_ids(i)) for d, i in ids)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    folder = stage_path(spark, "wavelet-test")
    wavelet.write_ids(no_docs, BYTES, folder)
    assert wavelet.read_ids(spark, folder).count() == 0


# ------------------------------------------------------------------ 10 substring dedup
@pytest.mark.parametrize("most", [1, 30, 10 ** 6])
def test_repeats(spark, rows, most):
    # with unique ids the order is total, so results are exact whatever the blocks
    named = [(i if d is not None else None, t) for i, (d, t, *_) in enumerate(rows) if i != 11]
    docs = spark.createDataFrame(named, "doc_id long, text string").repartition(3)
    same(substring.repeated_words(docs, most=most).collect(), ref.repeats(named))


def test_repeats_with_tied_ids_leave_one_original(spark, docs, rows, no_docs):
    got = substring.repeated_words(docs).collect()
    want = ref.repeats([(d, t) for d, t, *_ in rows])
    assert Counter((r.doc_id, r.n_words) for r in got) == Counter((d, n) for d, n, *_ in want)
    twins = [r.n_removed for r in got if r.doc_id == 2]
    assert twins == [r.n_words for r in got if r.doc_id == 2]  # both repeat document 1
    assert substring.repeated_words(no_docs).count() == 0


#: Two runs of 20 words that are unequal and have one 64-bit window hash.
TWINS = [" ".join([f"p{i}" for i in range(16)] + [f"w{i}" for i in end]) for end in ((639, 232, 2269, 1396), (427, 1928, 559, 672))]


@pytest.mark.parametrize("parts", [1, 4])
@pytest.mark.parametrize("most", [1, 1_000_000])
def test_equal_hashes_of_unequal_words_are_no_repeat(spark, parts, most):
    a, b = (common.run_hashes(common.Words([t.encode()]).hashes(), [20])[0] for t in TWINS)
    assert a == b and TWINS[0] != TWINS[1]
    rows = [(1, TWINS[0]), (2, TWINS[1]), (3, "x " + TWINS[1] + " y"), (4, TWINS[0] + " " + TWINS[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts, "doc_id")
    same(substring.repeated_words(docs, most=most).collect(), ref.repeats(rows))


def test_remove_repeats_keeps_rows_and_columns(spark, docs, rows):
    out = substring.remove_repeats(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert 2 not in got and got[1].text == rows[0][1] and got[4].text is None and got[15].text == rows[17][1]
    assert got[11].text != next(r for r in rows if r[0] == 11)[1] and got[11].words == "x"


def test_union_sources_keeps_every_language(spark, tmp_path):
    from listingflow.plans.catalog import QUERIES
    rows = [(1, "en", "a"), (2, "it", "a"), (3, None, "b"), (4, "es", None)]
    spark.createDataFrame(rows, "doc_id long, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    same(QUERIES["union_sources"](spark, str(tmp_path)).collect(), rows)


# ------------------------------------------------------------------ pipeline
def test_pipeline(spark):
    import corpus_pipeline

    docs = table(spark, SF, "documents")
    before = {r.doc_id: r for r in docs.collect()}
    kept = docs
    for name, apply in corpus_pipeline.STAGES[:-1]:
        inputs = {r.doc_id: r for r in kept.collect()}
        kept = corpus_pipeline.stage(apply(spark, kept, SF), "pipeline-test")
        assert kept.columns == docs.columns, name
        out = {r.doc_id: r for r in kept.collect()}
        assert out.keys() <= inputs.keys()
        rows = [(d, r.text) for d, r in inputs.items()]
        if name == "n-gram Jaccard join":
            assert out.keys() == {d for d, _, c in ref.component_ids(rows, 5, 80) if d == c}
        elif name == "substring dedup":
            want = {d: (n, gone, h) for d, n, gone, h in ref.repeats(rows)}
            assert out.keys() == {d for d, (n, gone, _) in want.items() if gone < n or not n}
            import hashlib
            for d, r in out.items():
                assert hashlib.sha256(" ".join(ref.WORD.findall(r.text)).encode()).hexdigest() == want[d][2]
                assert r.n_chars == len(r.text)
        elif name == "benchmark decontamination":
            items = [tuple(r) for r in table(spark, SF, "benchmark", "item_id", "text").collect()]
            assert out.keys() == {d for d, *_, hit in ref.benchmark_hits(rows, items) if not hit}
        else:
            assert all(inputs[d] == r for d, r in out.items())
    library = Tokenizer.from_file(WORDS)
    ids = [(r.doc_id, library.encode(r.text, add_special_tokens=False).ids + [2]) for r in kept.collect()]
    check_packed(corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect(), ids)
    assert len(ids) > len(before) // 4


def test_entry_registers_everything():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert os.path.exists(os.path.join(os.path.dirname(entry.__file__), "corpus_pipeline.py"))
