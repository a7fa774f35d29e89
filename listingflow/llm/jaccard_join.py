"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct word shingles.  A parity sketch XORs every shingle's hash
into one of ``P`` words, so the number of words in which two sketches differ is at most the
symmetric difference of the sets.  Sets that link, of sizes up to ``U``, differ by at most
``h = 2 U (100 - s) / (100 + s)`` shingles, so with ``P = h + 1 + 2x`` words at least ``2x + 1``
words are equal (pigeonhole); even if each side leaves out any ``x`` of its words, here those
that the fewest shingles fell into, an equal one is left on both sides.  ``U`` is the upper end
of a size band; a set joins in its own band and in the next if a partner may lie there.

1. Every set sends its words, keyed by band, place and value.  Where very many sets of one block
   of documents share a key, sets close to a leader (by bit sketch) are tied to it and stay; the
   leader goes on with its cluster's exact radius as slack, so by the triangle inequality whatever
   links with one of them is still tied to the leader.
2. Keys meet by hash bucket; those of more than one set go on, joined with the sets' bit sketches
   (each shingle flips one bit, so their Hamming distance, too, is at most the symmetric
   difference).  Under each key, sets whose sizes and Hamming distance allow a link are tied; sets
   that are connected already are not compared again, so a group of near copies costs a star.
   The bit sketches keep a passage that many documents share from tying all of them.
3. Connected components of the ties hold every link inside.  Each component's sets come together
   once and are verified by their exact intersections.  A component too large for one task is cut
   into chunks, and every pair of chunks is a task.
4. Components of the verified links give the answer.

Equal sets are one node throughout, so exact copies cost one row.  Nothing is capped: where keys
are common the tasks compare more, they do not drop.  A set and a shingle are known by 64-bit
hashes.

Edge cases: a text with fewer words than a shingle is one shingle; null, empty or blank texts
have the empty set and are linked with nothing; a null id never names a component (a component
of null ids only has a null name); repeated rows link as equal sets; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_blocks, mix, numbered, shuffle_partitions, squeeze, squeeze_sorted, stage, stage_and_release, table, unsqueeze, unsqueeze_sorted, window_hashes, Words, U64
from .components import components

SHINGLE_WORDS, SIMILARITY = 5, 80
BAND_RATIO = 1.5
#: Shingles and sets of one verification task; a larger component becomes several chunks.
CHUNK_SHINGLES, CHUNK_SETS = 4_000_000, 10_000
#: Bits per shingle of the sketches compared before sets are.
VERIFY_BITS = 16
SENT_BITS = 2
#: A key that so many sets of one block share is thinned to leaders, at most so many with followers.
HOT_IN_BLOCK, LEADERS = 256, 16
#: Bits of the filter that keeps sets without any tie out of the verification shuffle.
FILTER_BITS = 24


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words([t.lower() for t in texts])
    at, (runs,) = words.windows([size], within=size)
    ends = np.cumsum(words.counts)
    begin = np.searchsorted(at, ends - words.counts).tolist()
    out = []
    for n, end, a, b in zip(words.counts.tolist(), ends.tolist(), begin, [*begin[1:], len(at)]):
        # a text of fewer words is one shingle
        out.append(np.unique(runs[a:b] if n >= size else window_hashes(words.hashes(0, end - n, end), n) if n else np.empty(0, U64)))
    return out


def node_of(shingles: np.ndarray) -> np.uint64:
    """The set's own 64-bit name (as Spark's bigint when viewed as int64)."""
    return mix(np.array([mix(shingles ^ U64(0x5BF03635)).sum(dtype=U64) + U64(len(shingles))], U64))[0]


def bands(similarity: int, most: int = 1 << 40) -> np.ndarray:
    """Lower ends of the size bands."""
    ratio = max(BAND_RATIO, 100 / similarity + 0.25)
    lows = [1]
    while lows[-1] < most:
        lows.append(max(lows[-1] + 1, int(np.ceil(lows[-1] * ratio))))
    return np.array(lows, np.int64)


def sketch_keys(shingles: np.ndarray, similarity: int, lows: np.ndarray) -> list[np.ndarray]:
    """The keys a set sends: words of its parity sketch in each band it joins in."""
    own = int(np.searchsorted(lows, len(shingles), side="right")) - 1
    out = []
    for band in (own, own + 1):
        if band > own and 100 * len(shingles) < similarity * int(lows[band]):
            break
        h = 2 * (int(lows[band + 1]) - 1) * (100 - similarity) // (100 + similarity)
        spare = -(-h // 10)
        words = h + 1 + 2 * spare
        salted = mix(shingles + U64((band + 1) * 0xA24BAED4963EE407 & (1 << 64) - 1))
        place = ((salted >> U64(32)) * U64(words) >> U64(32)).astype(np.int64)
        sketch = np.zeros(words, U64)
        np.bitwise_xor.at(sketch, place, mix(salted))
        many = np.bincount(place, minlength=words)
        sent = np.argsort(many, kind="stable")[spare:]
        out.append(mix(sketch[sent] ^ mix(sent.astype(U64) + (U64(band) << U64(40)))))
    return out


def bit_sketch(shingles: np.ndarray, per_shingle: int = SENT_BITS) -> bytes:
    """Parity sketch of about so many bits per shingle: shingle ``s`` flips bit ``s mod size``."""
    bits = max(64, 1 << (len(shingles) * per_shingle // 2).bit_length())
    flips = np.bincount((shingles & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of the smallest size: the parities of halves add up (and no distance grows)."""
    words = min(len(s) for s in sketches) // 8
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(s, U64).reshape(-1, words), axis=0) for s in sketches])


def distances(rows: np.ndarray, row: np.ndarray) -> np.ndarray:
    return np.bitwise_count(rows ^ row).sum(axis=1, dtype=np.int64)


def connect(sizes: np.ndarray, sketches: list[bytes], similarity: int, link=None, chunk: np.ndarray | None = None,
            slack: np.ndarray | None = None) -> np.ndarray:
    """Labels of connected sets: two link if their sizes and the Hamming distance of their sketches
    (less their slack) allow it and, where given, ``link(i, j)`` says so.  Sets with one label are
    not compared.

    ``chunk``: compare only sets of different chunks.
    """
    n = len(sizes)
    rows = folded(sketches)
    slack = np.zeros(n, np.int64) if slack is None else slack
    label = np.arange(n)
    for i in range(n):
        others = label != label[i]
        if not others.any():
            if chunk is None:
                break
            continue
        others[:i + 1] = False
        if chunk is not None:
            others &= chunk != chunk[i]
        alike = 100 * np.minimum(sizes, sizes[i]) >= similarity * np.maximum(sizes, sizes[i])
        at = np.flatnonzero(others & (alike | (slack + slack[i] > 0)))
        apart = distances(rows[at], rows[i]) - slack[at] - slack[i]
        for j in at[(100 + similarity) * apart <= (100 - similarity) * (sizes[at] + sizes[i])].tolist():
            if label[j] != label[i] and (link is None or link(i, j)):
                label[label == label[j]] = label[i]
    return label


def stars(nodes: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """(node, smallest node with its label) of all other nodes."""
    order = np.lexsort((nodes, label))
    nodes, label = nodes[order], label[order]
    first = np.concatenate(([True], label[1:] != label[:-1]))
    least = nodes[np.flatnonzero(first)][np.cumsum(first) - 1]
    return list(zip(nodes[~first].tolist(), least[~first].tolist()))


def describe(size: int):
    """Task function: documents -> set size, node and bit sketch."""
    def run(batches):
        for rows, texts in in_blocks(batches, "text"):
            sets = shingle_sets(texts, size)
            nodes = [int(node_of(s).view(np.int64)) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(rows.column("doc_id").chunks), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array(nodes, pa.int64()), pa.array([bit_sketch(s) if len(s) else None for s in sets], pa.binary())],
                                             names=["doc_id", "n_shingles", "node", "sketch"])
    return run


def by_key(keys: np.ndarray, nodes: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, node) rows in order with their largest slack, and how many rows their key has."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1]))) if len(keys) else np.empty(0, bool)
    slack = np.maximum.reduceat(slack[order], np.flatnonzero(new)) if len(keys) else slack
    keys, nodes = keys[new], nodes[new]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    many = np.diff(np.append(first, len(keys)))
    return keys, nodes, slack, np.repeat(many, many)


def thin(nodes: np.ndarray, known: dict[int, np.ndarray], sketches: list[bytes], similarity: int,
         measured: dict[tuple[int, int], int]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Slack per node, -1 for those that stay behind a leader; and their ties (node, leader).

    Sketches only choose the followers.  The radius comes from the sets themselves: a set that links
    with follower ``f`` differs from ``f`` by at most ``c`` times both sizes, so from the leader by at
    most that plus ``|f ^ leader|``, however wide the sketches are that the two are compared by later.
    ``measured`` keeps these differences, for near copies share many keys.
    """
    names = nodes.tolist()
    sizes = np.array([len(known[n]) for n in names], np.int64)
    rows, slack, ties = folded(sketches), np.zeros(len(nodes), np.int64), []
    left = np.arange(len(nodes))
    for _ in range(LEADERS):
        if len(left) < 2:
            break
        i = left[0]
        apart = distances(rows[left], rows[i])
        near = 2 * (100 + similarity) * apart <= (100 - similarity) * (sizes[left] + sizes[i])
        near[0] = True
        behind = left[near][1:]
        if len(behind):
            leader, radius = names[i], 0
            for j in behind.tolist():
                pair = (leader, names[j])
                if pair not in measured:
                    measured[pair] = differing(known[leader], known[names[j]])
                # and what a larger follower's own bound has more than the leader's
                radius = max(radius, measured[pair] - (100 - similarity) * int(sizes[i] - sizes[j]) // (100 + similarity))
            slack[i] = radius
            slack[behind] = -1
            ties += [(names[j], leader) for j in behind.tolist()]
        left = left[~near]
    return slack, ties


def differing(a: np.ndarray, b: np.ndarray) -> int:
    """Elements that only one of two sorted sets holds."""
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    return len(a) + len(b) - 2 * int(np.count_nonzero(a[at] == b))


def send_keys(size: int, similarity: int, buckets: int):
    """Task function: documents -> per bucket one row of keys with their nodes, and ties of hot keys."""
    def run(batches):
        lows = bands(similarity)
        for rows, texts in in_blocks(batches, "text"):
            known, keys, nodes = {}, [], []
            for s in shingle_sets(texts, size):
                node = node_of(s) if len(s) else None
                if node is None or int(node) in known:
                    continue
                known[int(node)] = s
                for k in sketch_keys(s, similarity, lows):
                    keys.append(k)
                    nodes.append(np.full(len(k), node, U64))
            if not keys:
                continue
            keys, nodes = np.concatenate(keys), np.concatenate(nodes)
            keys, nodes, slack, many = by_key(keys, nodes, np.zeros(len(keys), np.int64))
            ties, sketches, measured = set(), {}, {}
            at = 0
            hot = np.flatnonzero(many >= HOT_IN_BLOCK)
            while at < len(hot):
                part = slice(hot[at], hot[at] + many[hot[at]])
                names = nodes[part].tolist()
                for name in names:
                    if name not in sketches:
                        sketches[name] = bit_sketch(known[name])
                slack[part], more = thin(nodes[part], known, [sketches[n] for n in names], similarity, measured)
                ties.update(more)
                at += many[hot[at]]
            keys, nodes, slack = keys[slack >= 0], nodes[slack >= 0], slack[slack >= 0]
            bucket = (keys % U64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            used, begin = np.unique(bucket[order], return_index=True)
            out = []
            for number, part in zip(used.tolist(), np.split(order, begin[1:])):
                names, index = np.unique(nodes[part], return_inverse=True)
                out.append({"bucket": number, "keys": squeeze_sorted(keys[part]), "names": names.tobytes(), "index": squeeze(index.astype(np.uint32)), "slack": squeeze(slack[part].astype(np.uint32))})
            if ties:
                out[0] |= {"a": np.array([a for a, _ in ties], U64).tobytes(), "b": np.array([b for _, b in ties], U64).tobytes()}
            yield pa.RecordBatch.from_pylist(out, schema=_KEY_ROWS)
    return run


_KEY_ROWS = pa.schema([("bucket", pa.int32())] + [(c, pa.binary()) for c in ("keys", "names", "index", "slack", "a", "b")])


def meet(batches):
    """Task function: key rows of some buckets -> (key, node) of keys with more than one node; ties
    made inside blocks come through as (a, b)."""
    keys, nodes, slack, a, b = [], [], [], [], []
    for batch in batches:
        for row in batch.to_pylist():
            slack.append(unsqueeze(row["slack"], np.uint32).astype(np.int64))
            keys.append(unsqueeze_sorted(row["keys"], np.uint64))
            nodes.append(np.frombuffer(row["names"], U64)[unsqueeze(row["index"], np.uint32)])
            if row["a"]:
                a.append(np.frombuffer(row["a"], U64))
                b.append(np.frombuffer(row["b"], U64))
    if keys:
        keys, nodes, slack, many = by_key(np.concatenate(keys), np.concatenate(nodes), np.concatenate(slack))
        keys, nodes, slack = keys[many > 1], nodes[many > 1], slack[many > 1]
        none = pa.nulls(len(keys), pa.int64()), pa.nulls(sum(map(len, a)), pa.int64())
        a, b = (pa.array(np.concatenate([np.empty(0, U64), *x]).view(np.int64)) for x in (a, b))
        yield pa.RecordBatch.from_arrays([*(pa.concat_arrays([pa.array(x.view(np.int64)), none[1]]) for x in (keys, nodes, slack)),
                                          *(pa.concat_arrays([none[0], x]) for x in (a, b))], names=["key", "node", "slack", "a", "b"])


def tie_keys(similarity: int):
    """Task function: nodes with size and sketch, sorted by key -> ties that sizes and sketches allow."""
    def run(batches):
        # near copies share many keys: equal groups are compared once
        current, group, ties, seen = None, {}, set(), set()

        def close():
            same = frozenset((n, s) for n, (_, _, s) in group.items())
            if len(group) > 1 and same not in seen:
                seen.add(same)
                sizes, sketches, slack = zip(*group.values())
                label = connect(np.array(sizes, np.int64), list(sketches), similarity, slack=np.array(slack, np.int64))
                ties.update(stars(np.array(list(group), np.int64), label))

        for batch in batches:
            for key, node, slack, size, sketch in zip(*(batch.column(c).to_pylist() for c in ("key", "node", "slack", "size", "sketch"))):
                if key != current:
                    close()
                    current, group = key, {}
                group[node] = (size, sketch, slack)
            if len(ties) > 100_000 or len(seen) > 100_000:
                yield _links(list(ties))
                ties.clear()
                seen.clear()
        close()
        yield _links(list(ties))
    return run


def send_sets(size: int, wanted):
    """Task function: documents -> sets whose node may have a tie (once per block)."""
    def run(batches):
        bits = wanted.value
        for _, texts in in_blocks(batches, "text"):
            out: dict[int, bytes] = {}
            for s in shingle_sets(texts, size):
                if len(s):
                    node = int(node_of(s).view(np.int64))
                    place = (node >> (64 - FILTER_BITS)) & ((1 << FILTER_BITS) - 1)
                    if bits[place >> 6] >> (place & 63) & 1:
                        out[node] = s.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array([len(s) // 8 for s in out.values()], pa.int64()),
                                              pa.array(list(out.values()), pa.binary())], names=["node", "size", "shingles"])
    return run


def verify(nodes: np.ndarray, sets: list[np.ndarray], chunk: np.ndarray | None, similarity: int) -> list[tuple[int, int]]:
    """Links that connect every linked pair of the sets, as (node, smallest connected node).

    ``chunk``: compare only sets of different chunks.
    """
    sizes = np.array([len(s) for s in sets], np.int64)

    def exact(i: int, j: int) -> bool:
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return 100 * both >= similarity * (sizes[i] + sizes[j] - both)
    # finer sketches than those sent around: few pairs pass them that do not link
    return stars(nodes, connect(sizes, [bit_sketch(s, VERIFY_BITS) for s in sets], similarity, exact, chunk))


def verify_groups(similarity: int):
    """Task function: sets sorted by task key -> verified links."""
    def run(batches):
        current, rows = None, {}

        def close():
            nodes = np.array(list(rows), np.int64)
            sets = [np.frombuffer(s, U64) for s, _ in rows.values()]
            chunk = np.array([c for _, c in rows.values()]) if current[1] != current[2] else None
            return verify(nodes, sets, chunk, similarity)

        for batch in batches:
            links = []
            columns = (batch.column(c).to_pylist() for c in ("root", "i", "j", "chunk", "node", "shingles"))
            for root, i, j, chunk, node, shingles in zip(*columns):
                if (root, i, j) != current:
                    if len(rows) > 1:
                        links += close()
                    current, rows = (root, i, j), {}
                rows[node] = (shingles, chunk)
            yield _links(links)
        if len(rows) > 1:
            yield _links(close())
    return run


def _links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["a", "b"])


def link_documents(docs: DataFrame, size: int = SHINGLE_WORDS, similarity: int = SIMILARITY, id: str = "doc_id", text: str = "text",
                   chunk_shingles: int = CHUNK_SHINGLES) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document.

    Documents link when ``100 * |intersection| >= similarity * |union|`` of their shingle sets;
    ``component_id`` is the smallest id reachable by links.
    """
    spark = docs.sparkSession
    docs = docs.select(docs[id].alias("doc_id"), docs[text].alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    buckets = shuffle_partitions(spark)
    members = stage(docs.mapInArrow(describe(size), f"doc_id {kind}, n_shingles long, node long, sketch binary"), "jaccard-members")
    met = stage_and_release(docs.select("text").mapInArrow(send_keys(size, similarity, buckets), "bucket int, keys binary, names binary, index binary, slack binary, a binary, b binary")
                .repartition(buckets, "bucket").mapInArrow(meet, "key long, node long, slack long, a long, b long"), "jaccard-keys")
    about = members.filter("node is not null").groupBy("node").agg(F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch"))
    ties = (met.filter("node is not null").select("key", "node", "slack").join(about, "node")
            .repartition(buckets, "key").sortWithinPartitions("key").mapInArrow(tie_keys(similarity), "a long, b long"))
    tied = stage(components(ties.union(met.filter("a is not null").select("a", "b"))), "jaccard-tied")
    groups = tied.union(tied.select("root", "root").distinct())

    place = F.shiftrightunsigned("node", 64 - FILTER_BITS)
    words = (groups.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("bits")).collect())  # at most 2 ** 18 rows
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bits[[r["word"] for r in words]] = [r["bits"] for r in words]
    wanted = spark.sparkContext.broadcast(bits.view(U64).tolist())
    sets = docs.select("text").mapInArrow(send_sets(size, wanted), "node long, size long, shingles binary").join(groups, "node")
    sets = stage_and_release(sets, "jaccard-sets")
    parts = (sets.select("node", "root", "size").distinct().groupBy("root")
             .agg(F.ceil(F.greatest(F.sum("size") / chunk_shingles, F.count("*") / CHUNK_SETS)).cast("int").alias("parts"), F.count("*").alias("n"))
             .filter("n > 1"))
    spread = (sets.join(parts, "root").withColumn("chunk", F.pmod(F.xxhash64("node"), "parts").cast("int"))
              .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
              .select("root", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "node", "shingles"))
    links = (spread.repartition(buckets, "root", "i", "j").sortWithinPartitions("root", "i", "j")
             .mapInArrow(verify_groups(similarity), "a long, b long"))
    linked = components(links)
    named = members.drop("sketch").join(linked, "node", "left").withColumn("group", F.coalesce("root", "node"))
    least = named.filter("group is not null").groupBy("group").agg(F.min("doc_id").alias("least"))
    return (named.join(least, "group", "left")
            .select("doc_id", "n_shingles", F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")))


def query(spark, sf_dir):
    return link_documents(table(spark, sf_dir, "documents", "doc_id", "text"), 4, 85)


def pipeline_stage(spark, docs, sf_dir):
    """Of each group of near duplicates one document stays, with the smallest id (a null id is the last)."""
    rows, row = numbered(docs, "jaccard-input")
    found = stage(link_documents(rows, id=row).select(F.col("doc_id").alias(row), "component_id"), "near-duplicates")
    best = (found.join(rows.select(row, "doc_id"), row).groupBy("component_id")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row)).alias("best")).select(F.col(f"best.{row}").alias(row)))
    return rows.join(found.select(row).join(best, row, "left_anti"), row, "left_anti").select(*docs.columns)


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_n FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * both_n >= 85 * (p.n + q.n - both_n)),
reach AS (SELECT doc_id, doc_id AS r FROM w UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a)
SELECT w.doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles, min(reach.r) AS component_id
FROM w JOIN reach ON reach.doc_id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id
"""
