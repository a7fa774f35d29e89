"""Brown class-based n-grams: exchange clustering, class transitions, word emissions, perplexity.

The model gives a token ``w`` after ``v`` the probability ``p(class w | class v) * p(w | class w)``.
Words and one end token per document are counted over all training documents.

* Units.  Every word that training holds at least ``UNIT_COUNT`` times is a unit of its own, so the
  clustered vocabulary grows with the corpus; a rarer or unseen word belongs to the unit of its
  shape (length, last character, digits, alphabet), which the rare training words train.
* Exchange clustering over all unit bigrams of the training data: in each round every second unit
  may move to the class that raises the mutual information of neighbouring classes most, judged
  against the classes before the round; rounds stop when nothing moves, and the best classes
  seen are kept.  Units are rows of a Spark table with their neighbours; class counts are sums;
  the classes, one byte per unit, are what the driver holds and broadcasts.
* Transitions are smoothed towards the class frequencies, emissions by adding 0.1 per word of the
  class and for one word unseen.

Jobs: (1) documents become blocks of word numbers, written once, with their distinct words by
hash bucket; (2) words meet by bucket, are counted and numbered, and both go back to their blocks;
(3) unit bigrams are summed in blocks, then by unit; (4) exchange rounds; (5) blocks with their
counts score every document.  A hot word is one row per block; no task sees a whole vocabulary.

Edge cases: a null or empty text is the end token alone; a null id hashes as the empty string;
without training documents every probability is the smoothing's; repeated rows are counted and
scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Ids, in_blocks, mix, partition_id, ragged, shuffle_partitions, squeeze, squeeze_sorted, stage, stage_and_release, table, unsqueeze, unsqueeze_sorted, word_hashes, U64
from .token_counts import ragged_ids, split_words

#: Training occurrences from which a word is a unit of its own.
UNIT_COUNT = 2
CLASSES = 64
ROUNDS = 12
ADD = 0.1
SHAPES = 5 * 4 * 2 * 2
#: Units before the words: the end token and the shapes.
FIRST_WORD = 1 + SHAPES
#: Neighbours in one row of the units' table (a unit is never split).
ROW_NEIGHBOURS = 50_000
_MARKS = frozenset(b".,;:!?\"')")


def shape_of(word: bytes) -> int:
    """Number below ``SHAPES`` of a word's shape."""
    size = min(4, (len(word) - 1) // 3)
    last = word[-1]
    end = 0 if last in b".!?" else 1 if last in _MARKS else 2 if 97 <= last <= 122 or last >= 128 else 3
    digits = any(48 <= c <= 57 for c in word)
    return ((size * 4 + end) * 2 + digits) * 2 + (not word.isascii())


def planes(values: np.ndarray) -> bytes:
    return squeeze(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T))


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(unsqueeze(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def gather(buckets: int):
    """Task function: documents -> blocks of word numbers, with their words and training counts."""
    def run(batches):
        for number, (rows, texts) in enumerate(in_blocks(batches, "text")):
            ids = Ids()
            cut = [t.lower().split() for t in texts]
            lengths = np.array([len(c) for c in cut], np.int64)
            codes = np.fromiter(map(ids.__getitem__, chain.from_iterable(cut)), np.int64, int(lengths.sum()))
            test = np.array([held_out(i) for i in rows.column("doc_id").to_pylist()], bool)
            words = list(ids)
            counts = np.bincount(codes[np.repeat(~test, lengths)], minlength=len(words))
            bucket = (word_hashes(words) % U64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            used, first, many = np.unique(bucket[order], return_index=True, return_counts=True)
            lists = []
            for b, i, n in zip(used.tolist(), first.tolist(), many.tolist()):
                at = order[i:i + n]
                part = [words[j] for j in at]
                lists.append({"bucket": b, "lengths": squeeze(np.array([len(w) for w in part], np.uint32)), "words": squeeze(b"".join(part)), "counts": planes(counts[at])})
            yield pa.RecordBatch.from_arrays([
                pa.array([(partition_id() << 32) + number], pa.int64()), ragged_ids(rows.column("doc_id"), len(texts)),
                pa.array([test.tolist()], pa.list_(pa.bool_())), ragged(lengths, np.array([len(texts)])),
                pa.array([planes(codes)], pa.binary()), pa.array([planes(order)], pa.binary()),
                pa.array([lists], pa.list_(pa.struct([(n, pa.binary() if n != "bucket" else pa.int32()) for n in ("bucket", "lengths", "words", "counts")]))),
            ], names=["block", "doc_ids", "held_out", "lengths", "codes", "order", "lists"])
    return run


def count_words(least: int):
    """Task function: the words of some buckets -> total counts and units in the order sent, and a summary.

    A word's unit is its number among the task's words of at least ``least`` occurrences, or ``-1 - shape``.
    """
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("home", pa.int64()), ("counts", pa.binary()), ("units", pa.binary()), ("seeds", pa.binary()),
                        ("sizes", pa.list_(pa.struct([("n", pa.int64()), ("words", pa.int64())]))), ("shapes", pa.list_(pa.int64())), ("total", pa.int64())])

    def run(batches):
        ids, rows, numbers, counts = Ids(), [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                words = split_words(row["lengths"], row["words"])
                numbers.append(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
                counts.append(from_planes(row["counts"]))
                rows.append((row["block"], row["bucket"]))
        if not rows:
            return
        totals = np.bincount(np.concatenate(numbers), np.concatenate(counts), minlength=len(ids)).astype(np.int64)
        words, home = list(ids), partition_id()
        own = totals >= least
        units = np.cumsum(own) - 1
        units[~own] = [-1 - shape_of(words[i]) for i in np.flatnonzero(~own).tolist()]
        for (block, bucket), number in zip(rows, numbers):
            yield pa.RecordBatch.from_pylist([{"block": block, "bucket": bucket, "home": home, "counts": squeeze(totals[number]), "units": squeeze(units[number].astype(np.int32))}], schema=schema)
        shapes = np.bincount(-1 - units[(totals > 0) & ~own], minlength=SHAPES)
        sizes = np.unique(totals[own], return_counts=True)
        seeds = word_hashes([words[i] for i in np.flatnonzero(own).tolist()]) >> U64(48)
        yield pa.RecordBatch.from_pylist([{"home": home, "seeds": squeeze(seeds.astype(np.uint16)), "sizes": [{"n": n, "words": w} for n, w in zip(*map(np.ndarray.tolist, sizes))],
                                           "shapes": shapes.tolist(), "total": int(totals.sum())}], schema=schema)
    return run


def least_count(summary: DataFrame, most: int) -> int:
    """The smallest count that at most ``most`` words reach."""
    sizes = summary.select(F.explode("sizes").alias("s")).groupBy("s.n").agg(F.sum("s.words").alias("words")).orderBy(F.desc("n"))
    words, least = 0, 1 << 62
    for r in sizes.toLocalIterator():
        words += r["words"]
        if words > most:
            break
        least = r["n"]
    return least


def summed(rows: DataFrame, column: str, size: int) -> np.ndarray:
    """Sum of an array column, entry by entry."""
    out = np.zeros(size, np.int64)
    for r in rows.select(F.posexplode(column).alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).collect():
        out[r["i"]] = r["n"]
    return out


def block_units(row: dict, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units and counts of a block's words by number; ``begins``: first unit of each home."""
    sent = sorted(row["answers"] or [], key=lambda a: a["bucket"])
    if not sent:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = from_planes(row["order"])
    units, counts = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    found = [unsqueeze(a["units"], np.int32).astype(np.int64) for a in sent]
    units[order] = np.concatenate([np.where(u < 0, -u, begins[a["home"]] + u) for a, u in zip(sent, found)])
    counts[order] = np.concatenate([unsqueeze(a["counts"], np.int64) for a in sent])
    return units, counts


def sequence(codes: np.ndarray, lengths: np.ndarray, of_word: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """The documents' tokens one after another, each closed by ``end``; and their documents."""
    ends = np.cumsum(lengths)
    return np.insert(of_word[codes], ends, end), np.repeat(np.arange(len(lengths)), lengths + 1)


def count_pairs(begins, size: int, buckets: int):
    """Task function: answered blocks -> counts of neighbouring units in training documents, by bucket of the unit."""
    schema = pa.schema([("bucket", pa.int32()), ("right", pa.bool_()), ("pairs", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                tokens, doc = sequence(from_planes(row["codes"]) if lengths.sum() else np.empty(0, np.int64), lengths, block_units(row, begins.value)[0], 0)
                tokens = tokens[~np.array(row["held_out"], bool)[doc]]
                before = np.concatenate(([0], tokens[:-1]))  # each document follows an end token
                out = []
                for right, key, other in ((True, before, tokens), (False, tokens, before)):
                    pairs, counts = np.unique(key.astype(U64) * U64(size) + other.astype(U64), return_counts=True)
                    bucket = (pairs // U64(size) % U64(buckets)).astype(np.int32)
                    order = np.argsort(bucket, kind="stable")
                    used, begin = np.unique(bucket[order], return_index=True)
                    for number, part, n in zip(used.tolist(), np.split(pairs[order], begin[1:]), np.split(counts[order], begin[1:])):
                        out.append({"bucket": number, "right": right, "pairs": squeeze_sorted(part), "counts": planes(n)})
                yield pa.RecordBatch.from_pylist(out, schema=schema)
    return run


SIDES = ("right", "left")
NEIGHBOURS = pa.schema([("units", pa.binary())] + [(s + c, pa.binary()) for s in SIDES for c in ("_many", "", "_n")])


def neighbours(size: int):
    """Task function: pair counts of some buckets -> rows of units with both their neighbour lists."""
    def run(batches):
        held = {True: [], False: []}

        def fold(right):
            if held[right]:
                pairs, place = np.unique(np.concatenate([p for p, _ in held[right]]), return_inverse=True)
                held[right] = [(pairs, np.bincount(place, np.concatenate([n for _, n in held[right]])).astype(np.int64))]

        for batch in batches:
            for row in batch.to_pylist():
                right = row["right"]
                held[right].append((unsqueeze_sorted(row["pairs"], np.uint64), from_planes(row["counts"])))
                if len(held[right]) > 40:
                    fold(right)
        fold(True)
        fold(False)
        if not held[True]:
            return
        # in training every unit has a token before it and one after it
        sides = [((pairs // U64(size)).astype(np.int64), (pairs % U64(size)).astype(np.int64), n) for (pairs, n), in (held[True], held[False])]
        units = np.unique(sides[0][0])
        ends = [np.searchsorted(key, units, side="right") for key, _, _ in sides]
        row = (ends[0] + ends[1]) // ROW_NEIGHBOURS
        begin = np.flatnonzero(np.diff(row, prepend=-1)).tolist()
        for a, b in zip(begin, [*begin[1:], len(units)]):
            out = {"units": squeeze(units[a:b])}
            for name, (_, other, n), end in zip(SIDES, sides, ends):
                first = end[a - 1] if a else 0
                out |= {f"{name}_many": squeeze(np.diff(end[a:b], prepend=first)), name: planes(other[first:end[b - 1]]), f"{name}_n": squeeze(n[first:end[b - 1]])}
            yield pa.RecordBatch.from_pylist([out], schema=NEIGHBOURS)
    return run


def _profiles(row: dict, side: str, units: np.ndarray, classes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per unit the counts of its neighbours' classes on one side, and of the unit itself."""
    other, n = from_planes(row[side]), unsqueeze(row[f"{side}_n"], np.int64)
    place = np.repeat(np.arange(len(units)), unsqueeze(row[f"{side}_many"], np.int64))
    same = other == units[place]
    return (np.bincount(place * k + classes[other], n, minlength=len(units) * k).reshape(-1, k),
            np.bincount(place[same], n[same], minlength=len(units)))


def sum_classes(classes, k: int):
    """Task function: units -> counts of class pairs."""
    def run(batches):
        sums = np.zeros(k * k)
        for batch in batches:
            for row in batch.to_pylist():
                units = unsqueeze(row["units"], np.int64)
                own = classes.value[np.repeat(units, unsqueeze(row["right_many"], np.int64))].astype(np.int64)
                sums += np.bincount(own * k + classes.value[from_planes(row["right"])], unsqueeze(row["right_n"], np.int64), minlength=k * k)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at].astype(np.int64))], names=["cell", "n"])
    return run


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def information(pairs: np.ndarray) -> float:
    """Log-likelihood of the class bigrams, up to what the classes cannot change."""
    return float(xlogx(pairs).sum() - xlogx(pairs.sum(axis=0)).sum() - xlogx(pairs.sum(axis=1)).sum())


def best_class(pairs: np.ndarray, a: int, right: np.ndarray, left: np.ndarray, own: int) -> tuple[int, float]:
    """Where a unit of class ``a`` fits best (never the end token's class 0), and what that gains."""
    k = len(pairs)
    right, left = right.copy(), left.copy()
    right[a] -= own
    left[a] -= own
    rest = pairs.copy()
    rest[a] -= right
    rest[:, a] -= left
    rest[a, a] -= own
    logs = xlogx(rest)
    row = xlogx(rest + right[None, :]) - logs
    column = (xlogx(rest + left[:, None]) - logs).T
    both = np.arange(k)
    diagonal = rest[both, both]
    gain = row.sum(axis=1) - row[both, both] + column.sum(axis=1) - column[both, both]
    gain += xlogx(diagonal + right + left + own) - logs[both, both]
    # the unit's neighbours keep their own tokens wherever the unit goes
    starts, ends = rest.sum(axis=1) + left, rest.sum(axis=0) + right
    gain -= xlogx(starts + right.sum() + own) - xlogx(starts) + xlogx(ends + left.sum() + own) - xlogx(ends)
    gain[0] = -np.inf
    b = int(gain.argmax())
    return b, float(gain[b] - gain[a])


def best_classes(pairs: np.ndarray, a: np.ndarray, right: np.ndarray, left: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``best_class`` of many units; only cells of their neighbours' classes are computed."""
    m, k = right.shape
    each, logs = np.arange(m), xlogx(pairs)
    right, left = right.copy(), left.copy()
    right[each, a] -= own
    left[each, a] -= own
    gain = np.zeros((m, k))
    for cells, known, mine, other in ((pairs.T, logs.T, right, left), (pairs, logs, left, right)):
        u, c = np.nonzero(mine)
        if not len(u):
            continue
        n, at, from_ = mine[u, c], np.arange(len(u)), a[u]
        rest, old = cells[c], known[c]
        inside = np.flatnonzero(c == from_)
        rest[at, from_] -= n
        rest[inside] -= other[u[inside]]
        rest[inside, c[inside]] -= own[u[inside]]
        old[at, from_] = xlogx(rest[at, from_])
        old[inside] = xlogx(rest[inside])
        change = xlogx(rest + n[:, None]) - old
        change[at, c] = 0
        begin = np.flatnonzero(np.diff(u, prepend=-1))
        gain[u[begin]] += np.add.reduceat(change, begin)

    def grown(counts, without, by):
        rest = np.tile(counts, (m, 1))
        rest[each, a] -= without
        return xlogx(rest + by) - xlogx(rest)
    gain += grown(pairs.diagonal(), right[each, a] + left[each, a] + own, right + left + own[:, None])
    for counts, mine in ((pairs.sum(axis=1), right), (pairs.sum(axis=0), left)):
        moved = mine.sum(axis=1) + own
        gain -= grown(counts, moved, moved[:, None])
    gain[:, 0] = -np.inf
    b = gain.argmax(axis=1)
    return b, gain[each, b] - gain[each, a]


def move_units(classes, pairs, turns, turn: int):
    """Task function: units whose turn it is -> their new classes."""
    def run(batches):
        k = len(pairs)
        for batch in batches:
            for row in batch.to_pylist():
                units = unsqueeze(row["units"], np.int64)
                right, own = _profiles(row, "right", units, classes.value, k)
                left, _ = _profiles(row, "left", units, classes.value, k)
                now = np.flatnonzero((units > 0) & (turns.value[units] == turn % 2))
                units = units[now]
                a = classes.value[units].astype(np.int64)
                best, gain = best_classes(pairs, a, right[now], left[now], own[now])
                moved = (best != a) & (gain > 1e-6)
                if moved.any():
                    yield pa.RecordBatch.from_arrays([pa.array([squeeze(units[moved])], pa.binary()), pa.array([squeeze(best[moved])], pa.binary())], names=["units", "classes"])
    return run


def class_pairs(adjacent: DataFrame, classes, k: int) -> np.ndarray:
    rows = adjacent.mapInArrow(sum_classes(classes, k), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # k * k at most
    pairs = np.zeros(k * k)
    pairs[[r["cell"] for r in rows]] = [r["n"] for r in rows]
    return pairs.reshape(k, k)


def exchange(adjacent: DataFrame, seeds: np.ndarray, k: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all units by exchange, and the counts of class pairs.

    ``seeds``: 16 bits per unit that say where it begins and when it is its turn.
    """
    share = adjacent.sparkSession.sparkContext.broadcast
    classes = (1 + seeds % (k - 1)).astype(np.min_scalar_type(k - 1))
    classes[0] = 0
    turns = share((seeds >> 15).astype(np.uint8))
    shared = share(classes)
    pairs = class_pairs(adjacent, shared, k)
    best = (information(pairs), classes, pairs)
    still = 0
    for turn in range(rounds):
        moves = adjacent.mapInArrow(move_units(shared, pairs, turns, turn), "units binary, classes binary").collect()  # packed, units at most
        still = still + 1 if not moves else 0
        if still == 2:
            break
        classes = classes.copy()
        for m in moves:
            classes[unsqueeze(m["units"], np.int64)] = unsqueeze(m["classes"], np.int64)
        shared.destroy()
        shared = share(classes)
        pairs = class_pairs(adjacent, shared, k)
        if information(pairs) > best[0]:
            best = (information(pairs), classes, pairs)
    return best[1], best[2]


class Model:
    """What a block needs to score its documents."""

    def __init__(self, begins: np.ndarray, classes: np.ndarray, pairs: np.ndarray, shapes: np.ndarray, total: int, trained: int):
        self.begins, self.classes = begins, classes
        k = len(pairs)
        self.tokens = total + trained
        self.ends = trained
        self.distinct = len(classes) - FIRST_WORD + int(shapes.sum()) + (trained > 0)
        # distinct words of each class: the rare ones count by shape, the others are units of their own
        own = np.concatenate(([trained > 0], shapes, np.ones(len(classes) - FIRST_WORD)))
        words = np.bincount(classes, own, minlength=k)
        size = pairs.sum(axis=0)
        self.log_class = np.log10(size + ADD * (words + 1))
        share = (size + 1) / (size.sum() + k)
        self.transition = np.log10((pairs + share[None, :]) / (pairs.sum(axis=1, keepdims=True) + 1))
        self.log_base = float(np.log10(self.tokens + ADD * (self.distinct + 1)))


def score_blocks(model):
    """Task function: answered blocks -> scores per document."""
    def run(batches):
        m = model.value
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                n = len(lengths)
                units, counts = block_units(row, m.begins)
                codes = from_planes(row["codes"]) if len(units) else np.empty(0, np.int64)
                end = len(units)
                kinds = np.append(m.classes[units], 0).astype(np.int64)
                counts = np.append(counts, m.ends)
                tokens, doc = sequence(codes, lengths, np.arange(end + 1), end)
                own = kinds[tokens]
                before = np.concatenate(([0], own[:-1]))
                log_count = np.log10(counts + ADD)
                base = np.bincount(doc, log_count[tokens], minlength=n) - (lengths + 1) * m.log_base
                given = log_count - m.log_class[kinds]
                score = np.bincount(doc, given[tokens] + m.transition[before, own], minlength=n)
                known = np.bincount(doc, counts[tokens] > 0, minlength=n).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type), pa.array(row["held_out"], pa.bool_()),
                    pa.array(lengths + 1), pa.array(known), pa.array(np.full(n, m.tokens, np.int64)), pa.array(base), pa.array(score),
                    pa.array(10 ** np.minimum(300, -score / (lengths + 1))),
                ], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])
    return run


def score_documents(docs: DataFrame, clustered_words: int | None = None, k: int = CLASSES, rounds: int = ROUNDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the documents that are not held out and score all of them.

    ``clustered_words``: units of their own are at most so many of the most frequent words (by
    default all words of at least ``UNIT_COUNT`` occurrences).

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity``.
    """
    spark = docs.sparkSession
    docs = docs.select(docs[id].alias("doc_id"), docs[text].alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    buckets = shuffle_partitions(spark)
    blocks = stage(docs.mapInArrow(gather(buckets), f"block long, doc_ids array<{kind}>, held_out array<boolean>, lengths array<long>, codes binary, order binary, "
                                                    "lists array<struct<bucket:int,lengths:binary,words:binary,counts:binary>>"), "brown-blocks", "uncompressed")

    def counted_words(least):
        return stage_and_release(blocks.select("block", F.explode("lists").alias("part")).select("block", "part.*").repartition(buckets, "bucket")
                                 .mapInArrow(count_words(least), "block long, bucket int, home long, counts binary, units binary, seeds binary, "
                                             "sizes array<struct<n:bigint,words:bigint>>, shapes array<long>, total long"), "brown-counts", "uncompressed")
    counted = counted_words(UNIT_COUNT)
    if clustered_words is not None:
        counted = counted_words(max(UNIT_COUNT, least_count(counted.filter("block is null"), clustered_words)))
    summary = counted.filter("block is null")
    shapes = summed(summary, "shapes", SHAPES)
    total = summary.agg(F.sum("total")).first()[0] or 0
    trained = blocks.select(F.sum(F.size(F.filter("held_out", lambda h: ~h)))).first()[0] or 0
    homes = {r["home"]: unsqueeze(r["seeds"], np.uint16) for r in summary.select("home", "seeds").collect()}  # a row per task, 2 bytes per unit
    seeds = [homes.get(i, np.empty(0, np.uint16)) for i in range(max(homes, default=-1) + 1)]
    begins = FIRST_WORD + np.cumsum([0, *map(len, seeds)])
    seeds = np.concatenate([mix(np.arange(FIRST_WORD, dtype=U64)).astype(np.uint16), *seeds])

    def answered():
        answers = counted.filter("block is not null").groupBy("block").agg(F.collect_list(F.struct("bucket", "home", "counts", "units")).alias("answers"))
        return blocks.drop("lists").join(answers, "block", "left")
    adjacent = stage_and_release(answered().drop("doc_ids").mapInArrow(count_pairs(spark.sparkContext.broadcast(begins), len(seeds), buckets), "bucket int, right boolean, pairs binary, counts binary")
                                 .repartition(buckets, "bucket").mapInArrow(neighbours(len(seeds)), ", ".join(f"{c} binary" for c in NEIGHBOURS.names)), "brown-units", "uncompressed")
    classes, pairs = exchange(adjacent, seeds, k, rounds)
    model = spark.sparkContext.broadcast(Model(begins, classes, pairs, shapes, total, trained))
    return answered().mapInArrow(score_blocks(model), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def query(spark, sf_dir):
    return score_documents(table(spark, sf_dir, "documents", "doc_id", "text"))
