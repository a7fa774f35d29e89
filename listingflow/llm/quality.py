"""Quality rules: gradient-boosted trees over document statistics, with monotonic constraints.

Fixed rules come first (too short, or mostly repeated five-word windows).  The rest is judged by
trees trained here on labelled documents: good is quality 1 and toxic 0.  The statistics of a
document are numbers (lengths, symbols, repetition, case, ...) and the share of words that the
labels show as typical of toxic documents; that word list is found by Spark over the sample's
distinct texts, so copies do not lend a word weight.

The labelled sample is bounded by ``SAMPLE_ROWS`` (lowest hash of the id first), so what reaches
the driver for fitting is at most that many rows of numbers.  Chosen features are monotonic:
more symbols, more repetition or more toxic words never raise a score.  The fitted trees are
flat numpy node arrays, and every document of the whole table is scored by walking all rows
through them at once.

Edge cases: null or empty text has no words and fails the fixed rules; labels that disagree on
an id count as bad; labels with a null are skipped; without labels of both kinds the fixed rules
decide alone; repeated rows are judged each; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_blocks, stage, table, window_hashes, word_hashes

SAMPLE_ROWS = 20_000
MOST_TOXIC_WORDS = 500
REPEAT_WINDOW = 5
#: Words with at least so many toxic texts, and so many times likelier there than elsewhere.
LEAST_TOXIC_TEXTS, LEAST_TOXIC_LIFT = 5, 10.0
SYMBOLS = b"#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Feature -> direction in which the score may move as it grows (0: either).
FEATURES = {"log_words": 0, "word_length": 0, "symbols": -1, "dup_lines": -1, "repeats": -1, "upper": 0, "digits": 0, "wide": 0,
            "marks": 0, "distinct": 0, "line_words": 0, "bangs": -1, "toxic": -1, "toxic_words": -1}


def base_statistics(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text."""
    seen: set[bytes] = set()
    again = 0
    for line in text.split(b"\n"):
        if line in seen:
            again += 1
        elif line and not line.isspace():
            seen.add(line)
    n = len(words)
    repeated = 0
    if n > REPEAT_WINDOW:
        _, place, count = np.unique(window_hashes(word_hashes(words), REPEAT_WINDOW), return_inverse=True, return_counts=True)
        twice = count[place] > 1
        if twice.any():
            change = np.zeros(n + 1, np.int64)
            change[:len(twice)] += twice
            change[REPEAT_WINDOW:] -= twice
            repeated = int(np.count_nonzero(np.cumsum(change)[:n]))
    return n, len(b"".join(words).decode()), len(text) - len(text.translate(None, SYMBOLS)), again, repeated


_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b".,;:?"


def features(text: bytes, words: list[bytes], base: tuple, toxic: frozenset) -> list[float]:
    """The features of a document, in the order of ``FEATURES``."""
    n, chars, symbols, dup_lines, repeats = base
    size = max(1, len(text))

    def share(kind: bytes) -> float:
        return (len(text) - len(text.translate(None, kind))) / size
    lines = text.count(b"\n") + 1
    low = [w.strip(b".,;:!?\"'()").lower() for w in words] if toxic else []
    found = [w for w in low if w in toxic]
    return [np.log1p(n), chars / max(1, n), symbols / size, dup_lines / lines, repeats / max(1, n), share(_UPPER), share(_DIGITS),
            1 - chars / size, share(_MARKS), len(set(words)) / max(1, n), n / lines, share(b"!"), len(found) / max(1, n), float(min(len(set(found)), 20))]


class Trees:
    """Gradient-boosted trees as flat node arrays; a leaf is a node whose children are itself."""

    def __init__(self, feature, threshold, left, right, value, roots, start, depth):
        self.feature, self.threshold = np.array(feature, np.int32), np.array(threshold, np.float64)
        self.left, self.right = np.array(left, np.int32), np.array(right, np.int32)
        self.value, self.roots, self.start, self.depth = np.array(value, np.float64), np.array(roots, np.int32), start, depth

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of good for every row."""
        node = np.repeat(self.roots[None, :], len(x), axis=0)
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return self.start + self.value[node].sum(axis=1)


def fit_trees(x: np.ndarray, good: np.ndarray, directions: list[int], trees: int = 80, depth: int = 4, rate: float = 0.2,
              bins: int = 48, least: int = 20, ridge: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss on binned features under monotonic directions."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    y = good.astype(np.float64)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    score = np.full(len(y), start)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def add(v: float) -> int:
        for a, b in ((feature, 0), (threshold, np.inf), (left, len(feature)), (right, len(right)), (value, v)):
            a.append(b)
        return len(feature) - 1

    def grow(rows: np.ndarray, low: float, high: float, level: int, g: np.ndarray, h: np.ndarray) -> int:
        G, H = g[rows].sum(), h[rows].sum()
        node = add(float(np.clip(G / (H + ridge), low, high)) * rate)
        score[rows] = before[rows] + value[node]
        if level == depth or len(rows) < 2 * least:
            return node
        best = (1e-6, 0, 0, 0.0, 0.0)
        for f, e in enumerate(edges):
            if not len(e):
                continue
            b = binned[rows, f]
            gs, hs, ns = (np.cumsum(np.bincount(b, w, minlength=len(e) + 1))[:-1] for w in (g[rows], h[rows], None))
            lv, rv = np.clip(gs / (hs + ridge), low, high), np.clip((G - gs) / (H - hs + ridge), low, high)
            gain = 2 * gs * lv - (hs + ridge) * lv ** 2 + 2 * (G - gs) * rv - (H - hs + ridge) * rv ** 2 - G * G / (H + ridge)
            gain[(ns < least) | (len(rows) - ns < least) | (directions[f] * (rv - lv) < 0)] = -np.inf
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), f, k, float(lv[k]), float(rv[k]))
        if best[0] > 1e-6:
            _, f, k, lv, rv = best
            mid = (lv + rv) / 2
            lows, highs = (low, mid, mid, high)[::2], (low, mid, mid, high)[1::2]
            if directions[f] == 0:
                lows, highs = (low, low), (high, high)
            elif directions[f] < 0:
                lows, highs = lows[::-1], highs[::-1]
            below = binned[rows, f] <= k
            a = grow(rows[below], lows[0], highs[0], level + 1, g, h)
            b = grow(rows[~below], lows[1], highs[1], level + 1, g, h)
            feature[node], threshold[node], left[node], right[node] = f, float(edges[f][k]), a, b
        return node

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        before = score.copy()
        roots.append(grow(np.arange(len(y)), -np.inf, np.inf, 0, y - p, p * (1 - p)))
    return Trees(feature, threshold, left, right, value, roots, start, depth)


def toxic_words(labelled: DataFrame) -> frozenset:
    """Words typical of toxic texts, at most ``MOST_TOXIC_WORDS``."""
    texts = labelled.groupBy("text").agg(F.max("toxic").alias("toxic"))

    def count(batches):
        seen = {0: Counter(), 1: Counter()}
        for rows, values in in_blocks(batches, "text"):
            for text, toxic in zip(values, rows.column("toxic").to_pylist()):
                seen[int(toxic > 0)].update({w.strip(b".,;:!?\"'()").lower() for w in text.split()})
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array([seen[1][w] for w in names], pa.int64()),
                                          pa.array([seen[0][w] for w in names], pa.int64())], names=["word", "bad", "fine"])
    many = {r["t"]: r["n"] for r in texts.groupBy((F.col("toxic") > 0).alias("t")).agg(F.count("*").alias("n")).collect()}
    if not many.get(True) or not many.get(False):
        return frozenset()
    rows = (texts.mapInArrow(count, "word binary, bad long, fine long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine"))
            .filter((F.col("bad") >= LEAST_TOXIC_TEXTS) & (F.col("bad") / many[True] >= LEAST_TOXIC_LIFT * (F.col("fine") + 0.5) / many[False]))
            .orderBy(F.desc("bad"), "word").limit(MOST_TOXIC_WORDS).collect())
    return frozenset(bytes(r["word"]) for r in rows if r["word"])


class Rules:
    """Fixed rules, word list and trees: what judges a document."""

    def __init__(self, toxic: frozenset = frozenset(), trees: Trees | None = None):
        self.toxic, self.trees = toxic, trees

    def judge(self, texts: list[bytes]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """Base statistics, whether the fixed rules fail, and whether the text is kept."""
        base, rows = [], []
        for text in texts:
            words = text.split()
            base.append(base_statistics(text, words))
            rows.append(features(text, words, base[-1], self.toxic))
        n, repeats = np.array([b[0] for b in base]), np.array([b[4] for b in base])
        failed = (n < 10) | (100 * repeats > 20 * n)
        good = self.trees.score(np.array(rows)) >= 0 if self.trees else np.ones(len(texts), bool)
        return base, failed, good & ~failed


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Rules:
    """Fit the rules on at most ``sample_rows`` labelled ids."""
    sample = (labels.select("doc_id", "quality", "toxic").dropna().groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    labelled = stage(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id"), "quality-labelled")
    toxic = toxic_words(labelled)

    def numbers(batches):
        for rows, texts in in_blocks(batches, "text"):
            values = []
            for text in texts:
                words = text.split()
                values.append(features(text, words, base_statistics(text, words), toxic))
            good = [q >= 1 and t <= 0 for q, t in zip(rows.column("quality").to_pylist(), rows.column("toxic").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.list_(pa.float64())), pa.array(good)], names=["x", "good"])
    rows = labelled.dropDuplicates(["doc_id"]).select("text", "quality", "toxic").mapInArrow(numbers, "x array<double>, good boolean").orderBy("x", "good").collect()
    good = np.array([r["good"] for r in rows], bool)
    if not good.any() or good.all():
        return Rules(toxic)
    return Rules(toxic, fit_trees(np.array([r["x"] for r in rows], np.float64), good, list(FEATURES.values())))


def judge_documents(docs: DataFrame, rules: Rules) -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed`` and ``kept`` of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(rules)

    def run(batches):
        for rows, texts in in_blocks(batches, "text"):
            base, failed, kept = shared.value.judge(texts)
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(rows.column("doc_id").chunks), *(pa.array([b[i] for b in base], pa.int64()) for i in range(5)),
                                              pa.array(failed), pa.array(kept)], names=["doc_id", *BASE, "base_failed", "kept"])
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{b} long" for b in BASE) + ", base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, rules: Rules) -> DataFrame:
    """The documents, all columns, that the rules keep."""
    shared = docs.sparkSession.sparkContext.broadcast(rules)

    def run(batches):
        for rows, texts in in_blocks(batches, "text"):
            yield from rows.filter(pa.array(shared.value.judge(texts)[2])).to_batches()
    return docs.mapInArrow(run, docs.schema)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return judge_documents(docs, train(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")))


def pipeline_stage(spark, docs, sf_dir):
    """Documents that the rules reject go."""
    return keep_good(docs, train(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")))
