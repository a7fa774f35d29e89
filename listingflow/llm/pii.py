"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns (e-mail, IP, card, phone) always count.  The tagger adds spans they are too narrow
for: numbers without a plus, other separators, ``name (at) host``, accented names.  It is trained
here, in numpy, on labelled spans of the corpus: a bounded sample of the patterns' own finds
(``SAMPLE_SPANS`` of each kind, lowest hash of the snippet first), each once as found and
``VARIANTS`` times written in another way, and of snippets with digits that are no finds.

Texts are cut into windows of ``WINDOW`` characters, every ``STRIDE``; each window is decoded by
Viterbi, and the windows' spans are reconciled over the whole text: a span cut by a window's edge
yields to the neighbour that sees it whole, pieces that touch are joined, and of overlapping spans
the one with the larger margin over "nothing" stays.  An added span must be a whole token run that
reads as its kind (checksum, ranges, digit counts), so it holds a digit or an at sign; windows without
any are not decoded, which changes nothing.  Added spans overlap a pattern's find only if they
contain finds of their own kind and nothing else.

Edge cases: null and empty texts have no spans; repeated rows are each judged; without any find
in the table the patterns decide alone; a kind without finds is never added; other columns are
ignored; offsets are code points.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from bisect import bisect_left
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listingflow.session import ship_package

from .common import in_blocks, table

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 96, 48
#: Training: finds of each kind, snippets without a find, rewritten forms of each find.
SAMPLE_SPANS, SAMPLE_OTHERS, VARIANTS = 200, 300, 3
CONTEXT = 40
HIDDEN, EPOCHS, BATCH, RATE = 24, 8, 48, 0.012
#: Windows decoded at once.
MOST_WINDOWS = 1024

# ------------------------------------------------------------------ patterns
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A leftmost match can only begin where a run of digits begins, which keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits_of(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    twice = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(twice)) % 10 == 0


def emails(text: str) -> Iterable[tuple[int, int]]:
    """Matches of local part, at sign and dotted domain, in time linear in the text."""
    least, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > least and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            least = domain.end()
        else:
            least = at + 1
        at = text.find("@", least)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the patterns' matches, in order."""
    out = [(a, 0, b) for a, b in emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m.group())) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(digits_of(m.group())) <= 15]
    return sorted(out)


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


# ------------------------------------------------------------------ the tagger
#: Labels: 0 nothing, then begin and inside of each kind.
N_LABELS = 1 + 2 * len(KINDS)
_DIGIT, _WIDE_SPACE, _DASH, _WIDE, _PAD = ord("0"), 128, 129, 130, 131
N_CLASSES = 132
_CLASS = np.full(0x10000, _WIDE, np.uint8)
_CLASS[:128] = np.arange(128)
_CLASS[48:58] = _DIGIT
_CLASS[[0x85, 0xA0, 0x202F, 0x3000, *range(0x2000, 0x200B)]] = _WIDE_SPACE
_CLASS[range(0x2010, 0x2016)] = _DASH


def classes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASS[np.minimum(points, 0xFFFF)]


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def lstm(z: np.ndarray, u: np.ndarray):
    """Hidden states, gates and cells for pre-activations ``z`` (steps, rows, 4 * hidden)."""
    steps, rows, wide = z.shape
    n = wide // 4
    gates, cells, hidden = np.empty_like(z), np.empty((steps, rows, n), z.dtype), np.empty((steps, rows, n), z.dtype)
    h = c = np.zeros((rows, n), z.dtype)
    for t in range(steps):
        a = z[t] + h @ u
        a[:, :3 * n] = _sigmoid(a[:, :3 * n])
        a[:, 3 * n:] = np.tanh(a[:, 3 * n:])
        c = a[:, n:2 * n] * c + a[:, :n] * a[:, 3 * n:]
        h = a[:, 2 * n:3 * n] * np.tanh(c)
        gates[t], cells[t], hidden[t] = a, c, h
    return hidden, gates, cells


def lstm_gradient(dh: np.ndarray, u: np.ndarray, hidden, gates, cells):
    """Gradients of ``lstm`` with respect to ``z`` and ``u``."""
    steps, rows, n = hidden.shape
    dz = np.empty_like(gates)
    later, dc = np.zeros((rows, n), dh.dtype), np.zeros((rows, n), dh.dtype)
    for t in range(steps - 1, -1, -1):
        i, f, o, g = (gates[t, :, k * n:(k + 1) * n] for k in range(4))
        d, th = dh[t] + later, np.tanh(cells[t])
        dc = dc + d * o * (1 - th * th)
        before = cells[t - 1] if t else np.zeros_like(th)
        dz[t, :, :n] = dc * g * i * (1 - i)
        dz[t, :, n:2 * n] = dc * before * f * (1 - f)
        dz[t, :, 2 * n:3 * n] = d * th * o * (1 - o)
        dz[t, :, 3 * n:] = dc * i * (1 - g * g)
        later, dc = dz[t] @ u.T, dc * f
    du = np.tensordot(hidden[:-1], dz[1:], axes=([0, 1], [0, 1]))
    return dz, du


class Tagger:
    """Two LSTMs over character classes, a linear layer and CRF transitions."""

    def __init__(self, hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)

        def draw(*shape, scale):
            return (rng.normal(size=shape) * scale).astype(np.float32)
        self.p = {"start": np.zeros(N_LABELS, np.float32), "next": np.zeros((N_LABELS, N_LABELS), np.float32),
                  "out": draw(2 * hidden, N_LABELS, scale=0.2), "bias": np.zeros(N_LABELS, np.float32)}
        for side in "fb":
            self.p["x" + side] = draw(N_CLASSES, 4 * hidden, scale=0.4)
            self.p["u" + side] = draw(hidden, 4 * hidden, scale=hidden ** -0.5)
            self.p["x" + side][:, hidden:2 * hidden] += 1.0  # remember at first
        self.kinds: frozenset[int] = frozenset(range(len(KINDS)))

    def states(self, x: np.ndarray):
        """Both LSTMs over windows ``x`` (rows, steps): outputs in reading order, and what the gradients need."""
        x = x.T
        forward = lstm(self.p["xf"][x], self.p["uf"])
        backward = lstm(self.p["xb"][x[::-1]], self.p["ub"])
        return np.concatenate([forward[0], backward[0][::-1]], axis=2), forward, backward

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return self.states(x)[0] @ self.p["out"] + self.p["bias"]

    def loss(self, x: np.ndarray, y: np.ndarray):
        """Mean negative log-likelihood of the labels ``y`` and its gradients."""
        p, y = self.p, y.T
        both, forward, backward = self.states(x)
        e = both @ p["out"] + p["bias"]
        steps, rows, _ = e.shape
        # forward and backward in linear space, every step scaled to a sum of one
        top = e.max(axis=2, keepdims=True)
        weight, ways = np.exp(e - top), np.exp(p["next"])
        alpha, beta, scale = np.empty_like(e), np.ones_like(e), np.empty((steps, rows, 1), e.dtype)
        for t in range(steps):
            alpha[t] = (alpha[t - 1] @ ways if t else np.exp(p["start"])) * weight[t]
            scale[t] = alpha[t].sum(axis=1, keepdims=True)
            alpha[t] /= scale[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = (weight[t + 1] * beta[t + 1] / scale[t + 1]) @ ways.T
        total = (np.log(scale) + top).sum(axis=(0, 2))
        share = alpha * beta
        pairs = alpha[:-1].reshape(-1, N_LABELS).T @ (weight[1:] * beta[1:] / scale[1:]).reshape(-1, N_LABELS) * ways
        at, row = np.arange(steps)[:, None], np.arange(rows)
        gold = e[at, row, y].sum(axis=0) + p["next"][y[:-1], y[1:]].sum(axis=0) + p["start"][y[0]]
        np.add.at(pairs, (y[:-1], y[1:]), -1)
        de = share
        de[at, row, y] -= 1
        de /= rows
        flat = de.reshape(-1, N_LABELS)
        grads = {"start": de[0].sum(axis=0), "next": pairs / rows, "bias": flat.sum(axis=0), "out": both.reshape(len(flat), -1).T @ flat}
        dh = de @ p["out"].T
        n = dh.shape[2] // 2
        for side, d, kept, seen in (("f", dh[:, :, :n], forward, x.T), ("b", dh[::-1, :, n:], backward, x.T[::-1])):
            dz, grads["u" + side] = lstm_gradient(d, p["u" + side], *kept)
            one = np.zeros((N_CLASSES, dz.shape[0] * dz.shape[1]), np.float32)
            one[seen.reshape(-1), np.arange(one.shape[1])] = 1
            grads["x" + side] = one @ dz.reshape(one.shape[1], -1)
        return float((total - gold).mean()), grads

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, seed: int = 2) -> float:
        """Adam on shuffled batches; returns the last epoch's mean loss."""
        rng = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step, mean = 0, 0.0
        steps = epochs * -(-len(x) // batch)
        for _ in range(epochs):
            order, losses = rng.permutation(len(x)), []
            for begin in range(0, len(x), batch):
                rows = order[begin:begin + batch]
                loss, grads = self.loss(x[rows], y[rows])
                losses.append(loss)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                step += 1
                slow = rate * (1 - 0.9 * step / steps)
                for k, g in grads.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    self.p[k] -= (slow * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
            mean = float(np.mean(losses))
        return mean

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi labels of every window, and each label's emission over that of "nothing"."""
        e = self.emissions(x)
        steps, rows, _ = e.shape
        back = np.empty((steps, rows, N_LABELS), np.int8)
        score = self.p["start"] + e[0]
        for t in range(1, steps):
            ways = score[:, :, None] + self.p["next"]
            back[t] = ways.argmax(axis=1)
            score = e[t] + ways.max(axis=1)
        labels = np.empty((steps, rows), np.int8)
        labels[-1] = score.argmax(axis=1)
        row = np.arange(rows)
        for t in range(steps - 1, 0, -1):
            labels[t - 1] = back[t, row, labels[t]]
        margin = e[np.arange(steps)[:, None], row, labels] - e[:, :, 0]
        return labels.T, margin.T


# ------------------------------------------------------------------ windows and their reconciliation
_SPELT_AT = re.compile(r"[(\[{] ?at ?[)\]}]")


def window_starts(anchors: np.ndarray) -> np.ndarray:
    """Starts of the windows that hold an anchor."""
    of = anchors // STRIDE
    return np.unique(np.concatenate([of, np.maximum(of - 1, 0)])) * STRIDE


def runs(labels: np.ndarray, margin: np.ndarray) -> list[tuple[int, int, int, float]]:
    """``(start, kind, end, margin)`` of the labelled runs of one window."""
    out: list[tuple[int, int, int, float]] = []
    begin = 0
    for t in range(1, len(labels) + 1):
        old, new = labels[t - 1], labels[t] if t < len(labels) else 0
        goes_on = old and new and new % 2 == 0 and (new - 1) // 2 == (old - 1) // 2
        if old and not goes_on:
            out.append((begin, (int(old) - 1) // 2, t, float(margin[begin:t].sum())))
        if not goes_on:
            begin = t
    return out


def reconcile(found: list[tuple[int, int, int, float, bool, bool]]) -> list[tuple[int, int, int]]:
    """One set of spans from those of all windows: ``(start, kind, end, margin, cut at the left, cut at the right)``."""
    joined: list[list] = []
    open_: dict[int, list[list]] = {}  # per kind, those that a later span may still touch
    for a, k, b, m, left, right in sorted(found):
        reach = open_[k] = [j for j in open_.get(k, ()) if a <= j[2]]
        last = next((j for j in reversed(reach) if left or j[5] or b <= j[2]), None)
        if last is None:
            joined.append([a, k, b, m, left, right])
            reach.append(joined[-1])
        elif b > last[2]:
            last[2], last[3], last[5] = b, max(last[3], m), right
        else:
            last[3] = max(last[3], m)
    taken: list[tuple[int, int, int]] = []  # sorted; none overlaps another, so only the neighbours can be met
    for a, k, b, m, *_ in sorted(joined, key=lambda j: (-j[3], j[0], j[1])):
        at = bisect_left(taken, (a,))
        if (not at or taken[at - 1][2] <= a) and (at == len(taken) or b <= taken[at][0]):
            taken.insert(at, (a, k, b))
    return taken


_AT = re.compile(r"\s*(?:@|[(\[{]\s*at\s*[)\]}])\s*", re.I)
_DOT = re.compile(r"\s*(?:[(\[{]\s*(?:dot|\.)\s*[)\]}])\s*", re.I)
_MAIL = re.compile(r"[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_DATE = re.compile(r"(?:19|20)\d\d[-./ ]\d{1,2}[-./ ]\d{1,2}|\d{1,2}[-./ ]\d{1,2}[-./ ](?:19|20)\d\d")
_NUMBER = re.compile(r"[+(]?[0-9][0-9\s().\-/‐-―]*[0-9]")


def reads_as(kind: int, text: str) -> bool:
    """Whether a span found by the tagger is a well-formed value of its kind."""
    if kind == 0:
        return bool(_MAIL.fullmatch(_DOT.sub(".", _AT.sub("@", text))))
    d = digits_of(text)
    if kind == 1:
        parts = re.split(r"\s*[(\[{]?\s*\.\s*[)\]}]?\s*", text)
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if not _NUMBER.fullmatch(text):
        return False
    if kind == 2:
        return 13 <= len(d) <= 19 and luhn(d) and len(set(d)) > 1 and not re.search(r"[()]", text)
    return 10 <= len(d) <= 15 and len(d) < len(text) and len(set(d)) > 1 and not _DATE.match(text) and len(re.findall("[0-9]+", text)) <= 6


def trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """Without blanks and closing marks at its edges."""
    while b > a and not text[b - 1].isalnum():
        b -= 1
    while a < b and not (text[a].isalnum() or text[a] in "+("):
        a += 1
    return a, b


def added_spans(text: str, base: list[tuple[int, int, int]], found: list[tuple[int, int, int]], kinds: frozenset[int]) -> list[tuple[int, int, int]]:
    """The reconciled spans that are accepted beside the patterns' own."""
    out = []
    for a, k, b in found:
        a, b = trimmed(text, a, b)
        whole = a < b and not (a and (text[a - 1].isalnum() or text[a - 1] in "@_")) and not (b < len(text) and (text[b].isalnum() or text[b] in "@_"))
        if whole and k in kinds and reads_as(k, text[a:b]):
            met = [s for s in base if a < s[2] and s[0] < b]
            if all(s[1] == k and a <= s[0] and s[2] <= b and (a, b) != (s[0], s[2]) for s in met):
                out.append((a, k, b))
    return sorted(set(out))


def tag(model: Tagger, texts: list[tuple[str, np.ndarray]]) -> list[list[tuple[int, int, int]]]:
    """Reconciled spans per ``(text, anchors)``; windows of all texts share the batches."""
    found: list[list] = [[] for _ in texts]
    rows, where = [], []

    def flush():
        if rows:
            labels, margin = model.decode(np.stack(rows))
            for r in np.flatnonzero(labels.any(axis=1)):
                i, start, size = where[r]
                for a, k, b, m in runs(labels[r], margin[r]):
                    if a + start < size:
                        found[i].append((a + start, k, min(b + start, size), m, a == 0 and start > 0, b == WINDOW and start + WINDOW < size))
            rows.clear()
            where.clear()
    for i, (text, anchors) in enumerate(texts):
        codes = classes_of(text)
        for start in window_starts(anchors).tolist():
            part = codes[start:start + WINDOW]
            rows.append(part if len(part) == WINDOW else np.concatenate([part, np.full(WINDOW - len(part), _PAD, np.uint8)]))
            where.append((i, start, len(codes)))
            if len(rows) == MOST_WINDOWS:
                flush()
    flush()
    return [reconcile(f) for f in found]


def with_anchors(texts: list[bytes]) -> list[tuple[int, str, np.ndarray]]:
    """``(number, text, positions of digits and at signs)`` of the texts that have any."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    hit = np.flatnonzero((raw - np.uint8(48) <= 9) | (raw == 64))
    ends = np.cumsum([len(t) for t in texts])
    first = np.searchsorted(hit, np.concatenate([[0], ends]))
    out = []
    for i, t in enumerate(texts):
        spelt = b"at" in t and (b"(at" in t or b"( at" in t or b"[at" in t or b"[ at" in t or b"{at" in t or b"{ at" in t)
        if first[i + 1] > first[i] or spelt:
            text = t.decode("utf-8", "replace")
            at = hit[first[i]:first[i + 1]] - (ends[i] - len(t))
            if len(text) != len(t):  # bytes before, less those that continue a character
                at = at - np.cumsum((np.frombuffer(t, np.uint8) & 0xC0) == 0x80)[at]
            if spelt:
                at = np.concatenate([at, [m.start() for m in _SPELT_AT.finditer(text)]]).astype(np.int64)
            out.append((i, text, at))
    return out


# ------------------------------------------------------------------ training from the corpus
def snippets(batches):
    """Task function: the snippets of lowest hash per kind, as ``kind, hash, before, span, after``."""
    best: dict[int, dict[int, tuple]] = {k: {} for k in range(len(KINDS) + 1)}

    def offer(kind, text, a, b):
        row = (text[max(0, a - CONTEXT):a], text[a:b], text[b:b + CONTEXT])
        if b - a > WINDOW // 2:
            return
        h = xxhash.xxh3_64_intdigest("\0".join(row).encode("utf-8", "replace")) >> 1
        best[kind][h] = row
        most = SAMPLE_SPANS if kind < len(KINDS) else SAMPLE_OTHERS
        if len(best[kind]) > 4 * most:
            best[kind] = {x: best[kind][x] for x in sorted(best[kind])[:most]}
    for _, texts in in_blocks(batches, "text"):
        for _, text, anchors in with_anchors(texts):
            base = base_spans(text)
            for a, k, b in base:
                offer(k, text, a, b)
            last = -1
            edge = np.array([(a - 1, b + 1) for a, _, b in base] or [(0, 0)]).reshape(-1, 2)
            for p in anchors[~((anchors[:, None] >= edge[:, 0]) & (anchors[:, None] < edge[:, 1])).any(axis=1)].tolist() if len(base) < 200 else []:
                if p > last:
                    offer(len(KINDS), text, p, p + 1)
                    last = p + CONTEXT
    rows = [(k, h, *row) for k, found in best.items() for h, row in sorted(found.items())[:SAMPLE_SPANS if k < len(KINDS) else SAMPLE_OTHERS]]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string()))],
                                     names=["kind", "h", "before", "span", "after"])


def sample(docs: DataFrame) -> list[tuple]:
    """At most ``SAMPLE_SPANS`` finds of each kind and ``SAMPLE_OTHERS`` other snippets, no two alike."""
    most = F.when(F.col("kind") < len(KINDS), SAMPLE_SPANS).otherwise(SAMPLE_OTHERS)
    place = F.row_number()
    rows = (docs.select("text").mapInArrow(snippets, "kind int, h long, before string, span string, after string").dropDuplicates(["kind", "h"])
            .withColumn("part", F.pmod("h", F.lit(64)))  # first the best of many parts, so that no kind is one task
            .withColumn("place", place.over(Window.partitionBy("kind", "part").orderBy("h"))).filter(F.col("place") <= most)
            .withColumn("place", place.over(Window.partitionBy("kind").orderBy("h"))).filter(F.col("place") <= most)
            .orderBy("kind", "place").collect())
    return [(r["kind"], r["before"], r["span"], r["after"]) for r in rows]


def _digits(rng, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def rewritten(kind: int, span: str, rng) -> str:
    """The same kind of value, spelt in a way that the patterns need not match."""
    pick = lambda *x: x[int(rng.integers(len(x)))]
    if kind == 0:
        local, host = span.split("@", 1)
        if rng.random() < 0.4 and len(local) > 2:
            at = int(rng.integers(0, len(local)))
            local = local[:at] + pick("é", "ñ", "ü", "ß", "ø", "ś") + local[at:]
        name = lambda least, most: "".join(chr(97 + int(c)) for c in rng.integers(0, 26, int(rng.integers(least, most))))
        if rng.random() < 0.6:  # the corpus may know few hosts
            host = ".".join([*(name(2, 10) + pick("", "", _digits(rng, 1)) for _ in range(int(rng.integers(1, 3)))), pick("com", "org", "net", name(2, 4))])
        if rng.random() < 0.4:
            local = name(2, 8) + pick(".", "_", "-", "") + name(1, 9) + pick("", _digits(rng, 2))
        at = pick("@", " @ ", "(at)", " (at) ", "[at]", " [at] ")
        return local + at + (host.replace(".", pick(".", "[.]", " [dot] ", "(dot)")) if at != "@" else host)
    if kind == 1:
        return pick(".", "[.]", " . ", "(.)").join(str(x) for x in rng.integers(0, 256, 4))
    if kind == 2:
        n = int(pick(13, 14, 15, 16, 16, 16, 19))
        d = _digits(rng, n - 1)
        d += next(c for c in "0123456789" if luhn(digits_of(d + c)))
        mark = pick("", " ", "-", ".", "/", " ", "–", " - ")
        return mark.join(d[i:i + 4] for i in range(0, n, 4))
    a, b, c = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    mark = pick("-", ".", " ", " ", "/", "‑")
    area = pick(f"({a}) ", f"({a})", a + mark, a + mark, a + mark)
    ahead = pick("", "", "", "", "1" + mark, "+1" + mark, "00" + _digits(rng, 2) + mark, "+" + _digits(rng, 2) + " ")
    return ahead + area + b + mark + c


def other_number(rng) -> str:
    """Digits that are nobody's: dates, times, amounts, versions, codes."""
    a, b, c = (int(x) for x in rng.integers(1, 29, 3))
    year = int(rng.integers(1950, 2035))
    return [f"{year}-{a % 12 + 1:02d}-{b:02d}", f"{b}.{a % 12 + 1}.{year}", f"{b}/{a % 12 + 1}/{year}", f"{a % 24}:{b:02d}:{c:02d}", f"v{a}.{b}.{c}", f"{a},{_digits(rng, 3)}.{b:02d}",
            f"{year}", f"#{_digits(rng, 6)}", _digits(rng, int(rng.integers(1, 13))), rng.bytes(int(rng.integers(8, 21))).hex(), f"{a}-{b}", f"({year})",
            f"{year}-{a % 12 + 1:02d}-{b:02d} {a % 24:02d}:{b:02d}:{c:02d}", f"{a}.{b}", f"user{a}", f"@{_digits(rng, 2)}", f"ISBN 978-{a}-{_digits(rng, 4)}"][int(rng.integers(17))]


def training_windows(rows: list[tuple], seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Windows and labels: every find as it is and rewritten, other snippets as they are and with other numbers."""
    rng = np.random.default_rng(seed)
    x, y = [], []

    def put(kind, before, span, after):
        text = (before + span + after)
        begin, end = len(before), len(before) + len(span)
        cut = int(rng.integers(0, max(1, min(begin, len(text) - 20)) + 1))
        part = classes_of(text[cut:cut + WINDOW])
        row, labels = np.full(WINDOW, _PAD, np.uint8), np.zeros(WINDOW, np.int8)
        row[:len(part)] = part
        if kind < len(KINDS) and begin - cut < WINDOW:
            a, b = max(0, begin - cut), min(WINDOW, end - cut)
            labels[a:b] = 2 * kind + 2
            if begin >= cut:
                labels[a] = 2 * kind + 1
        x.append(row)
        y.append(labels)
    calm = [r for r in rows if r[0] == len(KINDS)] or rows
    for kind, before, span, after in rows:
        put(kind, before, span, after)
        for n in range(VARIANTS if kind < len(KINDS) else 1):
            _, left, _, right = calm[int(rng.integers(len(calm)))]
            left, right = re.sub(r"[0-9@+]", "", left).rstrip() + " ", " " + re.sub(r"[0-9@+]", "", right).lstrip()
            put(kind, left, rewritten(kind, span, rng) if kind < len(KINDS) else other_number(rng), right)
            if not n:
                put(len(KINDS), left, other_number(rng), right)
    return np.stack(x), np.stack(y)


def train(docs: DataFrame, epochs: int = EPOCHS) -> Tagger | None:
    """A tagger for the kinds found in ``docs`` (None: there are none)."""
    ship_package(docs.sparkSession)
    rows = sample(docs)
    kinds = frozenset(r[0] for r in rows) - {len(KINDS)}
    if not kinds:
        return None
    # the bounded sample is fitted inside one task: one core, and nothing runs on the driver
    def run(batches):
        for batch in batches:
            model = Tagger()
            model.fit(*training_windows([tuple(r.values()) for r in batch.to_pylist()[0]["rows"]]), epochs=epochs)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model.p)], pa.binary())], names=["model"])
    given = docs.sparkSession.createDataFrame([(rows,)], "rows array<struct<kind:int,before:string,span:string,after:string>>").coalesce(1)
    model = Tagger()
    model.p = pickle.loads(bytes(given.mapInArrow(run, "model binary").first()["model"]))
    model.kinds = kinds
    return model


def find_spans(docs: DataFrame, model: Tagger | None) -> DataFrame:
    """``doc_id``, counts of the patterns' finds by kind, ``base_sha256``, ``spans`` and ``n_added``."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for rows, texts in in_blocks(batches, "text"):
            some = with_anchors(texts)
            base: list[list] = [[] for _ in texts]
            more: list[list] = [[] for _ in texts]
            for i, text, _ in some:
                base[i] = base_spans(text)
            if shared.value is not None:
                for (i, text, _), found in zip(some, tag(shared.value, [(t, a) for _, t, a in some])):
                    more[i] = added_spans(text, base[i], found, shared.value.kinds)
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays(rows.column("doc_id").chunks), *(pa.array([sum(s[1] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))),
                pa.array([hashlib.sha256(spans_text(b).encode()).hexdigest() for b in base], pa.string()),
                pa.array([spans_text(b + m) for b, m in zip(base, more)], pa.string()), pa.array([len(m) for m in more], pa.int64())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long")


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return find_spans(docs, train(docs))
