"""Plain-Python versions of the operators' contracts, and awkward fixtures."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def awkward_documents() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, extra) with nulls, ties, repeats and long texts."""
    rng = random.Random(7)
    vocabulary = ["the", "of", "naïve", "Ünder", "don't", "x1", "zebra", "alpha", "beta", "gamma", "delta", "a.b", "中文", "e f", "42", "Z", "q<|endoftext|>r"]

    def prose(n):
        return " ".join(rng.choice(vocabulary) + (rng.choice(["", "", ".", ",", "\n"])) for _ in range(n))
    base = prose(120)
    passage = " ".join(f"pass{i}" for i in range(60))
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1), (3, base.replace("zebra", "zebu", 1), "en", "b", 1),
        (4, None, None, None, None), (5, "", "en", "a", 0), (6, "   \n\t ", "en", "c", 3), (7, "one", "en", "a", 3), (8, "one two three", "fr", "a", 9),
        (9, "ONE two  three", "fr", "a", 9), (None, base, "en", "a", 1), (None, None, "en", None, 1), (10, prose(30) + " " + passage, "en", "a", 1),
        (11, passage + " " + prose(25), "en", "b", 1), (12, "w" * 5000, "en", "a", 1), (13, prose(4000), "en", "a", 1), (14, passage + " " + passage, "de", "a", 1),
        (15, "a  b   c \n\n d\t\te  <|endoftext|>  f", "en", "a", 1), (16, "tail  ", "en", "a", 1), (17, "  lead wide 　 x", "en", "a", 1),
        (-5, prose(80), "en", "d", 1), (18, "same same same same same same same same same same", "en", "a", 1), (61, "W\u030a H\u0331 中文<|ENDOFTEXT|> E\u0301 =\u0338", "en", "a", 1), (19, "\x1c \x85 a\x1fb\x00c", "en", "a", 1),
    ]
    for i in range(20, 60):
        words = base.split(" ")
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(["swap", "edit", "new"])
        rows.append((i, " ".join(words), "en", "a", 1))
    return [(*r, "x") for r in rows]


DOCUMENT_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string"


def shingles(text: str | None, size: int) -> frozenset:
    w = WORD.findall(lower(text or ""))
    if not w:
        return frozenset()
    k = min(size, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def component_ids(rows: list[tuple], size: int, similarity: int) -> list[tuple]:
    """(doc_id, n_shingles, component_id) per (doc_id, text)."""
    sets = [shingles(t, size) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    least: dict = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def repeats(rows: list[tuple], window: int = 20) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256) per (doc_id, text); nulls last, ties in row order."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, out = set(), []
    for i in order:
        w = WORD.findall(rows[i][1] or "")
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            g = tuple(w[s:s + window])
            if g in seen:
                gone[s:s + window] = [True] * window
            seen.add(g)
        out.append((rows[i][0], len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return out


def benchmark_hits(rows: list[tuple], items: list[tuple], length: int = 10) -> list[tuple]:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per (doc_id, text)."""
    windows: dict = {}
    for name, text in items:
        w = NORMAL.findall(lower(text or ""))
        k = min(length, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add("" if name is None else str(name))
    out = []
    for d, text in rows:
        w = NORMAL.findall(lower(text or ""))
        hit, found = [False] * len(w), set()
        for k in {len(g) for g in windows}:
            for i in range(len(w) - k + 1):
                names = windows.get(tuple(w[i:i + k]))
                if names:
                    hit[i:i + k] = [True] * k
                    found |= names
        out.append((d, len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), any(hit)))
    return out


def quality_base(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    count: dict = {}
    for i in range(len(w) - 4):
        count[tuple(w[i:i + 5])] = count.get(tuple(w[i:i + 5]), 0) + 1
    mark = [False] * len(w)
    for i in range(len(w) - 4):
        if count[tuple(w[i:i + 5])] > 1:
            mark[i:i + 5] = [True] * 5
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, sum(mark)


def crc_ids(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()
