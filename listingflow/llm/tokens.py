"""Tokenising many texts inside a task with every distinct chunk encoded once.

A public tokenizer treats the chunks between safe cuts independently, so a worker keeps each
chunk's ids and builds a text's ids by concatenation.  Chunks are found, hashed and looked up for a
whole block at once, in arrays and without an object for each; a hash only proposes a known chunk,
whose bytes are then compared.  Safe cuts:

* ``word`` tokenizers drop white space and case: every run of ASCII white space is a cut;
* ``byte`` tokenizers glue one space to the following word: a cut lies before each white-space
  run as their own pattern splits it;
* both end a run of letters or digits at punctuation: a cut lies between an ASCII letter or digit
  and an ASCII punctuation mark (not the other way round: ``'s`` is one piece).

A text that holds one of the tokenizer's special strings, or (``byte``) white space beyond ASCII,
is one chunk of its own: the library then sees it whole.  Chunks of ``word`` tokenizers share their
ids whatever their case, but A-Z are lowered ahead of the library only where that cannot matter: not
where a letter could combine with what follows (it composes accents first), and not where lowering
would spell a special string.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import chain

import numpy as np

from .common import BYTE_MASKS, Words, eights

#: A run up to white space; else up to punctuation after an ASCII letter or digit; else the rest.
_RUN = (rb"(?:[A-Za-z0-9\x80-\xff]+(?![^ \t-\r])|[A-Za-z0-9\x80-\xff]*[A-Za-z0-9](?=[!-/:-@\[-`{-~])"
        rb"|[!-/:-@\[-`{-~]+(?![^ \t-\r])|[!-/:-@\[-`{-~]+[A-Za-z0-9\x80-\xff]*[A-Za-z0-9](?=[!-/:-@\[-`{-~])|[^ \t-\r]+)")
_WORDS = re.compile(_RUN)
_CHUNKS = re.compile(rb" ?" + _RUN + rb"|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")
#: White space beyond ASCII, in UTF-8 (fixed values of the Unicode property White_Space).
_WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")

#: A capital before anything from U+0300 on, where combining marks begin.
_CAPITAL_MARKED = re.compile(rb"[A-Z][\xcc-\xff]")


_SPACE, _LETTER, _MARK = 1, 2, 3
#: Kinds of bytes: white space, ASCII letters and digits, ASCII punctuation (the rest: 0).
_KIND = np.array([_SPACE if b in b" \t\n\v\f\r" else _LETTER if chr(b).isalnum() and b < 128 else _MARK if 32 < b < 127 else 0 for b in range(256)], np.uint8)


class Chunks(Words):
    """Where the chunks of several texts lie, found for all texts at once.

    ``whole``: texts that stay one chunk.  ``keeps_space``: a ``byte`` tokenizer's cuts; else white
    space belongs to no chunk.  Besides the cuts named above, one lies between a letter of U+00C0 to
    U+00FF and ASCII punctuation.
    """

    def __init__(self, texts: list[bytes], whole: list[bool], keeps_space: bool):
        self.raw = b"".join((*texts, bytes(8)))  # eight bytes can be read from any place
        self.bytes = np.frombuffer(self.raw, np.uint8)
        held = self.bytes[:-8]
        ends = np.cumsum([0, *map(len, texts)])
        begins, filled = ends[:-1], ends[1:] > ends[:-1]
        kind = _KIND[held]
        space, mark = kind == _SPACE, kind == _MARK
        cut = np.zeros(len(held), bool)
        cut[1:] = (kind[:-1] == _LETTER) & mark[1:] | (space[:-1] != space[1:])
        at = np.flatnonzero(held[:-2] == 0xC3) + 2  # behind the letter, as long as it is one
        cut[at] |= mark[at] & (held[at - 1] != 0x97) & (held[at - 1] != 0xB7)
        if keeps_space:
            # the last of a white-space run goes with the following word if it is a space, or else is a chunk
            last = np.flatnonzero(space[:-1] & ~space[1:])
            last = last[~np.isin(last, ends[1:] - 1)]
            cut[last] = True
            cut[last + 1] = held[last] != 32
        cut[begins[filled]] = True
        for i in np.flatnonzero(whole).tolist():
            cut[begins[i] + 1:ends[i + 1]] = False
        self.starts = np.flatnonzero(cut)
        self.lengths = np.diff(self.starts, append=len(held))
        if not keeps_space:
            stays = ~space[self.starts] | np.isin(self.starts, begins[np.array(whole, bool) & filled])
            self.starts, self.lengths = self.starts[stays], self.lengths[stays]
        #: Chunks per text.
        self.counts = np.diff(np.searchsorted(self.starts, ends))

    def at(self, places: np.ndarray) -> list[bytes]:
        """Some of the chunks."""
        starts = self.starts[places]
        return [self.raw[a:b] for a, b in zip(starts.tolist(), (starts + self.lengths[places]).tolist())]


def equal_bytes(a, starts: np.ndarray, b, others: np.ndarray, lengths: np.ndarray) -> bool:
    """Whether pieces of ``a`` equal those of ``b``, where lengths and ``Words.hashes`` are known to agree.

    Each step of that hash is one to one in its eight bytes, so pieces that agree in all eights but
    the last agree in that, too; pieces longer than ``Words.LONG`` are compared whole."""
    a, b, long = eights(a), eights(b), lengths > Words.LONG
    while True:
        more = (lengths > 8) | long & (lengths > 0)
        starts, others, lengths, long = starts[more], others[more], lengths[more], long[more]
        if not len(starts):
            return True
        if ((a[starts] ^ b[others]) & BYTE_MASKS[np.minimum(lengths, 8)]).any():
            return False
        starts, others, lengths = starts + 8, others + 8, lengths - 8


class Encoder:
    """Ids of byte-string texts, equal to ``encode(text, add_special_tokens=False).ids``."""

    #: Distinct chunks kept before the memory is dropped and filled anew.
    LIMIT = 1_000_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_space = self.tokenizer.normalizer is None
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.widths = self._widths() if self.keeps_space else None
        self.forget()

    def _widths(self) -> np.ndarray:
        """Bytes of every id; a ``byte`` tokenizer writes each byte as one character."""
        vocabulary = self.tokenizer.get_vocab()
        widths = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
        widths[list(vocabulary.values())] = [len(t) for t in vocabulary]
        for number, token in self.tokenizer.get_added_tokens_decoder().items():
            widths[number] = len(token.content.encode())
        return widths

    def forget(self) -> None:
        #: Hashes of the known chunks in order, and the chunks' numbers; then by number: where a chunk's
        #: bytes lie in ``store`` (and how many), and where its ids lie in ``flat`` (and how many).
        self.hashes, self.numbers = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.begins, self.sizes, self.store = array("q"), array("q"), bytearray(8)
        self.starts, self.lengths, self.flat = array("q"), array("q"), array("I")

    def whole(self, text: bytes) -> bool:
        """Whether the text is one chunk."""
        return any(s in text for s in self.special) or bool(self.keeps_space and not text.isascii() and _WIDE_SPACE.search(text))

    def lowered(self, text: bytes) -> bytes:
        """The text with A-Z lowered where that changes no id."""
        if self.keeps_space:
            return text
        low = text.lower()
        exact = any(s in low for s in self.special) or not text.isascii() and _CAPITAL_MARKED.search(text)
        return text if exact else low

    def chunks(self, text: bytes) -> list[bytes]:
        if self.whole(text):
            return [text]
        return (_CHUNKS if self.keeps_space else _WORDS).findall(self.lowered(text))

    def pieces(self, words: list[bytes]) -> list[list[int]]:
        """The library's ids of each chunk."""
        return [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]

    def _joined(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunks in order, and how many each has."""
        if self.widths is not None:
            # one list of ids for many chunks; the ids' own bytes say where a chunk ends
            parts = [self.tokenizer.encode_batch_fast([[w.decode() for w in words[i:i + 500]]], is_pretokenized=True, add_special_tokens=False)[0].ids
                     for i in range(0, len(words), 500)]
            ids = np.fromiter(chain.from_iterable(parts), np.uint32)
            covered = np.cumsum(self.widths[ids])
            ends = np.cumsum([len(w) for w in words])
            places = np.searchsorted(covered, ends)
            if len(covered) and covered[-1] == ends[-1] and (covered[places] == ends).all():
                return ids, np.diff(places, prepend=-1)
        pieces = [ids for i in range(0, len(words), 5000) for ids in self.pieces(words[i:i + 5000])]
        return np.fromiter(chain.from_iterable(pieces), np.uint32), np.fromiter(map(len, pieces), np.int64, len(pieces))

    def _learn(self, chunks: Chunks, hashes: np.ndarray, at: np.ndarray) -> None:
        """Encode the chunks at the places, all of them new and unequal, whose hashes ascend."""
        ids, lengths = self._joined(chunks.at(at))
        numbers = len(self.begins) + np.arange(len(at))
        sizes = chunks.lengths[at]
        ends = np.cumsum(sizes)
        self.begins.frombytes((len(self.store) - 8 + ends - sizes).tobytes())
        self.sizes.frombytes(sizes.tobytes())
        self.store[-8:] = chunks.bytes[np.repeat(chunks.starts[at] - (ends - sizes), sizes) + np.arange(ends[-1])].tobytes() + bytes(8)
        self.starts.frombytes((len(self.flat) + np.cumsum(lengths) - lengths).tobytes())
        self.lengths.frombytes(lengths.tobytes())
        self.flat.frombytes(ids.tobytes())
        places = np.searchsorted(self.hashes, hashes)
        self.hashes, self.numbers = np.insert(self.hashes, places, hashes), np.insert(self.numbers, places, numbers)

    def _codes(self, chunks: Chunks) -> np.ndarray | None:
        """The number of every chunk; None if unequal chunks share a hash."""
        hashes = chunks.hashes()
        order = np.argsort(hashes)
        hashes = hashes[order]
        new = np.diff(hashes, prepend=~hashes[:1]) != 0
        group = np.cumsum(new) - 1
        hashes, first = hashes[new], order[new]
        same = first[group]
        if (chunks.lengths[order] != chunks.lengths[same]).any() or not equal_bytes(chunks.raw, chunks.starts[order], chunks.raw, chunks.starts[same], chunks.lengths[order]):
            return None
        places = np.searchsorted(self.hashes, hashes)
        unknown = np.ones(len(hashes), bool)
        inside = places < len(self.hashes)
        unknown[inside] = self.hashes[places[inside]] != hashes[inside]
        seen, numbers = first[~unknown], self.numbers[places[~unknown]]
        sizes = np.frombuffer(self.sizes, np.int64)[numbers] if len(numbers) else numbers
        if (chunks.lengths[seen] != sizes).any() or not equal_bytes(
                chunks.raw, chunks.starts[seen], self.store, np.frombuffer(self.begins, np.int64)[numbers] if len(numbers) else numbers, sizes):
            return None
        found = np.empty(len(hashes), np.int64)
        found[~unknown] = numbers
        if unknown.any():
            found[unknown] = len(self.begins) + np.arange(np.count_nonzero(unknown))
            self._learn(chunks, hashes[unknown], first[unknown])
        codes = np.empty(len(order), np.int64)
        codes[order] = found[group]
        return codes

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order (uint32), and how many each text has."""
        if len(self.begins) > self.LIMIT:
            self.forget()
        whole = [self.whole(t) for t in texts]
        chunks = Chunks([t if w else self.lowered(t) for t, w in zip(texts, whole)], whole, self.keeps_space)
        if not len(chunks.starts):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        try:
            codes = self._codes(chunks)
        except BaseException:
            self.forget()  # half of what is learned must not stay
            raise
        if codes is None:
            return self._joined_texts(texts)
        lengths = np.frombuffer(self.lengths, np.int64)[codes]
        starts = np.frombuffer(self.starts, np.int64)[codes]
        ends = np.cumsum(lengths)
        total = int(ends[-1])
        ids = np.frombuffer(self.flat, np.uint32) if len(self.flat) else np.empty(0, np.uint32)
        ids = ids[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(chunks.counts)))]
        return ids, np.diff(bounds)

    def _joined_texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` by the library alone."""
        pieces = self.pieces(texts)
        return np.fromiter(chain.from_iterable(pieces), np.uint32), np.fromiter(map(len, pieces), np.int64, len(pieces))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file; it lives across the tasks of the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
