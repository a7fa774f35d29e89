"""The encoder's arrays: what it keeps, its cuts and its comparison of bytes."""

from __future__ import annotations

import functools
import gc
import random
import sys

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from listingflow.llm import tokens, wavelet

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
EDGES = ["", " ", "  ", "a", " a", "a ", "\n", "\n\n a", "a\t b", "a \tb", "a b", " ", "é,", "x×,y", "x÷,y", "l'été's", "é's ß.",
         "<|endoftext|>", " <|endoftext|> a", "Áb, C", "a\x00 a\x00\x00 a", "\x0b\x0c \r\n", "no.", "x" * 63, "x" * 64 + " " + "x" * 65, "y" * 5000, ""]


library = functools.cache(Tokenizer.from_file)


def check(path, texts, encoder=None):
    ids, lengths = (encoder or tokens.Encoder(path)).encode([t.encode() for t in texts])
    want = [e.ids for e in library(path).encode_batch(texts, add_special_tokens=False)]
    assert lengths.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_edges_of_texts(path):
    rng = random.Random(3)
    encoder = tokens.Encoder(path)
    for texts in ([], [""], ["", ""], EDGES, EDGES[::-1], [" "]):
        check(path, texts, encoder)
    for _ in range(300):
        check(path, ["".join(rng.choice(EDGES) for _ in range(rng.randrange(4))) for _ in range(5)], encoder)


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_known_chunks_are_no_objects(path):
    """A chunk that is kept used to cost several Python objects (and its lookup a Python call)."""
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("abcdefghij", k=9)) for _ in range(30_000)).encode()
    encoder = tokens.Encoder(path)
    encoder.encode([b"some words"])
    gc.collect()
    before = sys.getallocatedblocks()
    encoder.encode([text])
    assert sys.getallocatedblocks() - before < 3000


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_unequal_chunks_with_one_hash(path, monkeypatch):
    real = tokens.Chunks.hashes
    monkeypatch.setattr(tokens.Chunks, "hashes", lambda self: np.where(self.lengths > 8, self.lengths.astype(np.uint64), real(self)))
    encoder = tokens.Encoder(path)
    check(path, ["abcdefghijkl and abcdefghijkl"], encoder)
    check(path, ["abcdefghijkl and xbcdefghijkl"], encoder)   # within a block
    check(path, ["xbcdefghijkl, ybcdefghijkl"], encoder)
    check(path, ["zbcdefghijkl"], encoder)                    # with what is known
    check(path, ["x" * 70 + " " + "x" * 69 + "y"], encoder)   # in the last of many bytes
    check(path, ["abcdefghijkl"], encoder)


def test_failed_encoding_leaves_nothing(monkeypatch):
    encoder = tokens.Encoder(BYTES)

    def fails(*_):
        raise MemoryError
    monkeypatch.setattr(tokens.Encoder, "_joined", fails)
    with pytest.raises(MemoryError):
        encoder.encode([b"some words"])
    monkeypatch.undo()
    check(BYTES, ["some words", "other words"], encoder)


def test_forgets_beyond_the_limit(monkeypatch):
    monkeypatch.setattr(tokens.Encoder, "LIMIT", 3)
    encoder = tokens.Encoder(WORDS)
    for texts in (["a b c d e"], ["f g a"], ["a b", "zz"]):
        check(WORDS, texts, encoder)


@pytest.mark.parametrize("n", [0, 1, 7, 300_000])
@pytest.mark.parametrize("planes", [1, 9, 16, 17])
def test_wavelet_round_trip(n, planes):
    ids = np.random.default_rng(n).integers(0, 1 << planes, n).astype(np.uint32)
    assert wavelet.WaveletMatrix.build(ids, planes).decode().tolist() == ids.tolist()
