"""Long texts are taken in chunks, which change nothing."""

import random
from collections import Counter

import numpy as np
import pytest

from satchel.llm import importance, language

RNG = random.Random(5)
TEXTS = ["", " ", "a", "ab  cd", "x" * 50, "1 2 3", "ΑΣ ΑΣΑ. İstanbul ß", "the the  the cat", "  lead and trail \n"] + [
    "".join(RNG.choices("aab é1\n ", k=RNG.randrange(1, 90))) for _ in range(60)
]


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 16])
def test_chunks_change_no_gram(monkeypatch, chunk):
    encoder, hasher = language.Space(), importance.Hasher()
    whole = [Counter(x for found in hasher(t) for x in found.tolist()) for t in TEXTS]
    grams = [dict(zip(*(x.tolist() for x in encoder.grams(t)), strict=True)) for t in TEXTS]
    monkeypatch.setattr(importance, "CHUNK", chunk)
    monkeypatch.setattr(language, "CHUNK", chunk)
    small = importance.Hasher()
    assert [Counter(x for found in small(t) for x in found.tolist()) for t in TEXTS] == whole
    assert [dict(zip(*(x.tolist() for x in encoder.grams(t)), strict=True)) for t in TEXTS] == grams


def test_grams_are_those_of_the_whole_text():
    encoder = language.Space()
    for text in TEXTS:
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        plain = f" {' '.join(words)} " if words else ""
        expected = Counter(plain[i : i + 3] for i in range(len(plain) - 2))
        values, times = encoder.grams(text)
        got = {"".join(chr(v >> 21 * (2 - i) & 0x1FFFFF) for i in range(3)): n for v, n in zip(values.tolist(), times.tolist(), strict=True)}
        assert got == dict(expected), text


def test_words_are_hashed_alike_wherever_they_stand():
    hasher = importance.Hasher()
    hashes, _, _ = hasher.words(np.frombuffer(b"ab cd ab  cdab ab", dtype=np.uint8))
    assert hashes[0] == hashes[2] == hashes[4] and len(set(hashes.tolist())) == 3
