"""Hashes of words."""

from __future__ import annotations

from itertools import permutations

import numpy as np

from eventlake.llm.text import word_bounds, word_hashes


def hashes(words: list[bytes]) -> list[int]:
    data = np.frombuffer(b" ".join(words), np.uint8)
    return word_hashes(data, *word_bounds(data, np.array([0, len(data)]))[:2]).tolist()


def test_a_word_has_one_hash_whatever_stands_beside_it():
    # two words of 100 bytes that differ behind the first 64
    words = [b"a" * 63, b"b" * 64, b"c" * 65, b"d" * 100, b"d" * 99 + b"e", b"short"]
    alone = {w: hashes([w])[0] for w in words}
    assert len(set(alone.values())) == len(words)
    for order in permutations(words):
        assert hashes(list(order)) == [alone[w] for w in order]
    for mixed in ([words[1], words[3], words[1]], [words[3], words[1], words[2]], [words[4], words[3], words[1], words[1]]):
        assert hashes(mixed) == [alone[w] for w in mixed]
