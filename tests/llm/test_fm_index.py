"""Backward search in the compressed index, against counting."""

import random

import numpy as np
import pytest

from askgraph.llm.fm_index import FMIndex


def build(seed, words, length):
    rng = random.Random(seed)
    text = np.array([rng.randint(1, words) for _ in range(length)] + [0], "i4")
    vocabulary = {f"w{i}".encode(): i for i in range(1, words + 1)}
    return text, FMIndex.build(text, vocabulary, 8)


def counts(index, patterns):
    low, high = np.zeros(len(patterns), "i8"), np.full(len(patterns), index.size)
    for words in zip(*(p[::-1] for p in patterns), strict=True):
        low, high = index.extend(np.array(words), low, high)
    return (high - low).tolist()


@pytest.mark.parametrize("words, length", [(1, 70), (2, 63), (15, 64), (16, 200), (40, 999), (300, 2000)])
def test_patterns_are_counted_after_a_dump_too(words, length):
    text, index = build(words, words, length)
    rng = random.Random(length)
    for n in (1, 2, 3):
        patterns = [text[i : i + n].tolist() for i in (rng.randrange(length - n) for _ in range(50))]
        patterns += [[rng.randint(1, words) for _ in range(n)] for _ in range(20)] + [[-1] * n]
        every = [text[i : i + n].tolist() for i in range(length - n + 1)]
        expected = [every.count(p) for p in patterns]
        assert counts(index, patterns) == expected
        again = FMIndex.load(index.dump())
        assert counts(again, patterns) == expected
        assert again.vocabulary == index.vocabulary


def test_a_step_takes_four_bits_of_a_word_at_once():
    _, index = build(1, 40_000, 50)
    assert len(index.matrix.levels) == 4


def test_a_stored_index_takes_two_bytes_a_word_beside_its_words():
    _, index = build(2, 4_000, 20_000)
    rest = len(b" ".join(index.vocabulary)) + 4 * len(index.first)
    assert len(index.dump()) - rest < 2 * 20_000 + 2_000
