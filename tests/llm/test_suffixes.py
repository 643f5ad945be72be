"""Both forms of the grouping sort against direct sorting."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from mergewell.llm.suffixes import sorted_suffixes, suffix_array, suffix_arrays


def direct(text):
    return sorted(range(len(text)), key=lambda k: text[k:])


def both(texts):
    start = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    flat = np.array([x for t in texts for x in t], np.int64)
    want = [k + int(s) for t, s in zip(texts, start, strict=False) for k in direct(t)]
    assert suffix_arrays(flat, start).tolist() == want
    assert sorted_suffixes(flat, start, together=50).tolist() == want
    assert [k + int(s) for t, s in zip(texts, start, strict=False) for k in suffix_array(t)] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=30), min_size=1, max_size=8))
def test_small_alphabets(texts):
    both(texts)


def test_shapes():
    rng = random.Random(4)
    a, b = [1], [1, 0]
    for _ in range(10):
        a, b = a + b, a
    both([[], [5], [0] * 200, list(range(100)), list(range(100, 0, -1)), [1, 2] * 80, a, [0, 1, 1] * 30 + [0], [rng.randint(0, 255) for _ in range(700)]])
    both([[rng.randint(0, 1) for _ in range(rng.randint(0, 120))] for _ in range(300)])


def test_long_text_sorts_alone():
    rng = random.Random(6)
    unit = [rng.randint(1, 200) for _ in range(300)]
    text = [x if rng.random() > 0.02 else rng.randint(1, 200) for _ in range(40) for x in unit]
    flat, start = np.array(text + text[:50]), np.array([0, len(text), len(text) + 50])
    want = sorted(range(len(text)), key=lambda k: bytes(text[k:])) + [k + len(text) for k in direct(text[:50])]
    assert sorted_suffixes(flat, start).tolist() == want
