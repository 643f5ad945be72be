"""String scorers against direct definitions, pair by pair."""

import random

import duckdb
import pandas as pd
import pytest

from mergewell.functions import strings


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def ratio(a, b):
    return 2 * subsequence(a, b) / (len(a) + len(b)) if a or b else 1.0


def partial(a, b):
    if not a or not b:
        return float(a == b)
    best = 0.0
    for x, y in {(a, b), (b, a)} if len(a) == len(b) else {tuple(sorted((a, b), key=len))}:
        for k in range(1 - len(x), len(y)):
            best = max(best, ratio(x, y[max(0, k) : k + len(x)]))
    return best


def token_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and not (left and right):
        return 1.0
    one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
    return max(ratio(one, two), *(ratio(both, o) for o in (one, two) if both), 0.0)


DIRECT = {"ratio": ratio, "partial": partial, "token_set": token_set, "token_sort": lambda a, b: ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))}


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcde", k=rng.randint(1, 6)))
    text = lambda: " ".join(word() for _ in range(rng.randint(0, 5)))
    out = [(text(), text()) for _ in range(150)]
    out += [(t, t) for t in (text(), "", "a")] + [("", "abc"), ("abc", ""), ("abcd", "dcba"), ("é ü", "ü é"), ("x" * 70 + "y", "y" + "x" * 90), ("a b c", "c b a"), ("a", "b")]
    return out


@pytest.mark.parametrize("name", DIRECT)
def test_scorers(pairs, name):
    got = strings.SCORERS[name](*map(list, zip(*pairs, strict=True)))
    for (a, b), x in zip(pairs, got, strict=True):
        assert abs(x - DIRECT[name](a, b)) < 1e-12, (a, b)


def test_jaro_winkler(pairs):
    con = duckdb.connect()
    got = strings.jaro_winkler(*map(list, zip(*pairs, strict=True)))
    for (a, b), x in zip(pairs, got, strict=True):
        if not f"{a}{b}".isascii():
            continue  # the other one compares bytes
        want = 1.0 if a == b == "" else con.execute("SELECT jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0]
        assert abs(x - want) < 1e-9, (a, b)


def test_nulls_and_repeats():
    got = strings.score("ratio", pd.Series(["ab", None, "ab", "x"]), pd.Series(["ab", "x", "ab", None]))
    assert got[0] == got[2] == 1.0 and got.isna().tolist() == [False, True, False, True]
    assert strings.score("partial", pd.Series([], dtype=object), pd.Series([], dtype=object)).empty
    assert strings.score("ratio", pd.Series([None]), pd.Series([None])).isna().all()


def test_in_chunks(pairs, monkeypatch):
    left, right = map(list, zip(*pairs, strict=True))
    whole = {n: f(left, right).tolist() for n, f in strings.SCORERS.items()}
    monkeypatch.setattr(strings, "PAIRS", 7)
    monkeypatch.setattr(strings, "CELLS", 2000)
    assert {n: f(left, right).tolist() for n, f in strings.SCORERS.items()} == whole
