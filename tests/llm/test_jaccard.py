"""The join against brute force over all pairs."""

import random
import re

import pytest

from mergewell.llm import jaccard
from mergewell.llm.components import components

SCHEMA = "doc_id long, text string, n int, token string, label string, shared int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def direct(rows):
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                top[find(a)] = find(b)
    name = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            name[find(k)] = min(i, name.get(find(k), i))
    return sorted(((i, len(s), name.get(find(k))) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA).repartition(parts)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link(df).collect()), key=str)


def test_planted(spark):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(40):
        base = [rng.choice(words) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 30)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((rng.randint(0, 10**6), " ".join(copy)))
    common = " ".join(words[:60])
    rows += [(2 * 10**6 + k, common + " " + " ".join(rng.choices(words, k=rng.randint(0, 40)))) for k in range(40)]
    rows += [(5, None), (6, ""), (7, " \n"), (8, "A b"), (9, "a  B\x0b"), (10, "a b c d e"), (11, "a b c d e"), (10, "a b c d e"), (None, "a b c d e"), (None, "only here"), (12, "é É"), (13, "é é")]
    assert run(spark, rows) == direct(rows)


def test_thresholds(spark):
    """Sets of 4 to 20 shingles that overlap just at, above and below 3 of 4."""
    rows, at = [], 0
    for n in range(4, 21):
        for cut in range(n // 2):
            rows.append((at, " ".join(f"t{n}x{cut}x{k}" for k in range(n + 4))))
            rows.append((at + 1, " ".join(f"t{n}x{cut}x{k}" for k in range(cut, n + 4))))
            at += 2
    assert run(spark, rows) == direct(rows)


def test_hot_shingles_and_copies(spark, monkeypatch):
    rng = random.Random(2)
    line = " ".join(f"licence{k}" for k in range(30))
    rows = [(k, line) for k in range(150)]
    rows += [(1000 + k, line + " " + " ".join(rng.choices("abcdefgh", k=rng.randint(1, 25)))) for k in range(150)]
    rows += [(3000 + k, " ".join(f"x{k}y{j}" for j in range(80)) + " " + line) for k in range(50)]
    assert run(spark, rows, 1) == run(spark, rows, 7) == direct(rows)


def test_near_copies_that_do_not_link(spark, monkeypatch):
    """Copies of one text with one to six changes, many of them too far from most others: few comparisons, no link lost."""
    rng = random.Random(3)
    base = [f"b{k}" for k in range(150)]
    rows = []
    for k in range(600):
        copy = list(base)
        for _ in range(rng.choice([1, 1, 2, 2, 3, 4, 4, 5, 6])):
            copy[rng.randrange(150)] = f"n{rng.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
    # pairs that link with each other alone, by changes that both have
    for k in range(0, 60, 2):
        copy = list(base)
        for at in range(0, 150, 12):
            copy[at] = f"p{k}x{at}"
        rows += [(1000 + k, " ".join(copy)), (1001 + k, " ".join([*copy, "end"]))]
    compared, verified = [], jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda pairs, sets: compared.append(pairs.count()) or verified(pairs, sets))
    assert run(spark, rows) == direct(rows)
    assert sum(compared) < 20 * len(rows)


def test_long_text_and_nothing(spark):
    long = " ".join(str(k % 9973) for k in range(200_000))
    assert run(spark, [(1, long), (2, long + " end"), (3, "x" * 300_000)]) == direct([(1, long), (2, long + " end"), (3, "x" * 300_000)])
    assert run(spark, []) == []


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 50)] + [(99, 98), (98, 97), (5, 5)]])
def test_components(spark, edges):
    top = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in top:
        for a, b in edges:
            if a != b:
                top[a] = top[b] = min(top[a], top[b])
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == top
