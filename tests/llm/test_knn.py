"""Search against brute force."""

import random

import pytest

from mergewell.llm import knn

SCHEMA = "vec_id long, embedding array<float>, rank int, distance string"


def code(e):
    return sum(1 << i for i, x in enumerate(e) if x is not None and x > 0)


def direct(rows, asked, k):
    out = []
    for q, e in asked:
        if e is not None:
            near = sorted(((code(e) ^ code(x)).bit_count(), (i is not None, i or 0), i) for i, x in rows if x is not None)[:k]
            out += [(q, n + 1, i, d) for n, (d, _, i) in enumerate(near)]
    return sorted(out, key=str)


@pytest.mark.parametrize("kind", ["spread", "copies", "few"])
def test_brute_force(spark, kind):
    rng = random.Random(kind)
    draw = lambda: [rng.uniform(-1, 1) for _ in range(64)]
    if kind == "spread":
        rows = [(i, draw()) for i in range(300)]
    elif kind == "copies":
        base = [draw() for _ in range(8)]
        rows = [(i, base[0] if i % 3 else [x * (-1 if rng.random() < 0.03 else 1) for x in rng.choice(base)]) for i in range(400)]
        rows += [(7, base[0]), (None, base[0]), (900, None), (901, [0.0] * 64), (902, [None] * 64)]
    else:
        rows = [(i, draw()) for i in range(4)]
    asked = [r for r in rows if r[0] is not None and r[0] % 20 == 0] + [(900, None)]
    make = lambda x: spark.createDataFrame([(*r, 1, "x") for r in x], SCHEMA)
    got = [(r.query_id, r.rank, r.vec_id, r.distance) for r in knn.search(make(rows), make(asked), k=5).collect()]
    assert sorted(got, key=str) == direct(rows, asked, 5)


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(1, [1.0] * 64, 1, "x")], SCHEMA)
    assert knn.search(empty, one).count() == 0 and knn.search(one, empty).count() == 0 and knn.search(one, one).count() == 1
