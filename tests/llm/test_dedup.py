"""Removal of repeated strings against brute force."""

import hashlib
import random

from mergewell.llm import dedup

SCHEMA = "doc_id long, text string, h int, spans string, block string"


def direct(rows):
    first: dict[bytes, float] = {}
    datas = [(float("inf") if i is None else i, i, (t or "").encode()) for i, t in rows]
    for key, _, data in datas:
        for k in range(len(data) - 49):
            w = data[k : k + 50]
            first[w] = min(key, first.get(w, key))
    out = []
    for key, i, data in datas:
        gone = bytearray(len(data))
        for k in range(len(data) - 49):
            if first[data[k : k + 50]] < key:
                gone[k : k + 50] = b"\1" * 50
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(data), sum(gone), spans, bytes(c for c, g in zip(data, gone, strict=True) if not g)))
    return sorted(out, key=str)


def check(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(parts)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in dedup.dedup(df).collect()), key=str)
    assert got == direct(rows)
    digests = {(r.doc_id, r.n_removed, r.kept_sha256) for r in dedup.digests(df).collect()}
    assert digests == {(i, n, hashlib.sha256(kept).hexdigest()) for i, _, n, _, kept in got}


def prose(rng, n):
    return " ".join("".join(rng.choices("etaoinshr", k=rng.randint(1, 8))) for _ in range(n))


def test_passages_and_edits(spark):
    rng = random.Random(1)
    passages = [prose(rng, rng.randint(8, 60)) for _ in range(12)]
    rows = [(k, prose(rng, rng.randint(0, 60)) + rng.choice(passages)[rng.randint(0, 40) :] + prose(rng, 5) + rng.choice(passages)) for k in rng.sample(range(1000), 80)]
    for k in range(40):
        text = list(rng.choice(rows)[1])
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = rng.choice("xyz")
        rows.append((2000 + k, "".join(text)))
    check(spark, rows)


def test_edges(spark):
    a, b = "x" * 49 + "y", "0123456789" * 5
    rows = [
        (1, None), (2, ""), (3, a), (4, a), (5, a[:49]), (6, a[:49]), (7, a + a), (8, "z" * 500), (9, "z" * 60 + "q"), (10, "ab" * 100), (11, "b" + "ab" * 60),
        (12, b + "é" * 40), (13, "é" * 40), (14, "é" * 60 + b), (15, "ü" + "é" * 24), (None, b), (None, b), (16, b[:49] + "!" + b), (17, b), (17, b), (17, "!" + b + "?" * 60), (18, "?" * 60),
        (3, a), (-5, "?" * 55), (20, b * 3), (21, b * 4),
    ]
    check(spark, rows)
    check(spark, [])
    check(spark, [(None, b), (None, b), (None, b + "!")])


def test_many_copies_and_one_passage(spark):
    rng = random.Random(2)
    text, passage = prose(rng, 80), prose(rng, 40)
    rows = [(k, text) for k in range(200)] + [(1000 + k, prose(rng, 10) + passage + prose(rng, 10)) for k in range(150)]
    check(spark, rows, 1)
    check(spark, rows, 9)


def test_long_text(spark):
    rng = random.Random(3)
    long = prose(rng, 12_000)
    check(spark, [(1, long), (2, "q" + long[100:]), (3, long[:30_000] + "-" + long[30_001:])])
