"""Base scores against counting; likelihoods and expected counts against sums over all paths."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from mergewell.llm import hmm

SCHEMA = "doc_id long, text string, block long, keys string, score int"


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def toy(states=3, symbols=5, seed=0):
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.dirichlet(np.ones(shape[-1]), shape[:-1])
    return hmm.Model(np.zeros(0, np.uint64), np.ones(hmm.CLASSES), draw(states), draw(states, states), draw(states, symbols))


def paths(model, sequence):
    for path in itertools.product(range(len(model.start)), repeat=len(sequence)):
        p = model.start[path[0]] * model.emit[path[0], sequence[0]]
        for k in range(1, len(sequence)):
            p *= model.move[path[k - 1], path[k]] * model.emit[path[k], sequence[k]]
        yield path, p


def test_forward_and_counts_are_sums_over_paths():
    model, rng = toy(), np.random.default_rng(1)
    sequences = [rng.integers(0, 5, n) for n in (6, 4, 4, 1)]
    size = np.array([len(x) for x in sequences])
    batch = hmm._Batch(np.concatenate(sequences), np.concatenate([[0], np.cumsum(size)[:-1]]), size)
    want = [math.log10(sum(p for _, p in paths(model, x))) for x in sequences]
    assert np.allclose(batch.likelihood(model), want)
    starts, moves, emits = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))
    for x in sequences:
        total = sum(p for _, p in paths(model, x))
        for path, p in paths(model, x):
            starts[path[0]] += p / total
            for k, y in enumerate(x):
                emits[path[k], y] += p / total
                if k:
                    moves[path[k - 1], path[k]] += p / total
    got = batch.counts(model)
    assert np.allclose(got[0], starts) and np.allclose(got[1], moves) and np.allclose(got[2], emits)


def test_clusters_separate_languages():
    rng = np.random.default_rng(0)
    pairs = np.zeros((40, 40))
    for k in range(4):
        pairs[10 * k : 10 * k + 10, 10 * k : 10 * k + 10] = rng.poisson(20, (10, 10))
    own = hmm.clusters(pairs + rng.poisson(0.2, (40, 40)), 4)
    assert sorted(len(set(own[10 * k : 10 * k + 10])) for k in range(4)) == [1] * 4 and len(set(own)) == 4


ROWS = [(k, f"The word{k % 5} of w{k} the\tA\x0bb É") for k in range(60)] + [(1, "twice"), (1, "twice"), (None, "x"), (500, None), (501, ""), (502, " \n"), (503, "long " * 30_000 + "z" * 70_000)]


@pytest.mark.parametrize("parts", [1, 4])
def test_base_score(spark, parts):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in ROWS], SCHEMA).repartition(parts)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    count = Counter(w for i, t in ROWS if not held(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    got = hmm.score(df).collect()
    want = sorted((str(i), held(i), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens(t)), 3)) for i, t in ROWS)
    assert sorted((str(r.doc_id), *r[1:5], round(r.base_score, 3)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_probabilities_sum_to_one(spark, sf_dir):
    blocks = hmm.tokenized(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    model, _, _, docs = hmm.train(blocks, rounds=1)
    assert np.allclose(model.emit.sum(1), 1) and np.allclose(model.move.sum(1), 1) and np.isclose(model.start.sum(), 1)
    # within a class: all its words and one unknown
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    for r in blocks.where("block >= 0").collect():
        keys, counts = np.append(keys, np.frombuffer(r["keys"], np.uint64)), np.append(counts, np.frombuffer(r["counts"], np.uint64))
    keys, at = np.unique(keys, return_index=True)
    seen = (counts[at] > 0) & (model.symbols(keys) >= len(model.head))
    cls = (keys & np.uint64(0xFF)).astype(int)
    share = np.bincount(cls[seen], weights=(counts[at][seen] + 1) / model.rare[cls[seen]], minlength=hmm.CLASSES) + 1 / model.rare
    assert np.allclose(share, 1) and docs > 0


def test_better_than_the_base_on_held_out_rows(spark):
    got = hmm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got) and len(got) > 100


def test_nothing_to_learn_from(spark):
    one = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    df = spark.createDataFrame([(one, "a b", 1, "x", 2)], SCHEMA)
    (row,) = hmm.score(df).collect()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 3, 0, 0, 0.0) and row.score < 0
    assert hmm.score(df.limit(0)).count() == 0
