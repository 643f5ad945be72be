"""Base counts against direct definitions; the field against enumeration and held-out labels."""

import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mergewell.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def direct(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    twice = {w for w in windows if windows.count(w) > 1}
    covered = {k + d for k, w in enumerate(windows) if w in twice for d in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:k] for k, x in enumerate(lines)), len(covered), failed


TEXTS = [None, "", " \n\t", "a", "é ü\x0bß\x85x", "w " * 30, "one two\none two\n \n| # <b>", " ".join(map(str, range(40))), "\n".join(["a b c d e f g h i j"] * 3), "x" * 100_000]


def test_counts(spark):
    df = spark.createDataFrame([(i, t, 1, True) for i, t in enumerate(TEXTS)] + [(0, None, 1, True)], "doc_id long, text string, n_words int, kept boolean")
    got = quality.judge(df, None).collect()
    assert sorted((r.doc_id, *r[1:7]) for r in got) == sorted((i, *direct(t)) for i, t in [*enumerate(TEXTS), (0, None)])
    assert all(r.kept == (not r.base_failed) for r in got)
    assert quality.judge(df.limit(0), None).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "ç", "\n"]), max_size=60))
def test_repeats(parts):
    words = " ".join(parts).encode().split()
    assert quality.repeated_words(words) == direct(" ".join(parts))[4]


def chain(seed=1, n=12):
    rng = np.random.default_rng(seed)
    return quality.Crf(rng.normal(size=(quality.N_FEATURES, 2)), rng.normal(size=(2, 2)) * 2), rng.integers(0, 1 << quality.N_FEATURES, n)


def total(model, bits, labels):
    score = quality._unpacked(np.array(bits)) @ model.emit
    return sum(score[k, y] for k, y in enumerate(labels)) + sum(model.move[a, b] for a, b in itertools.pairwise(labels))


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_is_the_best_of_all_labellings(seed):
    model, bits = chain(seed, 9)
    best = max(itertools.product((0, 1), repeat=9), key=lambda y: total(model, bits, y))
    assert tuple(model.viterbi(bits.tolist())) == best


def test_training_recovers_a_chain():
    rng = np.random.default_rng(0)
    lines, labels = [], []
    for _ in range(300):
        y = np.cumsum(rng.random(rng.integers(1, 15)) < 0.2) % 2
        noisy = np.where(rng.random(len(y)) < 0.2, 1 - y, y)
        lines.append(1 + 2 * noisy.astype(np.int64))
        labels.append(y)
    model = quality.Crf.trained(lines, labels)
    right = sum(int((np.array(model.viterbi(b.tolist())) == y).sum()) for b, y in zip(lines, labels, strict=True))
    plain = sum(int(((b >> 1) == y).sum()) for b, y in zip(lines, labels, strict=True))
    assert right > plain


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    got = quality.judge(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    good, bad = [r.kept for r in got if r.quality == 1], [r.kept for r in got if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.3, (np.mean(good), np.mean(bad))
    assert quality.fit(docs, labels.where("quality = 1")) is None and quality.fit(docs, labels.limit(0)) is None


LONG = "அவர்களுக்காகவும் நிறுவனங்களுக்கும் தொழிலாளர்களுக்கும் பல்கலைக்கழகத்தில்"


def test_labels_of_lines(spark, monkeypatch):
    ascii_long = "incomprehensibilities counterrevolutionaries"
    docs = spark.createDataFrame([(1, f"{LONG}\none line\n{ascii_long}\none line"), (2, "bad line\nbad line")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    seen = {}
    monkeypatch.setattr(quality.Crf, "trained", classmethod(lambda cls, lines, y: seen.update({len(b): b.tolist() for b in y})))
    quality.fit(docs, labels)
    assert seen == {4: [1, 1, 1, 0], 2: [0, 0]}


def names(line, seen=False):
    bits = quality.features(line.encode(), line.encode().split(), seen)
    return {n for k, n in enumerate(quality.FEATURES) if bits >> k & 1}


def test_features():
    assert "seen" in names("a b", True) and "seen" not in names("a b") and quality.N_FEATURES == 31
    assert "all_upper" in names("ALL OF IT") and quality._unpacked(np.array([1 << 30])).sum() == 1
    assert "digits20%" in names("44 ab") and "digits20%" in names("9876 ab") and "digits5%" not in names("ab cd")
    assert not {"mean>8", "mean>14"} & names("வணக்கம் நண்பர்") and {"mean>8", "mean>14"} <= names("x" * 15)
