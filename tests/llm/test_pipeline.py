"""Each stage's decisions against brute force on its own input, and the whole run."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from mergewell.llm import mixing, quality
from mergewell.llm.queries import tokenizer_file
from tests.llm.test_dedup import direct as repeated
from tests.llm.test_jaccard import direct as linked

STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choices("etaoinshr", k=rng.randint(1, 8))) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    base = [prose(rng, rng.randint(25, 120)) for _ in range(40)]
    passage = prose(rng, 20)
    texts = base + [f"{t} {prose(rng, 3)}" for t in base[:15]] + [f"{prose(rng, 30)} {passage} {prose(rng, 30)}" for _ in range(10)] + base[:5] + ["x | y | z | # " * 30, "again " * 50, "", None, "short"]
    return [(k, t, "en", f"s{k % 3}" if k % 7 else None, len(t or "")) for k, t in enumerate(texts)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_quality(spark, rows, sf_dir):
    docs = frame(spark, rows)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = {r.doc_id for r in quality.judge(docs, model).where("kept").collect()}
    got = STAGES["quality rules"](spark, docs, sf_dir)
    assert got.columns == docs.columns and {tuple(r) for r in got.collect()} == {r for r in rows if r[0] in kept}
    assert not {r[0] for r in rows if r[1] in ("", None, "short") or (r[1] or "").startswith("again")} & kept


def test_near_copies(spark, rows, sf_dir):
    own = [*rows, (None, "no id", "en", "s", 5), rows[0]]
    got = STAGES["n-gram Jaccard join"](spark, frame(spark, own), sf_dir)
    heads = {i for i, _, c in linked([(r[0], r[1]) for r in rows]) if i == c}
    assert Counter(map(tuple, got.collect())) == Counter([r for r in rows if r[0] in heads] + own[-2:-1])


def test_near_copies_by_row(spark, sf_dir):
    rng = random.Random(3)
    a, b, c, d, e = (prose(rng, 40) for _ in range(5))
    kept = [(5, a, "en", "s", 1), (5, b, "en", "s", 2), (-2, c, "en", "s", 3), (None, d, "en", "s", 4), (10, e, "en", "s", 5), (None, "", "en", "s", 6), (None, "", "en", "s", 6)]
    gone = [(5, a, "en", "s", 1), (None, b, "en", "s", 7), (1, c, "en", "s", 8), (None, f"{d} more", "en", "s", 9), (None, d, "en", "s", 4), (100, e, "en", "s", 9)]
    got = Counter(map(tuple, STAGES["n-gram Jaccard join"](spark, frame(spark, kept + gone), sf_dir).collect()))
    of_d = [r for r in got if r[1].startswith(d)]
    assert len(of_d) == 1 and got[of_d[0]] == 1
    assert Counter({r: n for r, n in got.items() if r not in of_d}) == Counter(r for r in kept if r[1] != d)


def test_repeated_passages(spark, rows, sf_dir):
    got = {r.doc_id: r for r in STAGES["suffix-array dedup"](spark, frame(spark, rows), sf_dir).collect()}
    for i, size, _, _, kept in repeated([(r[0], r[1]) for r in rows]):
        if kept or not size:
            assert got[i].text == (kept.decode() if rows[i][1] is not None else None) and got[i].n_chars in (len(kept), None)
        else:
            assert i not in got


def test_characters_are_not_cut(spark, sf_dir):
    shared = "0123456789" * 5
    own = [(1, "é" * 3 + shared, "en", "s", 0), (2, "à" * 3 + "é" + shared[:49] + "é", "en", "s", 0), (3, "日" + shared + "本", "en", "s", 0), (4, "q" + "é" * 24 + "é" * 3, "", "", 0), (5, "ü" + "é" * 25 + "ü", "", "", 0)]
    got = {r.doc_id: r.text for r in STAGES["suffix-array dedup"](spark, frame(spark, own), sf_dir).collect()}
    assert got[3] == "日本" and got[5].startswith("ü") and "�" not in "".join(got.values())


def test_mixture_and_tokens(spark, rows, sf_dir):
    import public_tokenizers
    import tokenizers

    docs = frame(spark, rows)
    often = Counter(tuple(r[c] for c in docs.columns) for r in mixing.mix(docs).collect() for _ in range(r.repeats))
    mixed = STAGES["mixing sources to target weights"](spark, docs, sf_dir)
    assert mixed.columns == docs.columns and Counter(map(tuple, mixed.collect())) == often
    theirs = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = Counter((r.doc_id, tuple(r.ids)) for r in STAGES["BPE encoding and decoding"](spark, mixed, sf_dir).collect())
    assert got == Counter({(k[0], tuple(theirs.encode(k[1] or "", add_special_tokens=False).ids)): n for k, n in often.items()})
    assert tokenizer_file()


def test_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    once = corpus_pipeline.run(spark, sf_dir)
    assert once.count() > 0 and Counter((r.doc_id, r.n_tokens) for r in once.collect()) == Counter((r.doc_id, r.n_tokens) for r in docs.collect())


def test_empty_table(spark, sf_dir):
    docs = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0, name


def test_columns_that_clash(spark, rows, sf_dir):
    extra = ["kept", "n_words", "base_failed", "size", "taken", "repeats", "h", "spans", "set_id", "label", "ids", "n_tokens"]
    docs = spark.createDataFrame([(*r, *(f"{r[0]}{c}" for c in extra)) for r in rows], ", ".join([SCHEMA, *(f"{c} string" for c in extra)]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == [*SCHEMA.replace(" long", "").replace(" string", "").split(", "), *extra], name
        assert all(r[c] == f"{r.doc_id}{c}" for r in docs.collect() for c in extra), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).columns == ["doc_id", "n_tokens", "ids"]
