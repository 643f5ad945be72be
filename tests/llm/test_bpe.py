"""The encoder against the library that the file belongs to."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mergewell.llm.bpe import Bpe, encode
from mergewell.llm.queries import tokenizer_file

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def ours():
    return Bpe(tokenizer_file())


@pytest.fixture(scope="module")
def theirs():
    t = tokenizers.Tokenizer.from_file(P.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def same(ours, theirs, texts):
    want = [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]
    got = ours.encode(texts)
    assert got == want
    assert [ours.decode(i) for i in got] == [theirs.decode(i, skip_special_tokens=False) for i in want]


def test_edges(ours, theirs):
    same(ours, theirs, ["", " ", "I'll can't'S", "aaaaaaaaaaaaaaaaaaaaaaa", "a" * 5000, "x<|endoftext|> y <|startoftext|><|endoftext|", "ΑΣ ΣΑΣ", "İI", "é Å", "１２３ ½", " a\x1cb\x85c", "日本語のテキスト", "😀😀👍🏽", "</w>", "l'été c'est"])


def test_every_character(ours, theirs):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c}" for c in chars]
    want = theirs.encode_batch(texts, add_special_tokens=False)
    got = ours.encode(texts)
    odd = [c for c, g, w in zip(chars, got, want, strict=True) if g != w.ids]
    assert len(odd) == 0, [hex(ord(c)) for c in odd[:20]] + [len(odd)]


def test_random_words(ours, theirs):
    rng = random.Random(5)
    pieces = [t.removesuffix("</w>") for t in rng.sample(ours.tokens, 3000) if t.isascii() and t.removesuffix("</w>").isalpha()]
    same(ours, theirs, ["".join(rng.choices(pieces, k=rng.randint(1, 5))) for _ in range(20_000)])
    same(ours, theirs, ["".join(rng.choices("abceinrstt", k=rng.randint(1, 300))) for _ in range(3000)])


def test_words_merged_together(ours, monkeypatch):
    """Short words that are no longest matches are merged side by side, as one by one; none goes the slow way."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abceinrstté日", k=rng.randint(1, 30))) for _ in range(4000)] + ["a" * k for k in range(1, 65)] + ["\u00ff" * 32]
    spelled = [w.encode().decode("latin-1").translate(ours.letters) for w in words]
    spelled = [s for s in spelled if len(s) <= 64]
    want = [ours.merged(s) for s in spelled]
    assert ours.merged_together(spelled) == want
    monkeypatch.setattr(ours, "merged", lambda word: 1 / 0)
    ours.learn([w for w in words if len(w.encode()) <= 64], {})


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(ours, theirs, text):
    same(ours, theirs, [text])


def test_compatibility_is_exact(ours):
    """A word fails the check if and only if merging gives other tokens than the longest match."""
    rng, out = random.Random(3), {}
    words = sorted({"".join(rng.choices("aeinrst", k=rng.randint(2, 12))) for _ in range(4000)})
    failed = ours.learn(words, out)
    assert failed == sum(ours.greedy(w) != ours.merged(w) for w in words) and 0 < failed < len(words)
    assert all(out[w] == ours.merged(w) for w in words)


def test_frame(spark, sf_dir, theirs):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    df = df.union(spark.createDataFrame([(-1, None, "x"), (-2, "", "x"), (-1, None, "x"), (None, "a b", None)], df.schema))
    got = encode(df, tokenizer_file()).collect()
    rows = df.collect()
    assert len(got) == len(rows)
    want = sorted((str(r.doc_id), theirs.encode(r.text or "", add_special_tokens=False).ids) for r in rows)
    assert sorted((str(r.doc_id), r.ids) for r in got) == want
    assert encode(df.limit(0), tokenizer_file()).count() == 0
