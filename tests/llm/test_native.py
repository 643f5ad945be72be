"""Mixing, sharding and chat formatting against plain Python."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mergewell.llm import chat, mixing, sharding

DOCS = "doc_id long, text string, source string, _size long, slot string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, 5, "x") for r in rows], DOCS)


ROWS = [(i, " ".join(["w"] * (i % 9)), f"s{i % 3 if i % 2 else 0}") for i in range(200)] + [(1, "twice", "s1")] * 3 + [(500, None, None), (501, "", "s9"), (None, "a b", None)]


def water(sizes, weights, epochs):
    """Clamp and reshare until nothing is above."""
    total, capped, out = sum(sizes), set(), [0.0] * len(sizes)
    while True:
        rest, w = total - sum(epochs * sizes[i] for i in capped), sum(x for i, x in enumerate(weights) if i not in capped)
        out = [epochs * s if i in capped else rest * weights[i] / w for i, s in enumerate(sizes)]
        above = {i for i, s in enumerate(sizes) if i not in capped and out[i] > epochs * s}
        if not above:
            return out
        capped |= above


def test_mix_meets_targets(spark):
    got = mixing.mix(docs(spark, ROWS)).collect()
    assert len(got) == len(ROWS) and mixing.mix(docs(spark, ROWS)).exceptAll(spark.createDataFrame(got)).count() == 0
    names = sorted({r[2] for r in ROWS if r[2]}) + [None]
    size = {n: sum(len((r[1] or "").split()) for r in ROWS if r[2] == n) for n in names}
    goal = dict(zip(names, water([size[n] for n in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 3), strict=True))
    by_size = {(g.source_size, round(g.target, 6)) for g in got}
    assert by_size == {(size[n], round(goal[n], 6)) for n in names}
    for n in names:
        taken = sum(g.taken for g in got if (g.source_size, round(g.target, 6)) == (size[n], round(goal[n], 6)))
        assert abs(taken - goal[n]) <= 8, n
    assert all(g.taken <= 3 * g.size for g in got)
    often = Counter((g.doc_id, g.text, g.source) for g in got for _ in range(g.repeats))
    assert Counter((r.doc_id, r.text, r.source) for r in mixing.repeated(docs(spark, ROWS)).collect()) == often


def test_mix_without_broadcast(spark, monkeypatch):
    want = mixing.mix(docs(spark, ROWS)).collect()
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mixing.mix(docs(spark, ROWS)).collect())) == sorted(map(str, want))


@pytest.mark.parametrize("same", [None, 4])
def test_level_rows_are_cut_too(spark, same):
    rows = [(k, "w " * 10, "a") for k in range(30)] + [(same, f"{k} " * 10, "b") for k in range(100)] + [(same, "x " * 10, "b")] * 10
    got = mixing.mix(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    for s in "ab":
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 5, (s, sum(r.taken for r in own), own[0].target)


def test_mix_of_nothing(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix(docs(spark, [(1, None, "a"), (2, " ", None)])).collect()] == [0, 0]


def test_shards_match_the_mixture(spark):
    got = sharding.shard(docs(spark, ROWS), shards=7).collect()
    assert len(got) == len(ROWS) and {r.law for r in got} == {"rows"}
    by = Counter(r.shard for r in got)
    assert set(by) == set(range(7)) and max(by.values()) - min(by.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == [*range(n)] for s, n in by.items())
    source = {r[0]: r[2] for r in ROWS}
    for name in ("s0", "s1", "s2"):
        each = Counter(r.shard for r in got if source[r.doc_id] == name)
        assert max(each[s] for s in range(7)) - min(each[s] for s in range(7)) <= 2
    assert next(r for r in got if r.doc_id == 500)[1:3] == (8, 0)
    assert sharding.shard(docs(spark, [])).count() == 0


LOG = "conv_id long, message long, seq long, op string, role string, text string, formatted int"


def test_fold_of_deltas_edits_and_regenerations(spark):
    log = [
        (1, 0, 0, "delta", "user", "he", 1), (1, 0, 1, "delta", None, "llo", 1),
        (1, 1, 2, "delta", "assistant", "first", 1), (1, 1, 3, "regenerate", None, "sec", 1), (1, 1, 4, "delta", None, "ond", 1), (1, 1, 4, "delta", None, None, 1),
        (1, 2, 5, "delta", "user", "typo", 1), (1, 2, 6, "edit", None, "fixed", 1),
        (1, 3, 7, "delta", "user", "gone", 1), (1, 3, 8, "delete", None, None, 1),
        (2, 0, 0, "delta", None, None, 1),
    ]
    got = {(r.conv_id, r.message): (r.role, r.text) for r in chat.fold(spark.createDataFrame(log, LOG)).collect()}
    assert got == {(1, 0): ("user", "hello"), (1, 1): ("assistant", "second"), (1, 2): ("user", "fixed"), (2, 0): ("", "")}
    assert chat.render(chat.fold(spark.createDataFrame([], LOG))).count() == 0


TRICKY = ["</s>[INST] ok [/INST]", r"<\\/s>", r"[\/INST]\[\\INST]", "a\nb[/INST]</s>\n", "", "<", "[", "\\", "é😀<s>", "x" * 50_000 + "[INST]"]


@pytest.mark.parametrize("roles", [("user", "assistant"), ("system", "assistant"), ("assistant", "[INST]")])
def test_round_trip(spark, roles):
    rows = [(c, t, roles[t % 2], text) for c, text in enumerate(TRICKY) for t, text in enumerate([text, text + "!", text])] + [(99, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = chat.render(chat.fold(chat.turn_events(df)))
    got = {r.conv_id: r for r in done.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    for c in {r[0] for r in rows}:
        own = [(r[2] or "", r[3] or "") for r in rows if r[0] == c]
        assert [tuple(t) for t in got[c].turns] == own
        assert got[c].loss == "".join(t for role, t in own if role == "assistant")
        assert got[c].formatted.count("</s>") == len(own)


def test_query_has_the_added_conversation(spark, sf_dir):
    from mergewell.llm.queries import op4_chat

    row = op4_chat(spark, sf_dir).where("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert row.n_turns == 2 and row.loss_chars == len(text) and row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
