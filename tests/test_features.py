"""Pair, context and second-stage features against direct computations with ties."""

import random

import pytest

from mergewell.operators import features
from tests.test_retrieval import TOY, TOYS, halves
from mergewell.operators import retrieval

SCHEMA = "s1_id string, t_id string, rank_both int, rank_name int, rank_addr int, cos_both double, cos_name double, cos_addr double"


@pytest.fixture(scope="module")
def pairs(spark):
    """Targets with up to 40 queries; cosines of one decimal, so that many tie."""
    rng = random.Random(6)
    seen = sorted({(f"q{rng.randint(0, 39):02}", f"t{min(rng.randint(0, 14), rng.randint(0, 14)):02}") for _ in range(400)})
    made = [(q, t, *(rng.randint(-1, 3) for _ in range(3)), *(round(rng.random(), 1) for _ in range(3))) for q, t in seen]
    return spark.createDataFrame(made, SCHEMA)


def test_context(pairs):
    rows = [r.asDict() for r in pairs.collect()]
    got = {(r.s1_id, r.t_id): r for r in features.context(pairs).collect()}
    assert len(got) == len(rows)
    for r in rows:
        x = got[r["s1_id"], r["t_id"]]
        mine, theirs = ([o for o in rows if o[k] == r[k]] for k in ("s1_id", "t_id"))
        assert x.q_n_cands == len(mine) and x.t_n_q == len(theirs)
        for s in features.CONTEXT:
            assert abs(x[f"q_gap_{s}"] - (r[s] - max(o[s] for o in mine))) < 1e-12 and abs(x[f"t_gap_{s}"] - (r[s] - max(o[s] for o in theirs))) < 1e-12
            assert x[f"q_rank_{s}"] == 1 + sum((-o[s], o["t_id"]) < (-r[s], r["t_id"]) for o in mine)
        assert x.t_rank_cos_both == min(9, 1 + sum(o["cos_both"] > r["cos_both"] for o in theirs))
        best = sorted((o["cos_both"] for o in theirs), reverse=True) + [0.0]
        assert abs(x.t_margin_cos_both - (r["cos_both"] - (best[1] if r["cos_both"] >= best[0] else best[0]))) < 1e-12


def test_context_golden(spark):
    rows = [(f"q{k}", "t", 0, 0, 0, c, c, c) for k, c in enumerate((0.9, 0.9, 0.5, 0.1))]
    got = features.context(spark.createDataFrame(rows, SCHEMA)).orderBy("s1_id").collect()
    assert [r.t_rank_cos_both for r in got] == [1, 1, 3, 4] and [r.t_n_q for r in got] == [4] * 4
    assert [round(r.t_margin_cos_both, 9) for r in got] == [0.0, 0.0, -0.4, -0.8]


def test_stage0(pairs):
    rows = [r.asDict() for r in pairs.collect()]
    for r in features.stage0(pairs).collect():
        mine, theirs = ([o for o in rows if o[k] == r[k]] for k in ("s1_id", "t_id"))
        assert r.s0_q_n == len(mine) and r.s0_t_n == len(theirs) and r.s0_n_channels == sum(r[f"rank_{c}"] >= 0 for c in ("both", "name", "addr"))
        assert abs(r.s0_tgap_name - (r.cos_name - max(o["cos_name"] for o in theirs))) < 1e-12


def test_standing(spark):
    rng = random.Random(8)
    rows = sorted({(f"q{rng.randint(0, 9)}", f"t{rng.randint(0, 9)}"): round(rng.random(), 1) for _ in range(60)}.items())
    rows = [(q, t, p) for (q, t), p in rows]
    got = {(r.s1_id, r.t_id): r for r in features.standing(spark.createDataFrame(rows, "s1_id string, t_id string, p1 double")).collect()}
    for q, t, p in rows:
        x = got[q, t]
        mine = sorted((-b, a) for c, a, b in rows if c == q)
        theirs = sorted((-b, c) for c, a, b in rows if a == t)
        assert x.q_p1_rank == 1 + mine.index((-p, t)) and x.q_p1_max == -mine[0][0] and x.q_p1_second == (-mine[1][0] if len(mine) > 1 else 0.0)
        assert x.t_is_best_q == (theirs[0][1] == q) and x.t_p1_second == (-theirs[1][0] if len(theirs) > 1 else 0.0)
        assert x.t_p1_best_other == (x.t_p1_second if x.t_is_best_q else x.t_p1_max) and x.is_top1 == (mine[0][1] == t)
        assert x.q_p1_n50 == sum(-a >= 0.5 for a, _ in mine) and x.t_p1_n20 == sum(-a >= 0.2 for a, _ in theirs)
        assert abs(x.q_p1_share - p / max(sum(-a for a, _ in mine), 1e-6)) < 1e-9 and abs(x.t_p1_margin - (p - x.t_p1_best_other)) < 1e-12


def test_pair_golden(spark):
    q, t = halves(spark, TOYS)
    pairs = retrieval.candidates(q, t, TOY)
    rows = {(r.s1_id, r.t_id): r for r in features.pair_features(pairs, q, t).collect()}
    best = rows["S1-1", "S2-1"]
    assert (best.n_tset, best.num_first_eq, best.num_conflict, best.t_is_s3, best.name_core_eq, best.t_has_addr) == (1.0, 1, 0, 0, 1, 1)
    other = rows["S1-2", "S3-2"]
    assert (other.t_is_s3, other.t_has_addr, other.num_first_eq, other.num_conflict, other.q_n_nums, other.t_n_nums) == (1, 0, None, 0, 1, 0)
    assert {"t_translit", "t_has_addr", "q_name_freq", "t_name_freq"} <= set(best.asDict())


def test_siblings(spark):
    q, t = halves(spark, TOYS)
    pairs = spark.createDataFrame([("S1-1", "S2-1", 0.9), ("S1-1", "S3-1", 0.8), ("S1-2", "S2-2", 0.4)], "s1_id string, t_id string, p1 double")
    rows = {(r.s1_id, r.t_id): r for r in features.stage2(pairs, t).collect()}
    assert rows["S1-1", "S3-1"].sib_top1_name == 1.0 and rows["S1-1", "S2-1"].sib_top1_addr == 1.0
    assert rows["S1-2", "S2-2"].sib_top2_name is None and rows["S1-2", "S2-2"].sib_top1_name == 1.0


def test_nothing(spark, pairs):
    none = pairs.limit(0)
    assert features.context(none).count() == features.stage0(none).count() == 0
    assert features.standing(none.selectExpr("s1_id", "t_id", "cos_both as p1")).count() == 0
