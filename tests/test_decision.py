"""Decision and metrics: golden cases, and direct computations on random pairs."""

import math
import random

import pytest

from mergewell.operators import decision

PRED, PAIR = "s1_id string, t_id string, p double", "s1_id string, t_id string"


def rows(df):
    return sorted((r.s1_id, r.t_id) for r in df.collect())


def test_exclusive(spark):
    pred = spark.createDataFrame([("A", "x", 0.9), ("B", "x", 0.6), ("B", "y", 0.8), ("A", "z", 0.3), ("C", "z", 0.3)], PRED)
    assert rows(decision.exclusive(pred)) == [("A", "x"), ("A", "z"), ("B", "y")]


def test_threshold(spark):
    pred = spark.createDataFrame([("A", "x", 0.9), ("B", "y", 0.2), ("C", "z", 0.5)], PRED)
    assert rows(decision.above(pred, 0.5)) == [("A", "x"), ("C", "z")]


def test_expected_f(spark):
    assert rows(decision.expected_f(spark.createDataFrame([("A", "x", 0.05), ("A", "y", 0.04)], PRED))) == []
    assert rows(decision.expected_f(spark.createDataFrame([("A", "x", 0.97), ("A", "y", 0.95), ("A", "z", 0.10)], PRED))) == [("A", "x"), ("A", "y")]
    assert decision.expected_f(spark.createDataFrame([], PRED)).count() == 0


@pytest.mark.parametrize("missed", [0.0, 0.3])
def test_expected_f_direct(spark, missed):
    rng = random.Random(4)
    pred = [(f"q{q}", f"t{k}", round(rng.random(), 2)) for q in range(60) for k in range(rng.randint(1, 6))]
    want = []
    for q in {r[0] for r in pred}:
        own = sorted((r for r in pred if r[0] == q and r[2] >= 0.02), key=lambda r: (-r[2], r[1]))
        total, best, take = sum(r[2] for r in own), math.prod(max(1 - r[2], 1e-9) for r in own) / (1 + missed), 0
        for k in range(1, len(own) + 1):
            f = 1.25 * sum(r[2] for r in own[:k]) / (0.25 * (total + missed) + k)
            if f > best + 1e-12:
                best, take = f, k
        want += [r[:2] for r in own[:take]]
    assert rows(decision.expected_f(spark.createDataFrame(pred, PRED), missed)) == sorted(want)


@pytest.mark.parametrize(("counts", "f"), [((0, 0, 0), 1.0), ((0, 2, 0), 0.0), ((0, 0, 3), 0.0), ((2, 2, 2), 1.0), ((2, 3, 2), 0.7142857)])
def test_fbeta(spark, counts, f):
    got = spark.createDataFrame([counts], "tp long, n_pred long, n_true long")
    assert abs(got.select(decision.fbeta(got.tp, got.n_pred, got.n_true)).first()[0] - f) < 1e-6


def test_per_entity(spark):
    ids = spark.createDataFrame([(x,) for x in "ABCDA"], "s1_id string")
    truth = spark.createDataFrame([("A", "x"), ("C", "y"), ("A", "x")], PAIR)
    pred = spark.createDataFrame([("A", "x"), ("B", "z"), ("A", "x")], PAIR)
    each = {r.s1_id: r.f for r in decision.per_entity(ids, pred, truth).collect()}
    assert each == {"A": 1.0, "B": 0.0, "C": 0.0, "D": 1.0}
    total = decision.summary(decision.per_entity(ids, pred, truth)).first()
    assert (total.macro_f, total.n_s1, total.micro_precision, total.micro_recall, total.singleton_accuracy) == (0.5, 4, 0.5, 0.5, 0.5)


def test_nothing_predicted(spark):
    ids, none = spark.createDataFrame([("A",), ("B",)], "s1_id string"), spark.createDataFrame([], PAIR)
    total = decision.summary(decision.per_entity(ids, none, spark.createDataFrame([("A", "x")], PAIR))).first()
    assert (total.macro_f, total.singleton_accuracy, total.micro_recall, total.micro_precision) == (0.5, 1.0, 0.0, None)
    assert decision.per_entity(ids.limit(0), none, none).count() == 0


def test_grid_and_best_rule(spark):
    ids = spark.createDataFrame([("A",), ("B",)], "s1_id string")
    pred = spark.createDataFrame([("A", "x", 0.9), ("A", "n", 0.3), ("B", "m", 0.35)], PRED)
    truth = spark.createDataFrame([("A", "x")], PAIR)
    grid = {(r.exclusive, r.tau): r.macro_f for r in decision.threshold_grid(ids, pred, truth, [0.1, 0.35, 0.4, 0.9, 0.95]).collect()}
    assert grid[False, 0.4] == grid[True, 0.9] == 1.0 and grid[False, 0.95] == 0.5 and grid[False, 0.1] < grid[False, 0.35] < 1
    rule, table = decision.best_rule(ids, pred, truth)
    assert rule["macro_f"] == 1.0 and 0.35 < rule["tau"] <= 0.9 and table.count() == 59
    assert rows(decision.decide(pred, rule)) == [("A", "x")]


def test_best_rule_by_expected_f(spark):
    """Every row of the grid agrees with applying that rule alone."""
    rng = random.Random(9)
    pred = spark.createDataFrame([(f"q{q}", f"t{rng.randint(0, 30)}{k}", round(rng.random(), 3)) for q in range(25) for k in range(3)], PRED)
    ids = pred.select("s1_id").distinct()
    truth = pred.where("p > 0.6").select("s1_id", "t_id").sample(0.7, 3)
    truth = spark.createDataFrame(truth.collect(), PAIR)
    _, table = decision.best_rule(ids, pred, truth)
    for r in table.where("tau is null or tau in (0.2, 0.525)").collect():
        rule = {"method": "threshold" if r.tau is not None else "expected_f", "exclusive": r.exclusive, "tau": r.tau, "missed": r.missed}
        alone = decision.summary(decision.per_entity(ids, decision.decide(pred, rule), truth)).first().macro_f
        assert abs(alone - r.macro_f) < 1e-9, rule


def test_report_and_bins(spark):
    ids = spark.createDataFrame([("A", "us"), ("B", "us"), ("C", "india")], "s1_id string, ckey string")
    each = decision.per_entity(ids, spark.createDataFrame([("A", "x")], PAIR), spark.createDataFrame([("A", "x"), ("C", "y")], PAIR))
    report = {r.ckey: (r.macro_f, r.n_s1) for r in decision.report(each.join(ids, "s1_id")).collect()}
    assert report["us"] == (1.0, 2) and report["india"] == (0.0, 1) and report["ALL"][1] == 3
    bins = decision.calibration(spark.createDataFrame([(0.05, 0), (1.0, 1), (0.95, 1), (0.0, 1)], "p double, label int"))
    assert {r.bin: (r.n, r.hit_rate) for r in bins.collect()} == {0: (2, 0.5), 9: (2, 1.0)}


def test_errors(spark):
    pred = spark.createDataFrame([("A", "x"), ("A", "y")], PAIR)
    truth = spark.createDataFrame([("A", "x"), ("B", "z"), ("B", "w")], PAIR)
    wrong, lost = decision.errors(pred, truth, spark.createDataFrame([("B", "z", 0.1)], PRED))
    assert rows(wrong) == [("A", "y")] and sorted((r.t_id, r.p) for r in lost.collect()) == [("w", None), ("z", 0.1)]
