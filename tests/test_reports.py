"""Reports and queries through files."""

from mergewell.plans import files, reports

PAIR = "s1_id string, t_id string, rank_a int, rank_b int, score0 double"


def test_candidate_report(spark):
    ids = spark.createDataFrame([("q1", "us"), ("q2", "us"), ("q3", "india"), ("q4", "peru")], "s1_id string, ckey string")
    pairs = spark.createDataFrame([("q1", "x", 0, -1, 0.9), ("q1", "y", 1, 0, 0.1), ("q2", "x", -1, 0, 0.5), ("q3", "z", 0, 0, 0.2)], PAIR)
    truth = spark.createDataFrame([("q1", "y"), ("q1", "y"), ("q2", "w"), ("q3", "z"), ("q4", "v")], "s1_id string, t_id string")
    got = {(r.ckey, r.what): r for r in reports.candidate_report(pairs, truth, ids, ("a", "b"), (1, 5)).collect()}
    assert set(got) == {(c, w) for c in ("us", "india") for w in ("union", "a", "b", "top 1", "top 5")}
    us = got["us", "union"]
    assert (us.true_pairs, us.hits, us.recall, us.candidates, us.avg_per_query, us.p95, us.p99) == (2, 1, 0.5, 3, 1.5, 2, 2)
    assert got["us", "top 1"].hits == 0 and got["us", "a"].candidates == 2 and got["india", "top 5"].recall == 1.0
    without = reports.candidate_report(pairs.drop("score0"), truth.limit(0), ids, ("a",)).collect()
    assert {r.what for r in without} == {"union", "a"} and all(r.true_pairs == 0 and r.recall is None for r in without)
    assert reports.candidate_report(pairs.limit(0), truth, ids, ("a", "b")).count() == 0


def test_feature_report(spark):
    rows = spark.createDataFrame([(0, 1.0, None), (0, 3.0, 2), (1, 5.0, 4)], "label int, x double, y int")
    got = {r.label: (r.n, round(r.share, 6), r.x, r.y) for r in reports.feature_report(rows, ["x", "y"]).collect()}
    assert got == {0: (2, 0.666667, 2.0, 2.0), 1: (1, 0.333333, 5.0, 4.0)}
    assert reports.feature_report(rows.limit(0), ["x", "y"]).count() == 0


def test_examples(spark):
    records = spark.createDataFrame([("q", "A", "1 st"), ("t", "B", None)], "entity_id string, business_name string, business_address string")
    got = reports.examples(spark.createDataFrame([("q", "t"), ("q", "gone")], "s1_id string, t_id string"), records, records)
    assert sorted((r.q_name, r.t_name, r.q_address) for r in got.collect() if r.t_name) == [("A", "B", "1 st")] and got.count() == 2


def test_through_files(spark):
    raw = spark.createDataFrame([("S1-1", " a  ", None, "US "), ("S2-1", 'say "x"', "1 st", None)], "entity_id string, business_name string, business_address string, country string")
    assert sorted(map(str, files.sources(raw).collect())) == sorted(map(str, raw.collect()))
    ids, pairs = spark.createDataFrame([("a",), ("b",)], "s1_id string"), spark.createDataFrame([("a", "x"), ("a", "y")], "s1_id string, t_id string")
    assert sorted(map(tuple, files.lists(ids, pairs).collect())) == [("a", "x"), ("a", "y")] and files.line_count(ids, pairs).first().n == 2
    assert sorted(map(tuple, files.ranged(pairs.union(ids.selectExpr("s1_id", "'z' as t_id")), "a", "b").collect())) == [("a", "x"), ("a", "y"), ("a", "z")]
    assert files.together([pairs, pairs]).count() == 4
