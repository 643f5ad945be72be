"""Models by fold: one copy of the rows, each scored by a model that has not seen its entity."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from mergewell.operators import boosting, learning
from mergewell.operators.lineage import shared_folder


def used(folder):
    return sum(f.stat().st_size for f in Path(folder.removeprefix("file:")).rglob("*") if f.is_file())


def test_out_of_fold_keeps_one_copy(spark):
    n, columns = 3000, [f"x{k}" for k in range(30)]
    rows = spark.range(n).select(F.concat(F.lit("S1-"), (F.col("id") / 3).cast("int").cast("string")).alias("s1_id"), F.col("id").cast("string").alias("t_id"), (F.col("id") % 2).cast("int").alias("label"), *(F.rand(k).alias(c) for k, c in enumerate(columns)))
    rows = rows.withColumn("x0", F.when(F.col("label") == 1, F.col("x0")))
    folder = shared_folder(spark)
    before = used(folder)
    out, models = learning.out_of_fold(rows, columns, "p1", folds=3, rounds=2, depth=2)
    assert used(folder) - before < 1.5 * n * len(columns) * 8
    got = out.groupBy("label").agg(F.count("*").alias("n"), F.countDistinct("t_id").alias("ids"), F.min("p1").alias("low"), F.max("p1").alias("high")).orderBy("label").collect()
    assert [(r.n, r.ids) for r in got] == [(n / 2, n / 2)] * 2 and got[0].high < 0.5 < got[1].low
    assert len(models) == 3 and out.columns == [*rows.columns, "p1"]


def table(spark, n=4000, parts=4):
    """Rows of a label that follows from three columns, one of them with nulls and one with NaN."""
    x = lambda k, m: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(m))
    rows = spark.range(n, numPartitions=parts).select(
        F.concat(F.lit("S1-"), (F.col("id") / 4).cast("int").cast("string")).alias("s1_id"), F.col("id").cast("string").alias("t_id"),
        x(1, 20).alias("a"), F.when(x(2, 9) > 0, x(3, 16) / 7).alias("b"), (x(4, 2) > 0).alias("c"), F.when(x(5, 11) == 0, F.lit(float("nan"))).otherwise(x(6, 25) / 3).alias("d"), x(7, 100).alias("noise"),
    )
    return rows.withColumn("label", ((F.col("a") + 3 * F.coalesce("b", F.lit(4.0)) + F.col("c").cast("int") * 5 + F.col("noise") / 10) > 16).cast("int")).drop("noise")


COLUMNS = ["a", "b", "c", "d"]


def test_out_of_fold_grows_all_models_in_the_same_jobs(spark):
    rows, rounds, depth = table(spark), 4, 3
    spark.sparkContext.setJobGroup("folds", "")
    try:
        _, models = learning.out_of_fold(rows, COLUMNS, "p1", folds=5, rounds=rounds, depth=depth)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("folds")
    # one for each level, the last loss, and a few for the copy, counts and ends of bins
    assert len(models) == 5 and 0 < len(jobs) <= rounds * depth + 1 + 8


def test_trees_are_those_of_spark(spark):
    rows = table(spark, 1500)
    model = boosting.boosted(rows, COLUMNS, [F.lit(True)], None, 6, 3, 0.1, 1, 5, share=1.0)[0]
    data = learning.assembled(rows.withColumn("_y", F.col("label").cast("double")), COLUMNS)
    known = GBTClassifier(featuresCol="_features", labelCol="_y", maxIter=6, maxDepth=3, stepSize=0.1, subsamplingRate=1.0, featureSubsetStrategy="all", minInstancesPerNode=5).fit(data)
    ours, theirs = (np.array([r.probability[1] for r in m.transform(data).orderBy("t_id").collect()]) for m in (model, known))
    assert model.getNumTrees == known.getNumTrees == 6 and list(model.treeWeights) == list(known.treeWeights)
    assert abs(ours - theirs).max() < 1e-4
    assert abs(model.featureImportances.toArray() - known.featureImportances.toArray()).max() < 1e-4


def test_models_stop_and_do_not_depend_on_parts(spark, monkeypatch):
    def scores(parts):
        out, models = learning.out_of_fold(table(spark, 2000, parts), COLUMNS, "p1", folds=3, rounds=12, depth=2, rate=1.0)
        return [m.getNumTrees for m in models], [tuple(r) for r in out.select("t_id", "p1").orderBy("t_id").collect()]

    numbers, found = scores(3)
    monkeypatch.setattr(boosting, "RENEW", 2)
    assert (numbers, found) == scores(7)
    assert all(1 <= n <= 12 for n in numbers) and any(n < 12 for n in numbers)


def test_few_or_wrong_rows(spark):
    rows = table(spark, 40)
    # no row decides: all rounds; all rows decide: none does
    for stop in (F.lit(False), F.lit(True), F.lit(None).cast("boolean")):
        assert boosting.boosted(rows, COLUMNS, [F.lit(True)], [stop], 3, 2, 0.1, 1, 1)[0].getNumTrees == 3
    with pytest.raises(ValueError, match="no row"):
        boosting.boosted(rows, COLUMNS, [F.lit(False)], None, 3, 2, 0.1, 1, 1)
    with pytest.raises(ValueError, match="labels"):
        boosting.boosted(rows.withColumn("label", F.lit(2)), COLUMNS, [F.lit(True)], None, 3, 2, 0.1, 1, 1)
    one = boosting.boosted(rows.withColumn("label", F.lit(1)), COLUMNS, [F.lit(True)], None, 2, 2, 0.1, 1, 1)[0]
    assert [t.numNodes for t in one.trees] == [1, 1]
