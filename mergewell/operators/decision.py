"""From scored pairs to matches, and how good they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergewell.operators.lineage import written

BETA = 0.5


def exclusive(pred: DataFrame, score: str = "p") -> DataFrame:
    """Each target stays with the query that scores it highest; ties with the smaller id."""
    best = Window.partitionBy("t_id").orderBy(F.desc(score), "s1_id")
    return pred.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")


def above(pred: DataFrame, tau: float, score: str = "p") -> DataFrame:
    return pred.where(F.col(score) >= tau)


def expected_f(pred: DataFrame, missed: float | Column = 0.0, floor: float = 0.02, score: str = "p", beta: float = BETA, key: tuple[str, ...] = ("s1_id",)) -> DataFrame:
    """For each query the shortest list of its best pairs with the highest expected F, if that beats an empty one.

    ``missed`` is how many true pairs are expected outside ``pred``, a number or a
    column that is constant within ``key``. Ties of the score go by t_id.
    """
    missed = missed if isinstance(missed, Column) else F.lit(missed)
    rows = pred.where(F.col(score) >= floor)
    whole = Window.partitionBy(*key)
    down = whole.orderBy(F.desc(score), "t_id").rowsBetween(Window.unboundedPreceding, 0)
    p = F.col(score)
    rows = rows.withColumns({"_k": F.count("*").over(down), "_cum": F.sum(p).over(down), "_all": F.sum(p).over(whole)})
    b2 = beta * beta
    rows = rows.withColumn("_ef", (1 + b2) * F.col("_cum") / (b2 * (F.col("_all") + missed) + F.col("_k")))
    empty = F.exp(F.sum(F.ln(F.greatest(F.least(1 - p, F.lit(1.0)), F.lit(1e-9)))).over(whole)) / (1 + missed)
    rows = rows.withColumns({"_best": F.max("_ef").over(whole), "_none": empty})
    rows = rows.withColumn("_take", F.min(F.when(F.col("_ef") == F.col("_best"), F.col("_k"))).over(whole))
    return rows.where("_best > _none and _k <= _take").select(*pred.columns)


def decide(pred: DataFrame, rule: dict) -> DataFrame:
    """Applies a rule: ``method`` threshold or expected_f, ``exclusive``, ``tau``, ``missed``, ``floor``, ``score_col``."""
    score = rule.get("score_col", "p")
    rows = exclusive(pred, score) if rule.get("exclusive") else pred
    if rule["method"] == "threshold":
        return above(rows, rule["tau"], score)
    return expected_f(rows, rule.get("missed", 0.0), rule.get("floor", 0.02), score)


def fbeta(tp: Column, n_pred: Column, n_true: Column, beta: float = BETA) -> Column:
    """1 if nothing is predicted and nothing true, 0 without a hit."""
    precision, recall, b2 = tp / n_pred, tp / n_true, beta * beta
    return F.when((n_pred == 0) & (n_true == 0), 1.0).when(tp == 0, 0.0).otherwise((1 + b2) * precision * recall / (b2 * precision + recall))


def per_entity(ids: DataFrame, pred: DataFrame, truth: DataFrame, beta: float = BETA) -> DataFrame:
    """``s1_id, tp, n_pred, n_true, f`` for every id, also those without pairs."""
    both = pred.select("s1_id", "t_id", F.lit(1).alias("_p"), F.lit(0).alias("_y")).unionByName(truth.select("s1_id", "t_id", F.lit(0).alias("_p"), F.lit(1).alias("_y")))
    pairs = both.groupBy("s1_id", "t_id").agg(F.max("_p").alias("_p"), F.max("_y").alias("_y"))
    sums = pairs.groupBy("s1_id").agg(F.sum(F.col("_p") * F.col("_y")).alias("tp"), F.sum("_p").alias("n_pred"), F.sum("_y").alias("n_true"))
    rows = ids.select("s1_id").distinct().join(sums, "s1_id", "left").na.fill(0, ["tp", "n_pred", "n_true"])
    return rows.withColumn("f", fbeta(F.col("tp"), F.col("n_pred"), F.col("n_true"), beta))


def summary(scores: DataFrame, *by: str) -> DataFrame:
    """Macro F, micro precision and recall, and accuracy on entities without a true pair."""
    single = F.col("n_true") == 0
    return scores.groupBy(*by).agg(
        F.avg("f").alias("macro_f"), (F.sum("tp") / F.nullif(F.sum("n_pred"), F.lit(0))).alias("micro_precision"),
        (F.sum("tp") / F.nullif(F.sum("n_true"), F.lit(0))).alias("micro_recall"),
        F.avg(F.when(single, (F.col("n_pred") == 0).cast("double"))).alias("singleton_accuracy"), F.count("*").alias("n_s1"),
    )


def report(scores: DataFrame) -> DataFrame:
    """``summary`` for each country (column ``ckey``) and for ALL, by one rollup."""
    single = F.col("n_true") == 0
    rows = scores.rollup("ckey").agg(
        F.grouping("ckey").alias("_all"), F.avg("f").alias("macro_f"), (F.sum("tp") / F.nullif(F.sum("n_pred"), F.lit(0))).alias("micro_precision"),
        (F.sum("tp") / F.nullif(F.sum("n_true"), F.lit(0))).alias("micro_recall"), F.avg(F.when(single, (F.col("n_pred") == 0).cast("double"))).alias("singleton_accuracy"), F.count("*").alias("n_s1"),
    )
    return rows.withColumn("ckey", F.when(F.col("_all") == 1, "ALL").otherwise(F.col("ckey"))).drop("_all")


def threshold_grid(ids: DataFrame, pred: DataFrame, truth: DataFrame, taus: list[float], score: str = "p", both: bool = True) -> DataFrame:
    """Macro F of every threshold, with and without exclusivity, from one pass over the pairs.

    A pair counts for each threshold it reaches; the grid is a constant list.
    """
    best = Window.partitionBy("t_id").orderBy(F.desc(score), "s1_id")
    true = truth.select("s1_id", "t_id").distinct().withColumn("_y", F.lit(1))
    rows = pred.join(true, ["s1_id", "t_id"], "left").withColumns({"_y": F.coalesce("_y", F.lit(0)), "_first": F.row_number().over(best) == 1})
    kinds = F.array(F.lit(False), F.lit(True)) if both else F.array(F.lit(False))
    rows = rows.withColumn("exclusive", F.explode(kinds)).where("not exclusive or _first")
    rows = rows.withColumn("tau", F.explode(F.filter(F.array(*map(F.lit, taus)), lambda t: t <= F.col(score))))
    hits = rows.groupBy("s1_id", "exclusive", "tau").agg(F.sum("_y").alias("tp"), F.count("*").alias("n_pred"))
    n_true = true.groupBy("s1_id").agg(F.count("*").alias("n_true"))
    base = ids.select("s1_id").distinct().join(n_true, "s1_id", "left").na.fill(0)
    grid = base.withColumn("exclusive", F.explode(kinds)).withColumn("tau", F.explode(F.array(*map(F.lit, taus))))
    rows = grid.join(hits, ["s1_id", "exclusive", "tau"], "left").na.fill(0, ["tp", "n_pred"])
    return rows.withColumn("f", fbeta(F.col("tp"), F.col("n_pred"), F.col("n_true"))).groupBy("exclusive", "tau").agg(F.avg("f").alias("macro_f"))


MISSED = (0.0, 0.05, 0.1, 0.2, 0.3)


def expected_f_grid(ids: DataFrame, pred: DataFrame, truth: DataFrame, score: str = "p") -> DataFrame:
    """``missed, macro_f``: exclusive pairs chosen by expected F for each of ``MISSED``, in one pass over the pairs."""
    each = F.explode(F.array(*map(F.lit, MISSED)))
    rows = exclusive(pred, score).select("s1_id", "t_id", F.col(score).alias("p"), each.alias("missed"))
    chosen = expected_f(rows, F.col("missed"), key=("s1_id", "missed"))
    true = truth.select("s1_id", "t_id").distinct().withColumn("_y", F.lit(1))
    hits = chosen.join(true, ["s1_id", "t_id"], "left").groupBy("s1_id", "missed").agg(F.count("*").alias("n_pred"), F.count("_y").alias("tp"))
    n_true = true.groupBy("s1_id").agg(F.count("*").alias("n_true"))
    base = ids.select("s1_id").distinct().join(n_true, "s1_id", "left").na.fill(0).withColumn("missed", each)
    rows = base.join(hits, ["s1_id", "missed"], "left").na.fill(0, ["tp", "n_pred"])
    return rows.withColumn("f", fbeta(F.col("tp"), F.col("n_pred"), F.col("n_true"))).groupBy("missed").agg(F.avg("f").alias("macro_f"))


def best_rule(ids: DataFrame, pred: DataFrame, truth: DataFrame, score: str = "p") -> tuple[dict, DataFrame]:
    """The best of thresholds .2 to .85, exclusive or not, and of expected F with five losses; the grid has a row for each."""
    taus = [round(0.2 + 0.025 * k, 3) for k in range(27)]
    none = F.lit(None).cast("double")
    grid = threshold_grid(ids, pred, truth, taus, score).withColumn("missed", none)
    grid = written(grid.unionByName(expected_f_grid(ids, pred, truth, score).select(F.lit(True).alias("exclusive"), none.alias("tau"), "macro_f", "missed")))
    top = grid.orderBy(F.desc("macro_f"), F.asc_nulls_last("tau"), "exclusive", "missed").first()
    rule = {"method": "threshold" if top.tau is not None else "expected_f", "exclusive": bool(top.exclusive), "tau": top.tau, "missed": top.missed, "floor": 0.02, "score_col": score, "macro_f": top.macro_f}
    return rule, grid


def errors(pred: DataFrame, truth: DataFrame, scores: DataFrame, n: int = 15, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Up to ``n`` wrong and ``n`` missing pairs in a seeded order; a missing pair without a score never was a candidate."""
    order = F.xxhash64("s1_id", "t_id", F.lit(seed))
    wrong = pred.join(truth.select("s1_id", "t_id"), ["s1_id", "t_id"], "left_anti")
    lost = truth.select("s1_id", "t_id").distinct().join(pred.select("s1_id", "t_id"), ["s1_id", "t_id"], "left_anti").join(scores, ["s1_id", "t_id"], "left")
    return wrong.orderBy(order).limit(n), lost.orderBy(order).limit(n)


def calibration(rows: DataFrame, score: str = "p") -> DataFrame:
    """Ten bins of the score: mean score, share of true pairs, rows."""
    bin_ = F.least(F.floor(F.col(score) * 10), F.lit(9)).cast("int")
    return rows.groupBy(bin_.alias("bin")).agg(F.avg(score).alias("mean_p"), F.avg("label").alias("hit_rate"), F.count("*").alias("n"))
