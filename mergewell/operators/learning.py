"""Gradient-boosted scoring with folds by entity."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mergewell.functions.hashing import fold, sampled
from mergewell.operators.boosting import boosted
from mergewell.operators.features import stage0
from mergewell.operators.lineage import stored
from mergewell.sources import storage

#: Columns that identify a row or say the answer.
NOT_FEATURES = ("s1_id", "t_id", "label", "p1", "p", "ckey")


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if c not in NOT_FEATURES and kind in ("int", "bigint", "double", "float", "boolean", "smallint", "tinyint")]


def assembled(df: DataFrame, columns: list[str]) -> DataFrame:
    """A vector column; nulls and NaN become -1 and a flag of their own says so where they occur."""
    filled = {f"_x_{c}": F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(-1.0)), F.lit(-1.0)) for c in columns}
    return VectorAssembler(inputCols=list(filled), outputCol="_features").transform(df.withColumns(filled)).drop(*filled)


def train(
    df: DataFrame, columns: list[str], rounds: int = 20, depth: int = 5, rate: float = 0.1, stop_salt: int | None = None, stop_share: float = 0.08, seed: int = 42, least_rows: int = 1,
) -> GBTClassificationModel:
    """Boosted trees; with ``stop_salt`` a share of entities decides when to stop.

    Rows are read a few times, until they are binned, so a plan is stored once.
    Without a row for the decision, all rounds are run.
    """
    rows = stored(df.select(*dict.fromkeys(["label", *(c for c in ("s1_id", "t_id") if c in df.columns), *columns])))
    stops = None if stop_salt is None else [sampled(F.col("s1_id"), stop_share, stop_salt)]
    return boosted(rows, columns, [F.lit(True)], stops, rounds, depth, rate, seed, least_rows)[0]


def train_stage0(labeled: DataFrame, share: float = 0.15, rounds: int = 20, depth: int = 5, seed: int = 42) -> tuple[GBTClassificationModel, list[str]]:
    """The model that prunes candidates, from what retrieval alone tells, and its columns.

    It learns from a share of the queries of all countries (salt 3); a tenth of
    them (salt 7) decides when to stop.
    """
    rows = stage0(labeled.where(sampled(F.col("s1_id"), share, 3)))
    columns = stage0_columns(rows)
    return train(rows, columns, rounds, depth, 0.1, stop_salt=7, stop_share=0.1, seed=seed), columns


def stage0_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(("s0_", "cos_", "rank_"))]


def scored(model: GBTClassificationModel, df: DataFrame, columns: list[str], out: str) -> DataFrame:
    rows = model.transform(assembled(df, columns))
    return rows.withColumn(out, vector_to_array("probability")[1]).select(*df.columns, out)


def out_of_fold(
    df: DataFrame, columns: list[str], out: str, folds: int = 5, share: float = 1.0, salt: int = 1, rounds: int = 20, depth: int = 5, rate: float = 0.1, stop_share: float = 0.08, seed: int = 42, least_rows: int = 1,
) -> tuple[DataFrame, list[GBTClassificationModel]]:
    """Every row scored by the model that has not seen its entity, and the models.

    Model k learns from the other folds, or a share of their entities; another
    8 % of those (salt 100 + k) decide when to stop. All models are grown side
    by side from one copy of the rows.
    """
    rows = stored(df.withColumn("_fold", F.coalesce(fold(F.col("s1_id"), folds), F.lit(0))))
    seen = F.coalesce(sampled(F.col("s1_id"), share, salt), F.lit(True))
    models = boosted(rows, columns, [seen & (F.col("_fold") != k) for k in range(folds)], [sampled(F.col("s1_id"), stop_share, 100 + k) for k in range(folds)], rounds, depth, rate, seed, least_rows)
    parts = [scored(m, rows.where(F.col("_fold") == k), columns, out) for k, m in enumerate(models)]
    return reduce(DataFrame.unionByName, parts).drop("_fold"), models


def averaged(models: list[GBTClassificationModel], df: DataFrame, columns: list[str], out: str) -> DataFrame:
    """New rows by the mean of all models, without a join."""
    names = [f"_m{k}" for k in range(len(models))]
    for m, n in zip(models, names, strict=True):
        df = scored(m, df, columns, n)
    return df.withColumn(out, sum((F.col(n) for n in names), F.lit(0.0)) / len(names)).drop(*names)


def prune(df: DataFrame, per_query: int = 60, score: str = "score0") -> DataFrame:
    """The best pairs of each query by score, ties by t_id, without the columns of stage 0."""
    best = Window.partitionBy("s1_id").orderBy(F.desc(score), "t_id")
    rows = df.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= per_query)
    return rows.drop("_n", *(c for c in df.columns if c.startswith("s0_")))


def importance(models: list[GBTClassificationModel], columns: list[str]) -> list[tuple[str, float]]:
    total = reduce(lambda a, b: a + b, (m.featureImportances.toArray() for m in models)) / len(models)
    return sorted(zip(columns, total.tolist(), strict=True), key=lambda x: (-x[1], x[0]))


def save(spark: SparkSession, model: GBTClassificationModel, columns: list[str], path: str) -> None:
    """The model and beside it the columns it was trained on, which are written last."""
    model.write().overwrite().save(f"{path}/model")
    storage.write_json(spark, f"{path}/features.json", columns)


def load(spark: SparkSession, path: str, columns: list[str]) -> GBTClassificationModel:
    """The model, if it was trained on exactly these columns."""
    if (known := storage.read_json(spark, f"{path}/features.json")) != columns:
        raise ValueError(f"the model has {known}, not {columns}")
    return GBTClassificationModel.load(f"{path}/model")
