"""Reports on tables of a run: what candidates reach, and what features tell."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def candidate_report(pairs: DataFrame, truth: DataFrame, ids: DataFrame, channels: tuple[str, ...], cutoffs: tuple[int, ...] = (10, 20, 40, 60)) -> DataFrame:
    """``ckey, what, true_pairs, hits, recall, candidates, avg_per_query, p95, p99``.

    ``ids`` has the country of each ``s1_id``. One row of a country for the union,
    for each channel, and for the best pairs of each query by ``score0`` at
    each cut-off where the table has that score; what no pair is in has no row.
    Numbers are of queries that have a candidate; recall is null without a true pair.
    """
    whats = {"union": F.lit(True), **{c: F.col(f"rank_{c}") >= 0 for c in channels}}
    marked = pairs.join(ids.select("s1_id", "ckey").distinct(), "s1_id")
    if "score0" in pairs.columns:
        marked = marked.withColumn("_place", F.row_number().over(Window.partitionBy("s1_id").orderBy(F.desc("score0"), "t_id")))
        whats |= {f"top {n}": F.col("_place") <= n for n in cutoffs}
    true = truth.select("s1_id", "t_id").distinct()
    marked = marked.join(true.withColumn("_true", F.lit(1)), ["s1_id", "t_id"], "left")
    what = F.explode(F.filter(F.array(*(F.when(rule, F.lit(name)) for name, rule in whats.items())), lambda x: x.isNotNull()))
    each = marked.select("ckey", "s1_id", "_true", what.alias("what")).groupBy("ckey", "what", "s1_id").agg(F.count("*").alias("n"), F.count("_true").alias("hits"))
    sums = each.groupBy("ckey", "what").agg(
        F.sum("hits").alias("hits"), F.sum("n").alias("candidates"), F.avg("n").alias("avg_per_query"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY n)").cast("long").alias("p95"), F.expr("percentile_disc(0.99) WITHIN GROUP (ORDER BY n)").cast("long").alias("p99"),
    )
    n_true = true.join(ids.select("s1_id", "ckey").distinct(), "s1_id").groupBy("ckey").agg(F.count("*").alias("true_pairs"))
    return sums.join(n_true, "ckey", "left").select(
        "ckey", "what", F.coalesce("true_pairs", F.lit(0)).alias("true_pairs"), "hits", (F.col("hits") / F.col("true_pairs")).alias("recall"), "candidates", "avg_per_query", "p95", "p99",
    )


def feature_report(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``label, n, share`` and the mean of each feature, in one pass; a share is of all rows."""
    sums = rows.groupBy("label").agg(F.count("*").alias("n"), *(F.avg(c).alias(c) for c in columns))
    total = rows.agg(F.count("*").alias("_all"))
    # one row beside one row for each label
    return sums.join(F.broadcast(total)).select("label", "n", (F.col("n") / F.col("_all")).alias("share"), *columns)


def examples(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs beside the raw names and addresses of both records, as a reader wants to see errors."""
    out = pairs
    for side, key, rows in (("q", "s1_id", queries), ("t", "t_id", targets)):
        raw = rows.select(F.col("entity_id").alias(key), F.col("business_name").alias(f"{side}_name"), F.col("business_address").alias(f"{side}_address"))
        out = out.join(raw, key, "left")
    return out
