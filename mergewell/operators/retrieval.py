"""Multi-channel candidate retrieval: top-K by cosine, union, recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergewell.operators.lineage import written
from mergewell.operators.vectors import Channel, Field, dot_products, postings, sides

#: Decimals at which scores are compared, so that sums in another order rank alike.
DECIMALS = 6


def channels() -> tuple[Channel, ...]:
    """The six standard channels."""
    name, addr = (lambda w=1.0: Field("name_core", weight=w)), (lambda w=1.0: Field("addr_norm", weight=w))
    return (
        Channel("addr", (addr(),), 40, 0.02),
        Channel("both", (name(0.5), addr(0.5)), 40, 0.02),
        Channel("cross", (Field("name_core", "cross", other="addr_norm"),), 20, 0.01),
        Channel("name", (name(),), 10, 0.01),
        Channel("noaddr", (name(),), 10, 0.05, pool="no_addr"),
        Channel("translit", (Field("name_phon", "cross", other="addr_norm"),), 20, 0.05, pool="translit"),
    )


def _of_channel(of: tuple[Channel, ...], value: str) -> Column:
    return F.element_at(F.array(*(F.lit(getattr(c, value)) for c in of)), F.col("channel") + 1)


def top_k(rows: DataFrame, of: tuple[Channel, ...]) -> DataFrame:
    """``channel, s1_id, t_id, score, rank`` from postings: the K best searchable targets of the query's country, rank from 0.

    One join by term serves all channels. A term of many targets is joined in
    ``splits`` parts: its targets are dealt to the parts and its queries go to
    each, so no task holds a whole hot term. Sums start before the shuffle;
    ties go by t_id.
    """
    q, t = sides(rows)
    q = q.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("splits") - 1))).drop("splits")
    t = t.where("searchable").withColumn("part", F.pmod(F.xxhash64("t_id"), F.col("splits")).cast("int")).drop("splits", "searchable")
    scored = q.join(t, ["ckey", "channel", "block", "term", "part"]).groupBy("channel", "s1_id", "t_id").agg(F.round(F.sum(F.col("wq") * F.col("wt")), DECIMALS).alias("score"))
    best = F.row_number().over(Window.partitionBy("channel", "s1_id").orderBy(F.desc("score"), "t_id"))
    # the constant bound lets each task keep only so many rows of a query before the shuffle
    kept = scored.where(F.col("score") > _of_channel(of, "min_score")).withColumn("_n", best).where(F.col("_n") <= max(c.top_k for c in of))
    return kept.where(F.col("_n") <= _of_channel(of, "top_k")).select("channel", "s1_id", "t_id", "score", (F.col("_n") - 1).alias("rank"))


def search(channel: Channel, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """``s1_id, t_id, score, rank`` of one channel."""
    return top_k(postings(queries, targets, (channel,)), (channel,)).drop("channel")


def candidates(queries: DataFrame, targets: DataFrame, of: tuple[Channel, ...], corpus: DataFrame | None = None) -> DataFrame:
    """One row for each pair that a channel proposes: ``rank_<c>`` (-1: not by c) and the exact ``cos_<c>``.

    Postings of all channels are written once; one join finds the best targets
    of every channel, one aggregation unites them, one join takes all
    cosines. The plan is as large for six channels as for one. Term weights
    are those of the targets, or of a ``corpus`` where one is given.
    """
    rows = written(postings(queries, targets, of, corpus))
    ranks = [F.coalesce(F.max(F.when(F.col("channel") == k, F.col("rank"))), F.lit(-1)).alias(f"rank_{c.name}") for k, c in enumerate(of)]
    pairs = written(top_k(rows, of).groupBy("s1_id", "t_id").agg(*ranks))
    return dot_products(pairs, rows, of, DECIMALS)


def labeled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    true = truth.select("s1_id", "t_id").distinct().withColumn("label", F.lit(1))
    return pairs.join(true, ["s1_id", "t_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def recall(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: true pairs, how many are candidates, and candidates for each query (mean and upper percentiles)."""
    pairs, truth = pairs.select("s1_id", "t_id").distinct(), truth.select("s1_id", "t_id").distinct()
    found = truth.join(pairs.withColumn("_hit", F.lit(1)), ["s1_id", "t_id"], "left").agg(F.count("*").alias("true_pairs"), F.count("_hit").alias("hits"))
    shape = pairs.groupBy("s1_id").agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("candidates"), F.avg("n").alias("avg_per_query"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY n)").cast("long").alias("p95"), F.expr("percentile_disc(0.99) WITHIN GROUP (ORDER BY n)").cast("long").alias("p99"),
    )
    # two tables of one row
    both = found.unionByName(shape, allowMissingColumns=True)
    return both.agg(*(F.max(c).alias(c) for c in both.columns)).withColumn("recall", F.when(F.col("true_pairs") > 0, F.col("hits") / F.col("true_pairs")))


def recall_by_cutoff(pairs: DataFrame, truth: DataFrame, channel: str, cutoffs: tuple[int, ...]) -> DataFrame:
    """``k, hits`` of a channel at several cut-offs from one join."""
    hits = truth.select("s1_id", "t_id").distinct().join(pairs.where(F.col(f"rank_{channel}") >= 0), ["s1_id", "t_id"])
    sums = hits.agg(*(F.count_if(F.col(f"rank_{channel}") < k).alias(str(k)) for k in cutoffs))
    stack = ", ".join(f"{k}, `{k}`" for k in cutoffs)
    return sums.select(F.expr(f"stack({len(cutoffs)}, {stack}) AS (k, hits)"))


def recall_by_channel(pairs: DataFrame, truth: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """``channel, pairs, hits`` for each channel and their union."""
    rows = labeled(pairs, truth)
    each = [F.struct(F.lit("union").alias("channel"), F.lit(True).alias("in")), *(F.struct(F.lit(n).alias("channel"), (F.col(f"rank_{n}") >= 0).alias("in")) for n in names)]
    rows = rows.select("label", F.explode(F.array(*each)).alias("x")).where("x.in")
    return rows.groupBy("x.channel").agg(F.count("*").alias("pairs"), F.sum("label").alias("hits")).select("channel", "pairs", "hits")
