"""One query for each operator, over all records of the page table."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewell.functions.hashing import fold, id_hash, sampled
from mergewell.functions.normalize import name_frequency
from mergewell.operators import decision, features, learning, retrieval, validate, vectors
from mergewell.operators.lineage import written
from mergewell.plans import files, reports, stages
from mergewell.plans import records as R
from mergewell.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
CHANNELS = {c.name: c for c in retrieval.channels()}


class Case:
    """What queries share: records, their halves, truth, candidates and scores; each is written once."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def records(self) -> DataFrame:
        return R.records(self.spark, self.sf_dir)

    @property
    def queries(self) -> DataFrame:
        return R.split(self.records)[0]

    @property
    def targets(self) -> DataFrame:
        return R.split(self.records)[1]

    @property
    def ids(self) -> DataFrame:
        return self.queries.select(F.col("entity_id").alias("s1_id"), "ckey")

    @cached_property
    def truth(self) -> DataFrame:
        return R.truth(self.spark, self.sf_dir)

    @cached_property
    def pairs(self) -> DataFrame:
        return written(retrieval.candidates(self.queries, self.targets, tuple(CHANNELS.values())))

    @property
    def labeled(self) -> DataFrame:
        return retrieval.labeled(self.pairs, self.truth)

    @property
    def scores(self) -> DataFrame:
        return self.labeled.select("s1_id", "t_id", "label", F.round(0.6 * F.col("cos_both") + 0.4 * F.col("cos_addr"), 6).alias("p"))

    @cached_property
    def scored(self) -> DataFrame:
        return written(self.scores.select("s1_id", "t_id", F.col("p").alias("p1")))

    @property
    def matched(self) -> DataFrame:
        return decision.above(decision.exclusive(self.scores.drop("label")), 0.6)

    @property
    def per_entity(self) -> DataFrame:
        return decision.per_entity(self.ids, self.matched, self.truth)


def case(make: Callable[[Case], DataFrame]) -> Query:
    return lambda spark, sf_dir: make(Case(spark, sf_dir))


def _grams(c: Case) -> DataFrame:
    rows = c.records.select("entity_id", F.explode(vectors.grams(F.col("name_core"), 3)).alias("gram"))
    return rows.groupBy("gram").agg(F.count("*").alias("n"), F.countDistinct("entity_id").alias("df"))


def _idf(c: Case) -> DataFrame:
    of = (CHANNELS["addr"],)
    records = c.records.withColumn("is_target", ~F.col("entity_id").startswith("S1-"))
    idf = vectors.weights(vectors.counted(records, of), records, of)
    return idf.select("ckey", "term", F.round(F.col("uses")[0]["idf"], 9).alias("idf"))


def _postings(c: Case) -> DataFrame:
    return vectors.postings(c.queries, c.targets, (CHANNELS["both"],)).select("entity_id", "block", "term", F.round("w", 6).alias("w"))


def _cosines(c: Case) -> DataFrame:
    of = (CHANNELS["name"],)
    return vectors.dot_products(c.truth.distinct(), vectors.postings(c.queries, c.targets, of), of, retrieval.DECIMALS).withColumnRenamed("cos_name", "cos")


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.agg(F.count("*").alias("n"), F.count_if(F.col("url").isNull()).alias("url_nulls"), F.count_if(F.col("html").isNull()).alias("html_nulls"), F.countDistinct("url").alias("urls"))


def _scripts(c: Case) -> DataFrame:
    share = lambda x: F.avg(x.cast("int"))
    return c.records.groupBy("ckey", F.substring("entity_id", 1, 2).alias("source")).agg(
        F.count("*").alias("n"), share(F.col("translit")).alias("share_translit"), share(F.col("business_name").rlike(r"[^\x00-\x7F]")).alias("share_not_ascii"), share(~F.col("has_addr")).alias("share_no_address")
    )


def _histogram(c: Case) -> DataFrame:
    n = c.truth.distinct().groupBy("s1_id").agg(F.count("*").alias("matches"))
    return c.ids.join(n, "s1_id", "left").na.fill(0, ["matches"]).groupBy("matches").agg(F.count("*").alias("n"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("macro_f", F.round("macro_f", 9))


def _grid(c: Case) -> DataFrame:
    return _rounded(decision.threshold_grid(c.ids, c.scores.drop("label"), c.truth, [0.2, 0.4, 0.6, 0.8]))


def _siblings(c: Case) -> DataFrame:
    rows = features.stage2(c.scored, c.targets)
    return rows.select("s1_id", "t_id", *(F.round(x, 6).alias(x) for x in rows.columns if x.startswith("sib_")))


def _strings(c: Case) -> DataFrame:
    rows = features.strings(c.pairs, c.queries, c.targets)
    return rows.select("s1_id", "t_id", *(F.round(x, 9).alias(x) for x in rows.columns[2:]))


def _pruned(c: Case) -> DataFrame:
    """The 60 best pairs of each query by a model that learned from what retrieval tells."""
    rows = features.stage0(c.labeled)
    model, columns = learning.train_stage0(c.labeled, share=1.0, rounds=5)
    return learning.prune(learning.scored(model, rows, columns, "score0"))


def _trained(c: Case) -> DataFrame:
    """Scores of pairs by models that have not seen their query, from all features."""
    rows = features.context(features.pair_features(features.stage0(c.labeled), c.queries, c.targets))
    out, _ = learning.out_of_fold(rows, learning.feature_columns(rows), "p1", folds=5, rounds=20, depth=5)
    return out.select("s1_id", "t_id", "label", "p1")


def faulty(lists: DataFrame) -> DataFrame:
    """Id lists in which each rule is broken for some ids, by the number of the id."""
    key, ids = lists.columns
    k = F.expr(f"(cast(regexp_extract({key}, '(\\\\d+)$', 1) as bigint) div 3) % 8")
    extra = F.when(F.col("_k") == 3, ",S2-999999999").when(F.col("_k") == 4, ",S2-1,S2-1").when(F.col("_k") == 5, ",S1-0").when(F.col("_k") == 6, ", X-1").otherwise("")
    rows = lists.withColumn("_k", k).where("_k <> 1").withColumn("_copy", F.explode(F.when(F.col("_k") == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows.select(F.when(F.col("_k") == 2, F.concat(key, F.lit("00"))).otherwise(F.col(key)).alias(key), F.concat(ids, extra).alias(ids))


def _validated(c: Case) -> DataFrame:
    matches, lists = tables.id_lists(c.ids, c.matched), tables.id_lists(c.ids, c.pairs, tables.CANDIDATES)
    return validate.problems(faulty(matches), faulty(lists), c.ids, c.targets.select(F.col("entity_id").alias("t_id")))


def _report(c: Case) -> DataFrame:
    pruned = learning.prune(c.labeled.drop("label").withColumn("score0", F.round(0.6 * F.col("cos_both") + 0.4 * F.col("cos_addr"), 6)), 60)
    return reports.candidate_report(pruned, c.truth, c.ids, tuple(CHANNELS), (1, 5, 20))


def _means(c: Case) -> DataFrame:
    rows = reports.feature_report(features.context(features.stage0(c.labeled)), ["cos_both", "s0_n_channels", "q_n_cands", "t_rank_cos_both", "t_margin_cos_both"])
    return rows.select("label", "n", *(F.round(x, 9).alias(x) for x in rows.columns[2:]))


def _faults(c: Case) -> DataFrame:
    """What the check of a candidate table says of a good one, and of ones with each fault."""
    of = tuple(CHANNELS.values())
    made = {
        "good": c.pairs, "column": c.pairs.drop("cos_addr"), "repeated": c.pairs.unionByName(c.pairs.orderBy("s1_id", "t_id").limit(1)),
        "rank": c.pairs.withColumn("rank_addr", F.lit(40)), "key": c.pairs.withColumn("t_id", F.lit(None).cast("string")),
    }
    found = [(name, stages.candidate_faults(df, of) == "") for name, df in made.items()]
    return c.spark.createDataFrame(found, "case string, valid boolean")


def queries() -> dict[str, Query]:
    out = {
        "normalize_records": lambda c: c.records.withColumn("addr_nums", F.array_join("addr_nums", ",")),
        "name_frequency": lambda c: name_frequency(c.records),
        "script_profile": _scripts,
        "id_hash_folds": lambda c: c.records.select("entity_id", id_hash(F.col("entity_id")).alias("h0"), id_hash(F.col("entity_id"), 1).alias("h1"), fold(F.col("entity_id"), 5).alias("fold")),
        "bernoulli_sample": lambda c: c.records.where(sampled(F.col("entity_id"), 0.3, 3)).select("entity_id"),
        "seeded_sample": lambda c: c.records.orderBy(F.md5(F.concat("entity_id", F.lit(":0"))), "entity_id").limit(15).select("entity_id", "name_core"),
        "char_grams": _grams,
        "country_source_counts": lambda c: c.records.withColumn("source", F.lower(F.substring("entity_id", 1, 2))).groupBy("ckey").pivot("source", ["s1", "s2", "s3"]).count().na.fill(0),
        "match_histogram": _histogram,
        "shared_targets": lambda c: c.truth.distinct().groupBy("t_id").agg(F.count("*").alias("holders")).groupBy("holders").agg(F.count("*").alias("n")),
        "tfidf_postings": _postings,
        "document_frequency": _idf,
        "source_files": lambda c: files.sources(R.raw(c.spark, c.sf_dir)),
        "truth_files": lambda c: files.lists(c.ids, c.truth),
        "file_lines": lambda c: files.line_count(c.ids, c.truth),
        "dev_slice": lambda c: files.slice_of(c.records, c.truth),
        "tables_together": lambda c: files.together([c.targets.where("entity_id like 'S2-%'"), c.targets.where("entity_id like 'S3-%'")]).select("entity_id", "ckey", "name_core"),
        "candidate_union": lambda c: c.pairs,
        "query_range": lambda c: files.ranged(c.pairs.select("s1_id", "t_id", "cos_both"), "S1-1", "S1-2"),
        "candidate_faults": _faults,
        "candidate_report": _report,
        "feature_means": _means,
        "error_examples": lambda c: reports.examples(c.matched.join(c.truth, ["s1_id", "t_id"], "left_anti"), c.queries, c.targets),
        "pair_cosines": _cosines,
        "candidate_recall": lambda c: retrieval.recall(c.pairs, c.truth),
        "recall_by_channel": lambda c: retrieval.recall_by_channel(c.labeled.drop("label"), c.truth, tuple(CHANNELS)),
        "recall_by_cutoff": lambda c: retrieval.recall_by_cutoff(c.pairs, c.truth, "name", (5, 10, 20, 40)),
        "stage0_features": lambda c: features.stage0(c.pairs),
        "context_features": lambda c: features.context(c.pairs),
        "set_features": lambda c: features.sets_and_flags(c.pairs, c.queries, c.targets),
                "string_features": lambda c: _strings(c).drop("n_partial"),
        "partial_ratio": lambda c: _strings(c).select("s1_id", "t_id", "n_partial"),
        "stage2_context": lambda c: features.standing(c.scored).drop("q_p1_sum", "q_p1_share", "_top1", "_top2"),
        "stage2_siblings": _siblings,
        "prune_top": lambda c: learning.prune(c.scores.select("s1_id", "t_id", F.col("p").alias("score0")), 10),
        "stage0_model": lambda c: _pruned(c).select("s1_id", "t_id", "label", "score0"),
        "label_join": lambda c: c.labeled.select("s1_id", "t_id", "label"),
        "gbt_out_of_fold": _trained,
        "exclusive": lambda c: decision.exclusive(c.scores.drop("label")),
        "threshold": lambda c: decision.above(c.scores.drop("label"), 0.5),
        "expected_f": lambda c: decision.expected_f(decision.exclusive(c.scores.drop("label"))),
        "threshold_grid": _grid,
        "expected_f_grid": lambda c: _rounded(decision.expected_f_grid(c.ids, c.scores.drop("label"), c.truth)),
        "per_entity_f": lambda c: c.per_entity,
        "summary": lambda c: _rounded(decision.summary(c.per_entity)),
        "country_report": lambda c: _rounded(decision.report(c.per_entity.join(c.ids, "s1_id"))),
        "score_summary": lambda c: c.scores.groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg("p"), 9).alias("mean_p")),
        "calibration": lambda c: decision.calibration(c.scores).withColumns({"mean_p": F.round("mean_p", 9), "hit_rate": F.round("hit_rate", 9)}),
        "false_positives": lambda c: c.matched.join(c.truth, ["s1_id", "t_id"], "left_anti"),
        "false_negatives": lambda c: c.truth.distinct().join(c.matched, ["s1_id", "t_id"], "left_anti").join(c.scores.drop("label"), ["s1_id", "t_id"], "left"),
        "match_lists": lambda c: tables.id_lists(c.ids, c.matched),
        "candidate_lists": lambda c: tables.id_lists(c.ids, c.pairs, tables.CANDIDATES),
        "set_sizes": lambda c: c.per_entity.join(c.ids, "s1_id").groupBy("ckey").agg(F.avg((F.col("n_pred") == 0).cast("int")).alias("empty_rate"), F.avg("n_pred").alias("avg_matches")),
        "validate": _validated,
    }
    out |= {f"retrieve_{n}": lambda c, ch=ch: retrieval.search(ch, c.queries, c.targets) for n, ch in CHANNELS.items()}
    return {k: case(v) for k, v in out.items()} | {"null_profile": _profile}
