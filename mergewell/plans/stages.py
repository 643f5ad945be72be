"""The whole run as stages: each reads tables of the stages before it and writes its own.

A stage writes its tables through ``manifests.once``, so a run that starts again
goes on where the last one ended, and a table of other settings is made anew.
``<data>/<split>_source1.tsv`` to ``_source3.tsv`` are the inputs, and
``<data>/train_truth.tsv`` says which records of the first belong to which of the others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewell.functions.hashing import sampled
from mergewell.functions.normalize import normalize_records, with_name_frequency
from mergewell.operators import decision, features, learning, retrieval, validate
from mergewell.operators.vectors import Channel, dot_products, postings
from mergewell.plans import manifests, reports
from mergewell.plans.settings import DEPENDS, Settings, stage_hashes
from mergewell.sources import storage, tables

SPLITS, SOURCES = ("train", "test"), (1, 2, 3)
STAGES = tuple(DEPENDS)


class Run:
    """A session, its settings and the fingerprints of the stages; ``force`` names stages to run in any case."""

    def __init__(self, spark: SparkSession, settings: Settings, force: tuple[str, ...] = ()) -> None:
        if unknown := set(force) - {*STAGES, "all"}:
            raise ValueError(f"unknown stages {sorted(unknown)}")
        self.spark, self.settings, self.hashes = spark, settings, stage_hashes(settings)
        self.force = set(STAGES) if "all" in force else set(force)
        settings.configure(spark)

    def source(self, split: str, number: int) -> str:
        return f"{self.settings.data}/{split}_source{number}.tsv"

    def once(self, stage: str, name: str, make: Callable[[], DataFrame], by: tuple[str, ...] = (), partition: str | None = None) -> DataFrame:
        return manifests.once(self.spark, self.settings.path(stage, name), stage, self.hashes[stage], make, by, partition, force=stage in self.force)

    def table(self, stage: str, name: str) -> DataFrame:
        """A finished table; an error says which stage is missing."""
        path = self.settings.path(stage, name)
        if (found := manifests.state(self.spark, path, self.hashes[stage])) != "done":
            raise ValueError(f"{path} is {found}: run the stage {stage} first")
        return self.spark.read.parquet(path)

    def records(self, split: str) -> tuple[DataFrame, DataFrame]:
        """Queries and targets of a split; both targets' sources are one table."""
        rows = self.table("normalize", split)
        return rows.where("source = 1").drop("source"), rows.where("source > 1").drop("source")

    def truth(self) -> DataFrame:
        pairs = tables.read_truth(self.spark, f"{self.settings.data}/train_truth.tsv")
        queries, _ = self.records("train")
        return pairs.join(queries.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi")

    def ids(self, split: str) -> DataFrame:
        return self.records(split)[0].select(F.col("entity_id").alias("s1_id"), "ckey")


def sliced(sources: dict[int, DataFrame], truth: DataFrame | None, share: float, distractors: float) -> dict[int, DataFrame]:
    """A slice for development: a share of the queries, all their true targets, and a share of all other targets."""
    queries = sources[1].where(sampled(F.col("entity_id"), share, 1))
    out = {1: queries}
    for number, rows in sources.items():
        if number > 1:
            keep = rows.where(sampled(F.col("entity_id"), distractors, number))
            if truth is not None:
                mine = truth.join(queries.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi").select(F.col("t_id").alias("entity_id")).distinct()
                rest = rows.where(~F.coalesce(sampled(F.col("entity_id"), distractors, number), F.lit(False)))
                keep = keep.unionByName(rest.join(mine, "entity_id", "left_semi"))
            out[number] = keep
    return out


def normalize(run: Run) -> None:
    """Records of each split, with how many of the split share a name; one folder for each source."""
    s = run.settings
    for split in SPLITS:

        def make(split: str = split) -> DataFrame:
            raw = {n: tables.read_source(run.spark, run.source(split, n)) for n in SOURCES}
            if s.dev:
                truth = tables.read_truth(run.spark, f"{s.data}/train_truth.tsv") if split == "train" else None
                raw = sliced(raw, truth, s.dev_share, s.dev_distractors)
            rows = [normalize_records(df).withColumn("source", F.lit(n)) for n, df in raw.items()]
            return with_name_frequency(rows[0].unionByName(rows[1]).unionByName(rows[2]))

        run.once("normalize", split, make, partition="source")


def candidate_faults(pairs: DataFrame, of: tuple[Channel, ...]) -> str:
    """What is wrong with a table of candidates, or nothing: its columns, null or repeated keys, ranks out of range.

    A query without any candidate is no fault: all its terms may be too frequent.
    """
    expected = ["s1_id", "t_id", *(f"rank_{c.name}" for c in of), *(f"cos_{c.name}" for c in of)]
    if sorted(pairs.columns) != sorted(expected):
        return f"columns are {pairs.columns}, not {expected}"
    row = pairs.agg(
        F.count_if(F.isnull("s1_id") | F.isnull("t_id")).alias("null keys"),
        *(F.count_if(~F.col(f"rank_{c.name}").between(-1, c.top_k - 1) | F.isnull(f"rank_{c.name}")).alias(f"ranks of {c.name}") for c in of),
        F.count_if(F.greatest(*(F.col(f"rank_{c.name}") for c in of), F.lit(-1)) < 0).alias("pairs of no channel"),
    ).first()
    twice = pairs.groupBy("s1_id", "t_id").count().where("count > 1").limit(1).count()
    return "; ".join([f"{n}: {k}" for k, n in row.asDict().items() if n] + ["repeated pairs"] * twice)


def candidates(run: Run) -> None:
    """Postings, hits of all channels, and candidates with their cosines: three tables, so each phase is resumed by itself."""
    of = run.settings.channels
    for split in SPLITS:
        q, t = run.records(split)
        rows = run.once("candidates", f"{split}_postings", lambda q=q, t=t: postings(q, t, of))
        ranks = [F.coalesce(F.max(F.when(F.col("channel") == k, F.col("rank"))), F.lit(-1)).alias(f"rank_{c.name}") for k, c in enumerate(of)]
        hits = run.once("candidates", f"{split}_hits", lambda rows=rows: retrieval.top_k(rows, of).groupBy("s1_id", "t_id").agg(*ranks))
        pairs = run.once("candidates", split, lambda hits=hits, rows=rows: dot_products(hits, rows, of, retrieval.DECIMALS), by=("s1_id", "t_id"))
        if fault := candidate_faults(pairs, of):
            raise ValueError(f"candidates of {split}: {fault}")


def candidate_report(run: Run, which: str = "candidates", cutoffs: tuple[int, ...] = (10, 20, 40, 60)) -> DataFrame:
    return reports.candidate_report(run.table(which, "train"), run.truth(), run.ids("train"), tuple(c.name for c in run.settings.channels), cutoffs)


def prune(run: Run) -> None:
    """The best pairs of each query by a model of what retrieval tells, for both splits."""
    s, path = run.settings, run.settings.path("prune", "model")
    labeled = retrieval.labeled(run.table("candidates", "train"), run.truth())
    if "prune" in run.force or not all(manifests.valid(run.spark, run.settings.path("prune", x), run.hashes["prune"]) for x in SPLITS):
        model, columns = learning.train_stage0(labeled, s.stage0_share, s.rounds0, s.depth, s.seed)
        learning.save(run.spark, model, columns, path)
    columns = storage.read_json(run.spark, f"{path}/features.json")
    model = learning.load(run.spark, path, columns)
    for split in SPLITS:
        rows = features.stage0(run.table("candidates", split))
        run.once("prune", split, lambda rows=rows: learning.prune(learning.scored(model, rows, columns, "score0"), s.per_query), by=("s1_id", "t_id"))


def make_features(run: Run) -> None:
    """All features of the pruned pairs; those of the training split have labels."""
    for split in SPLITS:

        def make(split: str = split) -> DataFrame:
            rows = features.context(features.pair_features(run.table("prune", split), *run.records(split)))
            return retrieval.labeled(rows, run.truth()) if split == "train" else rows

        run.once("features", split, make, by=("s1_id", "t_id"))


def feature_report(run: Run) -> DataFrame:
    rows = run.table("features", "train")
    return reports.feature_report(rows, learning.feature_columns(rows))


def _cross_validated(run: Run, stage: str, frame: DataFrame, score: str) -> None:
    """Models by folds, saved, and the scores of pairs by the model that has not seen their query."""
    s, name = run.settings, "train"

    def make() -> DataFrame:
        columns = learning.feature_columns(frame)
        out, models = learning.out_of_fold(frame, columns, score, s.folds, s.train_share, salt=int(stage[-1]), rounds=s.rounds, depth=s.depth, seed=s.seed + int(stage[-1]))
        for k, m in enumerate(models):
            learning.save(run.spark, m, columns, run.settings.path(stage, f"model{k}"))
        weights = run.spark.createDataFrame(learning.importance(models, columns), "feature string, importance double")
        tables.write_report(weights, run.settings.path(stage, "importance.csv"))
        return out.select("s1_id", "t_id", "label", score)

    run.once(stage, name, make, by=("s1_id", "t_id"))


def _averaged(run: Run, stage: str, frame: DataFrame, score: str) -> DataFrame:
    columns = learning.feature_columns(frame)
    models = [learning.load(run.spark, run.settings.path(stage, f"model{k}"), columns) for k in range(run.settings.folds)]
    return learning.averaged(models, frame, columns, score)


def stage1(run: Run) -> None:
    _cross_validated(run, "stage1", run.table("features", "train"), "p1")


def second_frame(rows: DataFrame, scores: DataFrame, targets: DataFrame) -> DataFrame:
    """Features of the first stage with its scores and what they say of a pair's competitors."""
    scores = scores.select("s1_id", "t_id", "p1")
    return rows.join(features.stage2(scores, targets), ["s1_id", "t_id"])


def stage2(run: Run) -> None:
    frame = run.once("stage2", "frame", lambda: second_frame(run.table("features", "train"), run.table("stage1", "train"), run.records("train")[1]), by=("s1_id", "t_id"))
    _cross_validated(run, "stage2", frame, "p")


def score_summary(run: Run) -> DataFrame:
    """``stage, label, n, mean``; a stage without a score of the other has null there."""
    each = [run.table(s, "train").groupBy("label").agg(F.count("*").alias("n"), F.avg(p).alias(f"mean_{p}")).withColumn("stage", F.lit(s)) for s, p in (("stage1", "p1"), ("stage2", "p"))]
    return each[0].unionByName(each[1], allowMissingColumns=True)


def decide(run: Run) -> None:
    """The best rule on the scores of the training split, frozen as JSON, and reports of it."""
    path = run.settings.path("decision", "rule.json")
    pred, ids, truth = run.table("stage2", "train").where(F.col("p") >= run.settings.least_p).select("s1_id", "t_id", "p"), run.ids("train"), run.truth()
    rule, grid = decision.best_rule(ids, pred, truth)
    tables.write_report(grid, run.settings.path("decision", "grid.csv"))
    each = decision.per_entity(ids, decision.decide(pred, rule), truth)
    tables.write_report(decision.report(each.join(ids, "s1_id")), run.settings.path("decision", "report.csv"))
    storage.write_json(run.spark, path, rule | {"config": run.hashes["decision"]})


def frozen_rule(run: Run) -> dict:
    rule = storage.read_json(run.spark, run.settings.path("decision", "rule.json"))
    if not isinstance(rule, dict) or rule.get("config") != run.hashes["decision"]:
        raise ValueError("no rule of these settings: run the stage decision first")
    return rule


def predict(run: Run) -> None:
    """Scores of the test split by the mean of the models of all folds."""

    def make() -> DataFrame:
        rows = run.table("features", "test")
        first = run.once("predict", "first", lambda: _averaged(run, "stage1", rows, "p1").select("s1_id", "t_id", "p1"))
        frame = second_frame(rows, first, run.records("test")[1])
        return _averaged(run, "stage2", frame, "p").select("s1_id", "t_id", "p")

    run.once("predict", "test", make, by=("s1_id", "t_id"))


def submit(run: Run) -> dict:
    """Both lists as files, checked rule by rule, and a zip of them; returns what is worth knowing of them."""
    s = run.settings
    ids, pairs, pred = run.ids("test"), run.table("prune", "test"), run.table("predict", "test")
    if (a := pred.count()) != (b := pairs.count()):
        raise ValueError(f"{a} scores for {b} candidates")
    rule = frozen_rule(run)
    matched = decision.decide(pred.where(F.col("p") >= s.least_p), rule).select("s1_id", "t_id")
    matches, lists = tables.id_lists(ids, matched), tables.id_lists(ids, pairs, tables.CANDIDATES)
    known = run.records("test")[1].select(F.col("entity_id").alias("t_id"))
    warnings = validate.require_valid(validate.problems(matches, lists, ids, known))
    tables.write_tsv(matches, s.path("submit", "matches"))
    tables.write_tsv(lists, s.path("submit", "candidates"))
    for name, header in (("matches", tables.TRUTH), ("candidates", tables.CANDIDATES)):
        if broken := validate.file_problems(run.spark, s.path("submit", name), header).where("n > 0").collect():
            raise ValueError(f"{name}: {[(r.rule, r.n) for r in broken]}")
    storage.pack_files(run.spark, {"rule.json": s.path("decision", "rule.json")}, s.path("submit", "rule.zip"))
    shared = matched.groupBy("t_id").count().where("count > 1").count()
    stats = {"entities": ids.count(), "pairs": matched.count(), "candidates": b, "targets of several": shared, "warnings": warnings, "config": run.hashes["submit"]}
    storage.write_json(run.spark, s.path("submit", "stats.json"), stats)
    return stats


WORK: dict[str, Callable[[Run], object]] = {
    "normalize": normalize, "candidates": candidates, "prune": prune, "features": make_features, "stage1": stage1, "stage2": stage2, "decision": decide, "predict": predict, "submit": submit,
}
#: The tables by which a stage is known to be done; JSON files stand for the others.
TABLES = {
    "normalize": SPLITS, "candidates": SPLITS, "prune": SPLITS, "features": SPLITS, "stage1": ("train",), "stage2": ("train",), "decision": ("rule.json",), "predict": ("test",), "submit": ("stats.json",),
}


def stage_range(start: str | None = None, end: str | None = None) -> list[str]:
    """Stages from ``start`` to ``end``, both by name or number from 1; all without them."""

    def at(x: str | None, otherwise: int) -> int:
        if x is None:
            return otherwise
        if x.isdigit() and 1 <= int(x) <= len(STAGES):
            return int(x) - 1
        if x not in STAGES:
            raise ValueError(f"unknown stage {x}, known are {', '.join(STAGES)}")
        return STAGES.index(x)

    first, last = at(start, 0), at(end, len(STAGES) - 1)
    if first > last:
        raise ValueError(f"{STAGES[first]} comes after {STAGES[last]}")
    return list(STAGES[first : last + 1])


def run_stage(run: Run, stage: str) -> object:
    with storage.timed(f"stage {stage}"):
        return WORK[stage](run)


def run_all(run: Run, start: str | None = None, end: str | None = None) -> object:
    """Stages in order; the first that fails ends the run, and says how to go on."""
    out = None
    for stage in stage_range(start, end):
        try:
            out = run_stage(run, stage)
        except Exception:
            storage.log.error("go on with: run --from %s", stage)
            raise
    return out


def status(run: Run) -> dict[str, dict[str, str]]:
    """For each stage and table: done, stale, partial, unknown or missing."""
    out: dict[str, dict[str, str]] = {}
    for stage, names in TABLES.items():
        out[stage] = {}
        for name in names:
            path = run.settings.path(stage, name)
            if name.endswith(".json"):
                found = storage.read_json(run.spark, path)
                out[stage][name] = "missing" if found is None else "done" if found.get("config") == run.hashes[stage] else "stale"
            else:
                out[stage][name] = manifests.state(run.spark, path, run.hashes[stage])
    return out
