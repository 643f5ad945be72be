"""A whole run over small files: resumed, forced, with other settings, and its command line."""

import json
import random

import pytest
from pyspark.sql import functions as F

from mergewell.__main__ import main
from mergewell.operators import learning
from mergewell.plans import manifests, stages
from mergewell.plans.settings import Settings
from mergewell.sources import storage, tables

WORDS = "blue green river hill trust mill star north south lake stone wood iron gold silver field garden bridge tower harbor".split()
SMALL = {"folds": 2, "rounds": 3, "rounds0": 3, "depth": 3, "stage0_share": 1.0, "per_query": 8, "top_k": "addr=6,both=6"}


def files(folder, seed, n=60):
    rng = random.Random(seed)
    rows, truth = {1: [], 2: [], 3: []}, []
    for k in range(n):
        name, street, land = " ".join(rng.sample(WORDS, 3)), f"{rng.randint(1, 99)} {rng.choice(WORDS)} street", rng.choice(["US", "India", "Peru"])
        rows[1].append((f"S1-{k}", name, f"{street}, Town", land))
        found = []
        for j in (2, 3):
            if rng.random() < 0.7:
                rows[j].append((f"S{j}-{k}", f"{name} llc" if rng.random() < 0.5 else name.upper(), "" if rng.random() < 0.1 else street, land))
                found.append(f"S{j}-{k}")
        truth.append((f"S1-{k}", ",".join(found)))
    for j in (2, 3):
        rows[j] += [(f"S{j}-{1000 + k}", " ".join(rng.sample(WORDS, 2)), f"{k} other road", "US") for k in range(20)]
    return rows, truth


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    folder = tmp_path_factory.mktemp("data")
    for split, seed in (("train", 1), ("test", 2)):
        rows, truth = files(folder, seed)
        for j, lines in rows.items():
            (folder / f"{split}_source{j}.tsv").write_text("\t".join(tables.SOURCE) + "\n" + "".join("\t".join(x) + "\n" for x in lines))
        if split == "train":
            (folder / "train_truth.tsv").write_text("\t".join(tables.TRUTH) + "\n" + "".join("\t".join(x) + "\n" for x in truth))
    return folder


@pytest.fixture(scope="module")
def done(spark, base):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    run = stages.Run(spark, Settings.of({}, data=str(base), work=f"{base}/work", shuffle_partitions=4, **SMALL))
    assert {x for names in stages.status(run).values() for x in names.values()} == {"missing"}
    stats = stages.run_all(run)
    yield run, stats
    for k, v in before.items():
        spark.conf.set(k, v)


def test_whole_run(done, spark):
    run, stats = done
    assert stats["entities"] == 60 and stats["pairs"] > 30 and stats["candidates"] >= stats["pairs"] and stats["warnings"] == []
    assert {x for names in stages.status(run).values() for x in names.values()} == {"done"}
    matches = tables.read_truth(spark, run.settings.path("submit", "matches"))
    right = matches.where(F.regexp_extract("s1_id", r"(\d+)$", 1) == F.regexp_extract("t_id", r"(\d+)$", 1)).count()
    assert right > 0.7 * matches.count()
    rule = stages.frozen_rule(run)
    assert rule["macro_f"] > 0.6 and rule["method"] in ("threshold", "expected_f")


def test_reports(done, spark):
    run, _ = done
    report = {(r.ckey, r.what): r for r in stages.candidate_report(run).collect()}
    assert report["us", "union"].recall > 0.8 and report["us", "union"].candidates >= report["us", "addr"].candidates
    pruned = {(r.ckey, r.what): r for r in stages.candidate_report(run, "prune", (1, 60)).collect()}
    assert pruned["us", "top 1"].hits <= pruned["us", "top 60"].hits == pruned["us", "union"].hits
    shares = {r.label: r.share for r in stages.feature_report(run).collect()}
    assert abs(sum(shares.values()) - 1) < 1e-9 and set(shares) == {0, 1}
    means = {(r.stage, r.label): (r.mean_p1, r.mean_p) for r in stages.score_summary(run).collect()}
    assert means["stage1", 1][0] > means["stage1", 0][0] and means["stage2", 0][0] is None and means["stage2", 1][1] > means["stage2", 0][1]
    assert spark.read.csv(run.settings.path("decision", "grid.csv"), header=True).count() == 59


def test_resume_and_force(done, spark):
    run, _ = done
    made = lambda stage, name: manifests.read(spark, run.settings.path(stage, name))["written"]
    before = made("candidates", "train"), made("candidates", "train_hits")
    stages.run_stage(run, "candidates")
    assert (made("candidates", "train"), made("candidates", "train_hits")) == before
    manifests.invalidate(spark, run.settings.path("candidates", "train"))
    assert stages.status(run)["candidates"] == {"train": "unknown", "test": "done"}
    stages.run_stage(run, "candidates")
    assert made("candidates", "train") > before[0] and made("candidates", "train_hits") == before[1]
    stages.run_stage(stages.Run(spark, run.settings, force=("normalize",)), "normalize")
    with pytest.raises(ValueError, match="unknown stages"):
        stages.Run(spark, run.settings, force=("none",))


def test_other_settings(done, spark):
    run, _ = done
    other = stages.Run(spark, Settings.of({}, data=run.settings.data, work=run.settings.work, shuffle_partitions=4, **(SMALL | {"folds": 3})))
    found = stages.status(other)
    assert found["features"] == {"train": "done", "test": "done"} and found["stage1"] == {"train": "stale"} and found["decision"] == {"rule.json": "stale"}
    with pytest.raises(ValueError, match="run the stage stage1 first"):
        stages.run_stage(other, "stage2")
    with pytest.raises(ValueError, match="decision first"):
        stages.frozen_rule(other)


def test_faults(done):
    run, _ = done
    of, pairs = run.settings.channels, run.table("candidates", "train")
    assert stages.candidate_faults(pairs, of) == ""
    assert "columns" in stages.candidate_faults(pairs.drop("cos_addr"), of)
    assert "repeated pairs" in stages.candidate_faults(pairs.unionByName(pairs.limit(1)), of)
    assert "ranks of addr" in stages.candidate_faults(pairs.withColumn("rank_addr", F.lit(6)), of)
    assert "null keys" in stages.candidate_faults(pairs.withColumn("t_id", F.lit(None).cast("string")), of)


def test_models(done, spark):
    run, _ = done
    path = run.settings.path("stage1", "model0")
    columns = storage.read_json(spark, f"{path}/features.json")
    assert learning.load(spark, path, columns).getNumTrees >= 1
    with pytest.raises(ValueError, match="the model has"):
        learning.load(spark, path, columns[::-1])


def test_slice(spark):
    ids = lambda s, n: spark.range(n).select(F.concat(F.lit(f"S{s}-"), "id").alias("entity_id"))
    truth = spark.range(500).select(F.concat(F.lit("S1-"), "id").alias("s1_id"), F.concat(F.lit("S2-"), "id").alias("t_id"))
    out = stages.sliced({1: ids(1, 500), 2: ids(2, 2000), 3: ids(3, 2000)}, truth, 0.1, 0.1)
    queries = {r[0][3:] for r in out[1].collect()}
    targets = [r[0][3:] for r in out[2].collect()]
    assert 25 < len(queries) < 90 and queries <= set(targets) and len(targets) == len(set(targets)) and 120 < len(targets) - len(queries) < 300
    assert 120 < out[3].count() < 300 and 120 < stages.sliced({1: ids(1, 500), 2: ids(2, 2000)}, None, 0.1, 0.1)[2].count() < 300


def test_ranges():
    assert stages.stage_range() == list(stages.STAGES) and stages.stage_range("prune", "4") == ["prune", "features"]
    for bad in (("none", None), ("0", None), ("features", "prune"), (None, "99")):
        with pytest.raises(ValueError, match="unknown stage|comes after"):
            stages.stage_range(*bad)


def test_command_line(done, capsys):
    run, _ = done
    assert main(["stages"]) == 0 and capsys.readouterr().out.startswith("1 normalize")
    given = [f"--set=data={run.settings.data}", f"--set=work={run.settings.work}", "--set=shuffle_partitions=4", *(f"--set={k}={v}" for k, v in SMALL.items())]
    assert main(["status", *given]) == 0 and json.loads(capsys.readouterr().out)["submit"] == {"stats.json": "done"}
    assert main(["stage", "normalize", *given]) == 0
    assert main(["status", *given, "--set=dev=true"]) == 1
