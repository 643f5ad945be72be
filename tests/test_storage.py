"""Readers and writers, manifests and settings."""

import json
import zipfile

import pytest

from mergewell.operators import validate
from mergewell.plans import manifests
from mergewell.plans.settings import Settings, fingerprint, safe_name, stage_hashes
from mergewell.sources import storage, tables


def source(tmp_path, text, name="s.tsv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


def test_tsv(spark, tmp_path):
    path = source(tmp_path, "extra\t" + HEAD + 'x\tS1-1\t"Quoted\t\tUS\nx\tS1-2\tname\taddr\t\n')
    df = tables.read_source(spark, path)
    assert df.columns == list(tables.SOURCE) and [tuple(r) for r in df.orderBy("entity_id").collect()] == [("S1-1", '"Quoted', None, "US"), ("S1-2", "name", "addr", None)]
    assert tables.read_source(spark, path, 1).count() == 1 and tables.tsv_rows(spark, path) == 2


def test_tsv_faults(spark, tmp_path):
    with pytest.raises(ValueError, match="missing columns"):
        tables.read_source(spark, source(tmp_path, "entity_id\tname\nS1-1\tx\n"))
    with pytest.raises(ValueError, match="repeat"):
        tables.read_source(spark, source(tmp_path, HEAD + "S1-1\ta\tb\tc\nS1-1\ta\tb\tc\n"))
    with pytest.raises(ValueError, match="without"):
        tables.read_source(spark, source(tmp_path, HEAD + "\ta\tb\tc\n"))


def test_truth(spark, tmp_path):
    path = source(tmp_path, "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-1,S2-1,\nS1-2\t\n")
    assert sorted(map(tuple, tables.read_truth(spark, path).collect())) == [("S1-1", "S2-1"), ("S1-1", "S3-1")]


def test_id_lists(spark, tmp_path):
    ids = spark.createDataFrame([("S1-2",), ("S1-1",)], "s1_id string")
    pairs = spark.createDataFrame([("S1-1", "S3-1"), ("S1-1", "S2-9"), ("S1-1", "S3-1")], "s1_id string, t_id string")
    lists = tables.id_lists(ids, pairs)
    assert sorted(map(tuple, lists.collect())) == [("S1-1", "S2-9,S3-1"), ("S1-2", "")]
    path = str(tmp_path / "out")
    tables.write_tsv(lists, path)
    assert sorted(spark.read.text(path).toPandas()["value"]) == ["S1-1\tS2-9,S3-1", "S1-2\t", "source1_entity_id\tmatched_entity_ids"]
    assert {r.rule: r.n for r in validate.file_problems(spark, path, tables.TRUTH).collect()} == {"no such header": 0, "commas for tabs": 0, "line without one tab": 0}
    assert sorted(map(tuple, tables.read_truth(spark, path).collect())) == [("S1-1", "S2-9"), ("S1-1", "S3-1")]


def test_file_problems(spark, tmp_path):
    path = source(tmp_path, "Source1_Entity_ID,matched_entity_ids\nS1-1\tx\ty\nS1-2\n")
    assert {r.rule: r.n for r in validate.file_problems(spark, path, tables.TRUTH).collect()} == {"no such header": 1, "commas for tabs": 1, "line without one tab": 3}


def test_validation(spark):
    lists = lambda rows: spark.createDataFrame(rows, "source1_entity_id string, ids string")
    required, known = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "s1_id string"), spark.createDataFrame([("S2-1",), ("S2-12",)], "t_id string")
    good = lists([("S1-1", "S2-1, S2-12"), ("S1-2", ""), ("S1-3", None)])
    found = validate.problems(good, good, required, known)
    assert validate.valid(found) and found.count() == 15 and found.where("n > 0").count() == 0 and validate.require_valid(found) == []
    bad = lists([("S1-1", "S2-1,S2-1"), ("S1-1", "S1-2"), ("S1-9", "X-1,S2-7")])
    counts = {r.rule: r.n for r in validate.problems(bad, good, required, known).where("file = 'matches'").collect()}
    assert counts == {"repeated id in a list": 1, "match with source 1": 1, "wrong prefix": 1, "repeated source 1 id": 1, "missing source 1 id": 2, "unexpected source 1 id": 1, "unknown id": 3, "match is no candidate": 3}
    with pytest.raises(ValueError, match="wrong prefix"):
        validate.require_valid(validate.problems(bad, good, required, known))
    none = lists([])
    assert validate.valid(validate.problems(none, none, required.limit(0), known)) and not validate.valid(validate.problems(none, none, required))


def test_tables(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = storage.write_table(spark.createDataFrame([("b", "y", 1), ("a", "x", 2), ("a", "w", 3)], "s1_id string, t_id string, n int"), path, by=("s1_id", "t_id"))
    assert df.count() == 3 and storage.described(spark, path) == {"rows": 3, "columns": {"s1_id": "string", "t_id": "string", "n": "int"}}
    ranged = storage.read_range(spark, path, "a", "b")
    assert ranged.count() == 2 and "PushedFilters" in ranged._jdf.queryExecution().executedPlan().toString()
    storage.write_table(df.where("n > 1").selectExpr("s1_id", "t_id", "n").sparkSession.createDataFrame([("c", "z", 9)], df.schema), path)
    assert [r.n for r in spark.read.parquet(path).collect()] == [9]
    assert storage.write_parts([df.sparkSession.read.parquet(path)] * 2, f"{tmp_path}/u") == 2
    storage.write_table(spark.createDataFrame([("a", "us"), ("b", "in")], "s1_id string, ckey string"), f"{tmp_path}/p", partition="ckey")
    assert any(f.startswith("ckey=us/") for f in storage.sizes(spark, f"{tmp_path}/p"))
    assert not [p for p in tmp_path.iterdir() if ".tmp" in p.name]


def test_files(spark, tmp_path):
    path = f"{tmp_path}/deep/x.json"
    assert storage.read_json(spark, path) is None
    storage.write_json(spark, path, {"b": 1, "a": [None, "é"]})
    assert storage.read_json(spark, path) == {"a": [None, "é"], "b": 1}
    storage.write_bytes(spark, path, b"{")
    assert storage.read_json(spark, path) is None and storage.delete(spark, path) and not storage.exists(spark, path)
    storage.write_bytes(spark, path, b"text")
    spark.createDataFrame([("line",)], "v string").coalesce(1).write.text(f"{tmp_path}/lines")
    storage.pack_files(spark, {"x": path, "lines.txt": f"{tmp_path}/lines"}, f"{tmp_path}/all.zip")
    with zipfile.ZipFile(f"{tmp_path}/all.zip") as z:
        assert z.read("x") == b"text" and z.read("lines.txt") == b"line\n"
    with pytest.raises(OSError, match="free"):
        storage.require_space(spark, f"{tmp_path}/none/here", 1 << 60)
    storage.require_space(spark, f"{tmp_path}/none/here", 1)


def test_log(tmp_path):
    path = str(tmp_path / "run.log")
    storage.log_to(path)
    with storage.timed("work"):
        pass
    with pytest.raises(KeyError), storage.timed("fault"):
        raise KeyError("x")
    text = (tmp_path / "run.log").read_text()
    assert "work took" in text and "fault failed" in text


def test_manifests(spark, tmp_path):
    target = f"{tmp_path}/t"
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    assert manifests.state(spark, target, "c1") == "missing"
    for _ in range(2):
        assert manifests.once(spark, target, "s", "c1", make).count() == 3
    assert len(made) == 1 and manifests.state(spark, target, "c1") == "done" and manifests.state(spark, target, "c2") == "stale"
    manifests.once(spark, target, "s", "c2", make)
    assert len(made) == 2 and manifests.valid(spark, target, "c2")
    manifests.once(spark, target, "s", "c2", make, force=True)
    assert len(made) == 3
    next((tmp_path / "t").glob("part-*")).unlink()
    assert manifests.state(spark, target, "c2") == "partial"
    assert manifests.once(spark, target, "s", "c2", make).count() == 3
    assert manifests.invalidate(spark, target) and manifests.state(spark, target, "c2") == "unknown" and not manifests.invalidate(spark, target)
    assert not manifests.adopt(spark, target, "s", "c2", lambda df: "bad") and manifests.adopt(spark, target, "s", "c2", lambda df: "")
    assert manifests.read(spark, target)["adopted"] and manifests.valid(spark, target, "c2")
    storage.write_bytes(spark, f"{target}.manifest.json", b"broken")
    assert manifests.state(spark, target, "c2") == "unknown"
    manifests.reset(spark, target)
    assert manifests.state(spark, target, "c2") == "missing"


def test_pinned_parts(spark, tmp_path):
    folder = f"{tmp_path}/parts"
    assert manifests.pinned(spark, folder, "c1", lambda: [[0, 5], [5, 9]]) == [[0, 5], [5, 9]]
    storage.write_bytes(spark, f"{folder}/part-0", b"x")
    assert manifests.pinned(spark, folder, "c1", lambda: [[0, 9]]) == [[0, 5], [5, 9]] and storage.exists(spark, f"{folder}/part-0")
    assert manifests.pinned(spark, folder, "c2", lambda: [[0, 9]]) == [[0, 9]] and not storage.exists(spark, f"{folder}/part-0")


def test_settings(spark):
    env = {"MERGEWELL_FOLDS": "3", "MERGEWELL_DEV": "true", "MERGEWELL_PROFILE": "16gb", "OTHER": "x"}
    s = Settings.of(env, work="w", per_query=7)
    assert (s.folds, s.dev, s.per_query, s.root, s.arrow_rows, s.path("a", "b")) == (3, True, 7, "w/dev", 5000, "w/dev/a/b")
    assert {c.name: c.top_k for c in Settings.of({}, top_k="addr=5").channels}["addr"] == 5
    for bad in ({"nothing": 1}, {"profile": "1gb"}):
        with pytest.raises(ValueError, match="unknown"):
            Settings.of({}, **bad)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert Settings.of({}, profile="64gb").configure(spark) == 2 * spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hashes():
    assert fingerprint({"b": 1, "a": 2}) == fingerprint(json.loads('{"a": 2, "b": 1}')) and len(fingerprint([])) == 16
    base = stage_hashes(Settings.of({}))
    assert stage_hashes(Settings.of({}, profile="64gb", shuffle_partitions=9, data="x", work="y")) == base
    fewer = stage_hashes(Settings.of({}, folds=3))
    assert [s for s in base if base[s] != fewer[s]] == ["stage1", "stage2", "decision", "predict", "submit"]
    other = stage_hashes(Settings.of({}, top_k="name=3"))
    assert other["normalize"] == base["normalize"] and other["candidates"] != base["candidates"] and other["submit"] != base["submit"]
    assert safe_name("Côte d'Ivoire / x") == "C_te_d_Ivoire_x" and safe_name("") == safe_name("..") == "none"
