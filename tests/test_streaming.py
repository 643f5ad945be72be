"""Candidates of arriving records do not depend on how they arrive."""

from dataclasses import replace

from mergewell.functions.normalize import normalize_records
from mergewell.operators import retrieval, vectors
from mergewell.streaming.incremental import match_stream
from tests.test_retrieval import RAW, TOY, TOYS


def test_batches_change_nothing(spark, tmp_path):
    rows = spark.createDataFrame(TOYS, RAW)
    queries, arrivals = rows.where("entity_id like 'S1-%'"), rows.where("entity_id not like 'S1-%'")
    known = normalize_records(arrivals)
    of = tuple(replace(c, top_k=10) for c in TOY)
    want = sorted((r.s1_id, r.t_id, r.cos_both) for r in retrieval.candidates(normalize_records(queries), known, of).collect() if r.cos_both > 0.05)
    found = {}
    for name, files in (("one", 1), ("many", 4)):
        arrivals.repartition(files).write.json(f"{tmp_path}/{name}")
        stream = spark.readStream.schema(arrivals.schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/{name}")
        match_stream(stream, normalize_records(queries), known, of, f"{tmp_path}/{name}-out", f"{tmp_path}/{name}-state").awaitTermination()
        out = spark.read.parquet(f"{tmp_path}/{name}-out")
        found[name] = sorted((r.s1_id, r.t_id, r.cos_both) for r in out.collect() if r.cos_both > 0.05)
    assert found["one"] == found["many"] == want


def test_weights_of_a_collection(spark):
    rows = normalize_records(spark.createDataFrame(TOYS, RAW))
    q, t = rows.where("entity_id like 'S1-%'"), rows.where("entity_id not like 'S1-%'")
    whole = {(r.entity_id, r.is_target, r.channel, r.block, r.term): r.w for r in vectors.postings(q, t, TOY).collect()}
    part = vectors.postings(q, t.where("entity_id = 'S2-2'"), TOY, corpus=t).collect()
    assert part and all(abs(whole[r.entity_id, r.is_target, r.channel, r.block, r.term] - r.w) < 1e-12 for r in part)
