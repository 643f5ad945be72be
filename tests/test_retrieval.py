"""Retrieval against a direct computation, and the size of its plan."""

import math
import random
from collections import Counter, defaultdict

import pytest

from mergewell.functions.normalize import normalize_records, with_name_frequency
from mergewell.operators import retrieval, vectors
from mergewell.operators.vectors import Channel, Field

RAW = "entity_id string, business_name string, business_address string, country string"
TOYS = [
    ("S1-1", "Patterson Chadwick Corp", "1673 218th Avenue, Buckeye, AZ", "US"),
    ("S1-2", "Booker Urban Inc", "153 Honeywood Court, Aberdeen, NC", "US"),
    ("S1-3", "Design Academy", "Plot No 201 Mithila Nagar, Hyderabad, Telangana", "US"),
    ("S2-1", "PATTERSON CHADWICK (CORP)", "001673 218RD AVENUE, BUCKEYE, AZ", "US"),
    ("S3-1", "Patterson Corp (Chadwick)", "218rd Avenue, Buckeye, Arizona", "US"),
    ("S2-2", "INC BOOKER URNA", "153 HONEYWOOD CT, ABERDEEN, NC", "US"),
    ("S3-2", "Booker Urban", "", "US"),
    ("S2-3", "Design Service", "PLOT NO 201 MITHILA NAGAR, HYDERABAD, TG", "US"),
    ("S2-9", "Golden Foods", "12 Main Street, Springfield, IL", "US"),
]
TRUE = {("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-2", "S2-2"), ("S1-2", "S3-2"), ("S1-3", "S2-3")}
NAME, ADDR = Field("name_core"), Field("addr_norm")
TOY = (
    Channel("name", (Field("name_core", "char"),), 3, 1.0), Channel("addr", (ADDR,), 3, 1.0),
    Channel("both", (Field("name_core", weight=0.5), Field("addr_norm", weight=0.5)), 3, 1.0),
    Channel("cross", (Field("name_core", "cross", other="addr_norm"),), 3, 1.0), Channel("noaddr", (NAME,), 3, 1.0, pool="no_addr"),
)


def halves(spark, rows):
    done = with_name_frequency(normalize_records(spark.createDataFrame(rows, RAW)))
    return done.where("entity_id like 'S1-%'"), done.where("entity_id not like 'S1-%'")


def terms_of(field, row):
    words = [w for w in getattr(row, field.column).split(" ") if w]
    if field.kind == "word":
        return words
    if field.kind == "char":
        return [f"<{w}>"[k : k + field.n] for w in words for k in range(max(1, len(w) + 3 - field.n))]
    left = [w for w in words if len(w) > 1 and w[0].isalpha()]
    return [f"{a}|{b}" for a in left for b in getattr(row, field.other).split(" ") if b]


def direct(channel, queries, targets):
    """All cosines and the hits of a channel, pair by pair."""
    searchable = [t for t in targets if channel.pool is None or (channel.pool == "no_addr" and not t.has_addr) or (channel.pool == "translit" and t.translit)]
    sizes, df = Counter(t.ckey for t in searchable), Counter()
    for t in searchable:
        df.update({(t.ckey, k, w) for k, f in enumerate(channel.fields) for w in terms_of(f, t)})

    def vector(row):
        out = {}
        for k, f in enumerate(channel.fields):
            n = sizes[row.ckey]
            block = {}
            for w, tf in Counter(terms_of(f, row)).items():
                d = df[row.ckey, k, w]
                if 0 < d <= max(50, int(channel.max_df_frac * n)):
                    block[k, w] = (1 + math.log(tf)) * (math.log((1 + n) / (1 + d)) + 1)
            norm = math.sqrt(sum(x * x for x in block.values()))
            out |= {key: x / norm * math.sqrt(f.weight) for key, x in block.items()}
        norm = math.sqrt(sum(x * x for x in out.values())) or 1
        return {key: x / norm for key, x in out.items()}

    of = {id(r): vector(r) for r in [*queries, *targets]}
    cos = {(q.entity_id, t.entity_id): round(sum(x * of[id(t)].get(k, 0) for k, x in of[id(q)].items()), 6) if q.ckey == t.ckey else 0.0 for q in queries for t in targets}
    hits = {}
    for q in queries:
        best = sorted(((-cos[q.entity_id, t.entity_id], t.entity_id) for t in searchable if t.ckey == q.ckey and cos[q.entity_id, t.entity_id] > channel.min_score))
        hits |= {(q.entity_id, t): n for n, (_, t) in enumerate(best[: channel.top_k])}
    return cos, hits


@pytest.fixture(scope="module")
def made():
    """Records with few words, empty addresses, repeated names and another script; ties are common."""
    rng = random.Random(5)
    names = ["blue river", "green hill trust", "blue hill", "river trust", "old mill", "mill river", "north star", "star trust"]
    native = ["नदी", "पहाड़ी", ""]
    rows = []
    for k in range(120):
        side = "S1" if k < 40 else rng.choice(["S2", "S3"])
        name = rng.choice(names) + rng.choice(["", " llc", f" {rng.choice(native)}"])
        addr = "" if rng.random() < 0.1 else f"{rng.randint(1, 20)} {rng.choice(['oak', 'elm', 'main'])} street, town, AZ"
        rows.append((f"{side}-{k}", name, addr, rng.choice(["US", "US", "India"])))
    return rows


@pytest.mark.parametrize("of", [TOY, retrieval.channels()], ids=["toy", "standard"])
def test_candidates(spark, made, of):
    q, t = halves(spark, made)
    got = {(r.s1_id, r.t_id): r for r in retrieval.candidates(q, t, of).collect()}
    queries, targets = q.collect(), t.collect()
    expected = {c.name: direct(c, queries, targets) for c in of}
    assert set(got) == {p for _, hits in expected.values() for p in hits}
    for pair, row in got.items():
        for c in of:
            cos, hits = expected[c.name]
            assert abs(row[f"cos_{c.name}"] - cos[pair]) < 2e-6, (pair, c.name)
            assert row[f"rank_{c.name}"] == hits.get(pair, -1), (pair, c.name)


def test_split_terms_change_nothing(spark, made, monkeypatch):
    q, t = halves(spark, made)
    of = retrieval.channels()
    whole = sorted(map(tuple, retrieval.candidates(q, t, of).collect()))
    monkeypatch.setattr(vectors, "SPLIT", 3)
    assert vectors.postings(q, t, of).agg({"splits": "max"}).first()[0] > 3
    assert sorted(map(tuple, retrieval.candidates(q, t, of).collect())) == whole


def test_document_frequency_cut(spark):
    rows = [("S1-0", "common rare", "", "US")] + [(f"S2-{k}", "common" + (" rare" if k < 3 else f" own{k}"), "", "US") for k in range(60)]
    q, t = halves(spark, rows)
    cut, kept = (retrieval.search(Channel("name", (NAME,), 100, share), q, t).count() for share in (0.5, 1.0))
    assert (cut, kept) == (3, 60)  # a term of over 50 targets and of over half of them joins nothing


def test_toys(spark):
    q, t = halves(spark, TOYS)
    pairs = retrieval.candidates(q, t, TOY)
    rows = pairs.collect()
    assert {(r.s1_id, r.t_id) for r in rows} >= TRUE
    assert {r.t_id for r in rows if r.rank_noaddr >= 0} == {"S3-2"}
    assert all(-1e-5 <= r[c] <= 1 + 1e-5 for r in rows for c in pairs.columns if c.startswith("cos_"))
    truth = spark.createDataFrame(sorted(TRUE), "s1_id string, t_id string")
    assert retrieval.recall(pairs, truth).first().recall == 1.0
    by = {r.channel: r.hits for r in retrieval.recall_by_channel(pairs, truth, tuple(c.name for c in TOY)).collect()}
    assert by["union"] == 5 and by["noaddr"] == 1


def test_nothing_to_find(spark):
    q, t = halves(spark, TOYS)
    for a, b in ((q, t.limit(0)), (q.limit(0), t), (q.limit(0), t.limit(0))):
        pairs = retrieval.candidates(a, b, TOY)
        assert pairs.count() == 0 and len(pairs.columns) == 2 + 2 * len(TOY)
    empty = retrieval.recall(retrieval.candidates(q.limit(0), t, TOY), spark.createDataFrame([], "s1_id string, t_id string")).first()
    assert (empty.true_pairs, empty.hits, empty.candidates, empty.recall) == (0, 0, 0, None)


def test_ids_on_both_sides(spark):
    """A query and a target of one id are two records."""
    rows = normalize_records(spark.createDataFrame([("1", "blue river", "1 elm", "US")], RAW))
    other = normalize_records(spark.createDataFrame([("1", "blue hill", "2 elm", "US"), ("2", "old mill", "", "US")], RAW))
    assert [(r.s1_id, r.t_id) for r in retrieval.search(Channel("name", (NAME,), 5, 1.0), rows, other).collect()] == [("1", "1")]


def test_plan_does_not_grow_with_channels(spark, made):
    q, t = halves(spark, made)
    size = {n: len(retrieval.top_k(vectors.postings(q, t, retrieval.channels()[:n]), retrieval.channels()[:n])._jdf.queryExecution().optimizedPlan().toString().splitlines()) for n in (1, 6)}
    assert size[6] <= 1.1 * size[1]


def test_recall_sweeps(spark):
    pairs = spark.createDataFrame([("a", "x", 0, -1), ("a", "y", 1, 0), ("b", "x", -1, 3)], "s1_id string, t_id string, rank_n int, rank_m int")
    truth = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "z")], "s1_id string, t_id string")
    assert {r.k: r.hits for r in retrieval.recall_by_cutoff(pairs, truth, "n", (1, 2, 5)).collect()} == {1: 1, 2: 2, 5: 2}
    whole = retrieval.recall(pairs, truth).first()
    assert (whole.true_pairs, whole.hits, whole.candidates, whole.p95) == (3, 2, 3, 2)
    assert {r.s1_id + r.t_id: r.label for r in retrieval.labeled(pairs, truth).collect()} == {"ax": 1, "ay": 1, "bx": 0}
    counts = defaultdict(int)
    for r in retrieval.recall_by_channel(pairs, truth, ("n", "m")).collect():
        counts[r.channel] = (r.pairs, r.hits)
    assert counts == {"union": (3, 2), "n": (2, 2), "m": (2, 1)}
