"""Exact top-k search over binary codes by incremental multi-index hashing."""

from __future__ import annotations

from functools import reduce
from math import ceil, comb, log2
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergewell.llm.common import checkpointed

BITS = 64
#: A radius whose probes of one segment number fewer than this is searched in all segments at once.
FEW_PROBES = 100


def sign_code(embedding: Column) -> Column:
    """Bit i is set if component i is positive (null: not); 64 components."""
    bits = F.transform(embedding, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def _segments(code: str, bits: list[int]) -> list[Column]:
    out, at = [], 0
    for b in bits:
        out.append(F.expr(f"int(shiftrightunsigned({code}, {at}) & {(1 << b) - 1}L)"))
        at += b
    return out


def _distances(a: str, b: str, bits: list[int]) -> list[Column]:
    out, at = [], 0
    for n in bits:
        out.append(F.expr(f"bit_count(shiftrightunsigned({a} ^ {b}, {at}) & {(1 << n) - 1}L)"))
        at += n
    return out


def _masks(bits: int, radius: int) -> Column:
    """All values of so many bits with ``radius`` ones, a constant array."""
    return F.split(F.lit(",".join(str(x) for x in range(1 << bits) if x.bit_count() == radius)), ",").cast("array<int>")


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("_q").orderBy("_d", "_first")
    return found.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def search(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` rows nearest to each query by Hamming distance of sign codes.

    ``rows`` and ``queries`` have ``vec_id, embedding`` with 64 components.
    Returns ``query_id, rank`` (from 1), ``vec_id, distance``; ties go to the
    smaller vec_id (null first), and a query that is also a row finds itself.

    Equal codes are collapsed into one, so a group of copies is one entry. The
    code is cut into segments of about log2(n) - 2.5 bits, so that a lookup
    meets about six codes. Step (s, a) looks up, for
    every query still open, the segment values at distance s from its own in
    segment a; after it all codes within distance m s + a are found, and a
    query whose kth distance is no greater is closed. A code met in more than one
    segment counts in the first that reaches it. Nothing is approximate:
    the last step covers all 64 bits. Codes are then expanded to at most ``k``
    rows each, the first by vec_id, which is all that a result can hold.

    A null embedding is neither found nor a query; fewer than ``k`` rows give
    all of them. Rows that repeat a vec_id are separate. No rows or no queries:
    no result.
    """
    coded = checkpointed(rows.where("embedding is not null").select(F.col("vec_id").alias("_id"), sign_code(F.col("embedding")).alias("_code")))
    asked = checkpointed(queries.where("embedding is not null").select(F.col("vec_id").alias("_query"), sign_code(F.col("embedding")).alias("_q")))
    first = Window.partitionBy("_code").orderBy(F.col("_id").asc_nulls_first())
    members = coded.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k).drop("_n")
    index = checkpointed(coded.groupBy("_code").agg(F.min(F.struct(F.isnotnull("_id").alias("known"), "_id")).alias("_first")))
    n = index.count()
    wanted = min(k, n)
    m = ceil(BITS / max(4, min(16, round(log2(n + 1) - 2.5))))
    bits = [BITS // m + (i < BITS % m) for i in range(m)]
    entries = checkpointed(index.select("_code", "_first", F.posexplode(F.array(*_segments("_code", bits)))).toDF("_code", "_first", "_seg", "_value"))
    best: DataFrame | None = None
    open_ = checkpointed(asked.select("_q").distinct().withColumn("_kth", F.lit(BITS + 1)))
    steps = []
    for s in range(max(bits) + 1):
        segments = [i for i in range(m) if s <= bits[i]]
        few = comb(max(bits), s) < FEW_PROBES
        steps += [(s, segments)] if few else [(s, [i]) for i in segments]
    for s, segments in steps:
        if n == 0 or open_.isEmpty():
            break
        own = F.array(*(F.struct(F.lit(i).alias("_seg"), _segments("_q", bits)[i].alias("_own"), _masks(bits[i], s).alias("_masks")) for i in segments))
        probes = open_.select("_q", "_kth", F.explode(own).alias("_p")).select("_q", "_kth", F.col("_p._seg").alias("_seg"), F.col("_p._own").alias("_own"), F.explode("_p._masks").alias("_mask"))
        probes = probes.select("_q", "_kth", "_seg", F.col("_own").bitwiseXOR(F.col("_mask")).alias("_value"))
        each = _distances("_q", "_code", bits)
        fresh = F.lit(False)
        for i in segments:
            # an earlier step, or in this one an earlier segment, has met the code already
            met = [each[j] <= s if j < i else each[j] < s for j in range(m) if j != i]
            fresh = fresh | (F.col("_seg") == i) & ~reduce(or_, met, F.lit(False))
        found = probes.join(entries, ["_seg", "_value"]).where(fresh).select("_q", "_kth", "_code", "_first", F.expr("bit_count(_q ^ _code)").alias("_d"))
        found = found.where(F.col("_d") <= F.col("_kth")).drop("_kth")
        best = checkpointed(_best(found if best is None else best.unionByName(found), wanted))
        covered = m * s + segments[-1]
        kth = best.groupBy("_q").agg(F.when(F.count("*") >= wanted, F.max("_d")).otherwise(F.lit(BITS + 1)).alias("_now"))
        open_ = checkpointed(open_.join(kth, "_q", "left").select("_q", F.coalesce("_now", F.lit(BITS + 1)).alias("_kth")).where(F.col("_kth") > covered))
    if best is None:
        best = asked.select("_q", F.lit(0).alias("_d"), F.col("_q").alias("_code")).where(F.lit(False))
    near = best.join(members, "_code").select("_q", "_d", "_id")
    order = Window.partitionBy("_q").orderBy("_d", F.col("_id").asc_nulls_first())
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return asked.join(near, "_q").select(F.col("_query").alias("query_id"), "rank", F.col("_id").alias("vec_id"), F.col("_d").cast("int").alias("distance"))
