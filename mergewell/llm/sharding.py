"""Sharding by proportional stratified interleaving: native plans only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergewell.llm.common import checkpointed, seeded

#: Ranges of the seeded order within a source, and of the fractional ranks.
RANGES = 4096


def _ranked(rows: DataFrame, key: list[str], part: str, order: list[Column | str], name: str) -> DataFrame:
    """Adds the 0-based rank within ``key`` by (``part``, ``order``) and the count.

    Ranks are counted inside each (key, part), and the counts of the parts
    before it are added, so that no task sorts a whole key.
    """
    counts = rows.groupBy(*key, part).agg(F.count("*").alias("_in"))
    w = Window.partitionBy(*key) if key else Window.partitionBy(F.lit(0))
    counts = counts.select(
        *key, part,
        (F.sum("_in").over(w.orderBy(part)) - F.col("_in")).alias("_before"),
        F.sum("_in").over(w).alias(f"{name}_count"),
    )
    inside = F.row_number().over(Window.partitionBy(*key, part).orderBy(*order))
    return rows.withColumn("_inside", inside).join(counts, [*key, part]).withColumn(name, F.col("_before") + F.col("_inside") - 1).drop("_inside", "_before")


def shard(docs: DataFrame, shards: int = 24, seed: int = 7) -> DataFrame:
    """Deals documents to ``shards`` shards that all match the source mixture.

    Rows of a source are shuffled by a seeded hash of id and text and ranked; rank r of n gets
    the fraction (r + 1/2) / n, so every source is spread evenly over [0, 1).
    All rows in the order of their fractions are cut into runs whose counts
    differ by one at most (law ``rows``). Returns ``doc_id, size`` (UTF-8 bytes
    + 8), ``text_crc32, law, shard, slot`` (0, 1, ... within the shard) and
    ``grown_shard`` (null: this law moves rows when the shard count grows).

    Fractions are compared as whole numbers (2 r + 1) * 2^26 div n, ties by
    source and seeded order. Ranking works in hash ranges, so a hot source
    and the global order are both spread over thousands of tasks. Null text:
    0 bytes, checksum 0. Null source: a source of its own. Repeated rows are
    separate rows. No rows: no rows.
    """
    text = F.coalesce("text", F.lit(""))
    h = seeded(seed, F.col("doc_id"), F.md5(F.encode("text", "UTF-8")))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.coalesce("source", F.lit("")).alias("_source"), F.isnull("source").alias("_none"),
        h.alias("_h"), F.shiftright(h, 48).alias("_range"),
    )
    rows = checkpointed(rows)
    rows = _ranked(rows, ["_source", "_none"], "_range", ["_h", "doc_id", "text_crc32", "size"], "_rank")
    rows = rows.withColumn("_place", F.expr("((2 * _rank + 1) * 67108864L) div _rank_count")).drop("_range")
    rows = checkpointed(rows.withColumn("_slice", F.expr(f"_place div {2 * 67108864 // RANGES}")))
    rows = _ranked(rows, [], "_slice", ["_place", "_none", "_source", "_rank"], "_all")
    number = F.expr(f"(_all * {shards}) div _all_count")
    first = F.expr(f"((_all * {shards}) div _all_count * _all_count + {shards - 1}) div {shards}")
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), number.cast("int").alias("shard"),
        (F.col("_all") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
