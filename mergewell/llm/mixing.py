"""Mixing sources to target weights: capped water-filling, native plans only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergewell.llm.common import WORD, checkpointed, seeded


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3) -> DataFrame:
    """``source, source_size`` → the same with ``weight`` and ``target``.

    Sources in code point order (null last) get the weights in turn. All
    targets together share the total of the sizes by weight; a source whose
    share exceeds ``epochs`` times its size is clamped there, and what it
    leaves goes to the others by weight until none is above. Clamping in the
    order of size to weight reaches that fixed point in one pass: a source is
    clamped if, with all before it clamped, its share still exceeds its cap.
    The table has a row for each source, not for each document.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    ranked = sizes.select("source", "source_size", turn.alias("turn"), weight.cast("long").alias("weight"))
    ranked = ranked.withColumn("ratio", F.col("source_size") * F.lit(float(epochs)) / F.col("weight"))
    by = Window.orderBy("ratio", "turn")
    before, rest = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy("ratio", "turn").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    clamped = F.coalesce(F.sum(F.col("source_size") * epochs).over(before), F.lit(0))
    level = (F.sum("source_size").over(everything) - clamped).cast("double") / F.sum("weight").over(rest)
    leveled = ranked.withColumn("level", level).withColumn("free", F.col("ratio") >= F.col("level"))
    final = F.min_by("level", F.when(F.col("free"), F.struct("ratio", "turn"))).over(everything)
    return leveled.withColumn("final", final).select(
        "source", "source_size", "weight",
        F.coalesce(F.least(F.col("source_size") * F.lit(float(epochs)), F.col("final") * F.col("weight")), F.lit(0.0)).alias("target"),
    )


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """Each row as a struct, beside its size, source and place in the seeded order."""
    return docs.select(
        F.struct(*docs.columns).alias("_row"), "doc_id", word_count(F.col("text")).alias("_size"),
        F.coalesce("source", F.lit("")).alias("_source"), F.isnull("source").alias("_none"), seeded(seed, F.col("doc_id"), F.md5(F.encode("text", "UTF-8"))).alias("_order"),
    )


KEY = ["_source", "_none"]


def _cuts(rows: DataFrame, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """For each source its size and target, how often it is taken whole, and the last row taken once more.

    Of rows that are level with the last one, ``_tied`` in number, the first ``_tie`` are taken.

    Running sums are taken in hash ranges of a source, whose totals are
    summed separately: a source with a third of all rows is still spread over
    thousands of tasks.
    """
    rows = rows.withColumn("_range", F.shiftright("_order", 48))
    ranges = rows.groupBy(*KEY, "_range").agg(F.sum("_size").alias("_in_range"))
    so_far = Window.partitionBy(*KEY).orderBy("_range")
    ranges = ranges.select(*KEY, "_range", (F.sum("_in_range").over(so_far) - F.col("_in_range")).alias("_before"))
    sizes = rows.groupBy(*KEY).agg(F.sum("_size").alias("source_size"))
    goals = targets(sizes.select(F.when(~F.col("_none"), F.col("_source")).alias("source"), "source_size"), weights, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goals = goals.select(F.coalesce("source", F.lit("")).alias("_source"), F.isnull("source").alias("_none"), "source_size", "target", whole.alias("_whole"))
    inside = Window.partitionBy(*KEY, "_range").orderBy("_order", "doc_id", "_size").rowsBetween(Window.unboundedPreceding, 0)
    level = Window.partitionBy(*KEY, "_range", "_order", "doc_id", "_size")
    rows = rows.withColumn("_running", F.sum("_size").over(inside)).withColumns({"_tie": F.row_number().over(level.orderBy("_running")), "_tied": F.count("*").over(level)})
    rows = rows.join(ranges.join(goals, KEY), [*KEY, "_range"])
    fits = F.col("_before") + F.col("_running") - F.col("_size") / 2.0 <= F.col("target") - F.col("_whole") * F.col("source_size")
    return rows.groupBy(*KEY).agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("_whole").alias("_whole"),
        F.max(F.when(fits & (F.col("_size") > 0), F.struct("_order", "doc_id", "_size", "_tie", "_tied"))).alias("_cut"),
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3, seed: int = 11) -> DataFrame:
    """How often each document of ``doc_id, text, source`` enters the mix.

    Returns each input row with ``size`` (words), ``source_size, target,
    repeats`` and ``taken``; columns of these names are replaced. Each document
    is taken ``floor(target / source_size)`` times; the rest of the target
    is filled with documents in a seeded order, cut where the running size
    comes nearest, so a source misses its target by half of one document
    at most. What a source's rows need to know is one row for each source.

    Null or empty text: size 0, taken 0. Null source: a source of its own, the
    last. Repeated rows are separate documents. No rows: no rows.
    """
    rows = checkpointed(_keyed(docs.select("doc_id", "text", "source"), seed).drop("_row"))
    out = _marked(_keyed(docs, seed), _cuts(rows, weights, epochs))
    names = ["size", "source_size", "target", "repeats", "taken"]
    return out.select(*(F.col("_row")[c].alias(c) for c in docs.columns if c not in names), *names)


#: Up to so many sources with so many bytes of names are broadcast; more are joined.
BROADCAST_SOURCES, BROADCAST_BYTES = 20_000, 4_000_000


def _marked(keyed: DataFrame, cuts: DataFrame) -> DataFrame:
    cuts = checkpointed(cuts)
    seen = cuts.agg(F.count("*").alias("sources"), F.sum(F.octet_length("_source")).alias("names"), F.max(F.expr("_cut._tie < _cut._tied")).alias("split")).first()
    if seen.sources <= BROADCAST_SOURCES and (seen.names or 0) <= BROADCAST_BYTES:
        cuts = F.broadcast(cuts)
    last = F.struct(*(F.col("_cut")[c].alias(c) for c in ("_order", "doc_id", "_size")))
    place, both = F.struct("_order", "doc_id", "_size"), keyed.join(cuts, KEY)
    once_more = F.coalesce((place <= last) & (F.col("_size") > 0), F.lit(False))
    out = both.withColumn("_more", once_more)
    if seen.split:
        split = F.coalesce((place == last) & F.expr("_cut._tie < _cut._tied"), F.lit(False))
        turn = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.to_json("_row")))
        out = out.where(~split).unionByName(both.where(split).withColumn("_more", turn <= F.col("_cut._tie")))
    out = out.withColumn("repeats", (F.col("_whole") + F.col("_more").cast("int")).cast("int"))
    return out.select("_row", F.col("_size").alias("size"), "source_size", "target", "repeats", (F.col("_size") * F.col("repeats")).alias("taken"))


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as ``mix`` takes it."""
    rows = docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("_all"))
    taken = mix(rows, **options).where("repeats > 0")
    return taken.select("_all", F.explode(F.sequence(F.lit(1), F.col("repeats")))).select("_all.*")
