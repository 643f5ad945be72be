"""Checks of an answer: every rule as a distributed aggregate, reported as one row each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE_1, KNOWN = "^S1-", "^S[123]-"


def _listed(df: DataFrame) -> DataFrame:
    """``s1_id, ids``: an id and its comma list, without blanks and empty entries."""
    key, ids = df.columns[:2]
    # F.trim itself would be handed the position too and trim its digits
    entries = F.transform(F.split(F.coalesce(ids, F.lit("")), ","), lambda t: F.trim(t))
    return df.select(F.col(key).alias("s1_id"), F.filter(entries, lambda t: t != "").alias("ids"))


def _rules(file: str, df: DataFrame, required: DataFrame, known: DataFrame | None) -> list[DataFrame]:
    rows = _listed(df)
    lists = {
        "repeated id in a list": F.size(F.array_distinct("ids")) < F.size("ids"),
        "match with source 1": F.exists("ids", lambda t: t.rlike(SOURCE_1)),
        "wrong prefix": F.exists("ids", lambda t: ~t.rlike(KNOWN)),
    }
    in_lists = rows.agg(*(F.count_if(rule).alias(name) for name, rule in lists.items()))
    per_id = rows.groupBy("s1_id").agg(F.count("*").alias("n"))
    ids = required.select("s1_id").distinct()
    both = per_id.withColumn("_seen", F.lit(True)).join(ids.withColumn("_required", F.lit(True)), "s1_id", "full")
    of_ids = both.agg(
        F.count_if(F.col("n") > 1).alias("repeated source 1 id"), F.count_if(F.isnull("_seen")).alias("missing source 1 id"), F.count_if(F.isnull("_required")).alias("unexpected source 1 id"),
    )
    found = [in_lists, of_ids]
    if known is not None:
        named = rows.select(F.explode("ids").alias("t_id")).distinct()
        found.append(named.join(known.select("t_id"), "t_id", "left_anti").agg(F.count("*").alias("unknown id")))
    return [f.unpivot([], f.columns, "rule", "n").select(F.lit(file).alias("file"), "rule", F.lit("error").alias("severity"), "n") for f in found]


def problems(matches: DataFrame, candidates: DataFrame, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``file, rule, severity, n``: how often each rule is broken.

    ``matches`` and ``candidates`` have an id and a comma list; ``required`` has
    ``s1_id``, ``known`` all ``t_id`` there are. Matches outside the candidates
    are a warning, all else is an error. A rule that holds has a row with 0,
    also for empty tables; null lists are empty ones.
    """
    rows = _rules("matches", matches, required, known) + _rules("candidates", candidates, required, known)
    pairs = [_listed(df).select("s1_id", F.explode("ids").alias("t_id")).distinct() for df in (matches, candidates)]
    outside = pairs[0].join(pairs[1], ["s1_id", "t_id"], "left_anti").agg(F.count("*").alias("n"))
    rows.append(outside.select(F.lit("matches").alias("file"), F.lit("match is no candidate").alias("rule"), F.lit("warning").alias("severity"), "n"))
    return reduce(DataFrame.unionByName, rows)


def file_problems(spark: SparkSession, path: str, header: tuple[str, str]) -> DataFrame:
    """``rule, n`` for the lines of a file: another header, commas where a tab should be, lines without exactly one tab."""
    lines = spark.read.text(path, lineSep="\n").select(F.regexp_replace("value", r"\r$", "").alias("line"))
    title = F.lower("line") == "\t".join(header).lower()
    tabs = F.regexp_count("line", F.lit("\t"))
    found = lines.agg(
        F.when(F.count_if(title) == 0, 1).otherwise(0).cast("long").alias("no such header"),
        F.count_if(F.lower("line").startswith(f"{header[0].lower()},")).alias("commas for tabs"),
        F.count_if(~title & (tabs != 1) & (F.col("line") != "")).alias("line without one tab"),
    )
    return found.unpivot([], found.columns, "rule", "n")


def valid(found: DataFrame) -> bool:
    return found.where("severity = 'error' and n > 0").isEmpty()


def require_valid(found: DataFrame) -> list[str]:
    """Raises if a rule is broken; returns what is a warning."""
    rows = found.where("n > 0").collect()  # a row for each rule
    told = {s: [f"{r.file}: {r.rule} ({r.n})" for r in rows if r.severity == s] for s in ("error", "warning")}
    if told["error"]:
        raise ValueError("; ".join(told["error"]))
    return told["warning"]
