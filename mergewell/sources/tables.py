"""Readers and writers: tab-separated sources, truth, id lists, reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE = ("entity_id", "business_name", "business_address", "country")
TRUTH = ("source1_entity_id", "matched_entity_ids")
CANDIDATES = ("source1_entity_id", "candidate_entity_ids")


def read_tsv(spark: SparkSession, path: str, expected: tuple[str, ...], limit: int | None = None) -> DataFrame:
    """A file with a header, without quoting or types; other columns are left out, a missing one is an error."""
    df = spark.read.csv(path, sep="\t", header=True, quote="", inferSchema=False, lineSep="\n", encoding="UTF-8")
    if missing := [c for c in expected if c not in df.columns]:
        raise ValueError(f"{path}: missing columns {missing}, found {df.columns}")
    df = df.select(*expected)
    return df if limit is None else df.limit(limit)


def tsv_rows(spark: SparkSession, path: str) -> int:
    """Lines below the header; no column is parsed."""
    return spark.read.csv(path, sep="\t", header=True, quote="", inferSchema=False, lineSep="\n", encoding="UTF-8").count()


def check_keys(df: DataFrame, key: str = "entity_id") -> DataFrame:
    """The frame itself; null or repeated keys are an error. One pass counts both."""
    per = df.groupBy(key).agg(F.count("*").alias("n")).agg(F.max(F.when(F.col(key).isNull(), F.col("n"))).alias("null"), F.count_if((F.col("n") > 1) & F.col(key).isNotNull()).alias("twice"))
    row = per.first()
    if row.null:
        raise ValueError(f"{row.null} rows without {key}")
    if row.twice:
        raise ValueError(f"{row.twice} values of {key} repeat")
    return df


def read_source(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    return check_keys(read_tsv(spark, path, SOURCE, limit))


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """``s1_id, t_id``, one row for each pair of the comma lists."""
    return exploded_lists(read_tsv(spark, path, TRUTH))


def exploded_lists(df: DataFrame) -> DataFrame:
    key, ids = df.columns[:2]
    rows = df.select(F.col(key).alias("s1_id"), F.explode(F.split(F.coalesce(ids, F.lit("")), ",")).alias("t_id")).withColumn("t_id", F.trim("t_id"))
    return rows.where("t_id <> ''").dropDuplicates(["s1_id", "t_id"])


def id_lists(ids: DataFrame, pairs: DataFrame, header: tuple[str, str] = TRUTH) -> DataFrame:
    """One row for each id with its targets in order, joined by commas; empty if it has none."""
    lists = pairs.select("s1_id", "t_id").distinct().groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_list("t_id")), ",").alias("ids"))
    return ids.select("s1_id").distinct().join(lists, "s1_id", "left").select(F.col("s1_id").alias(header[0]), F.coalesce("ids", F.lit("")).alias(header[1]))


def write_tsv(df: DataFrame, path: str) -> None:
    """Values as they are: without quoting, blanks at their ends kept; null as nothing."""
    whole = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").csv(path, sep="\t", header=True, quote="", emptyValue="", nullValue="", lineSep="\n", **whole)


def write_report(df: DataFrame, path: str) -> None:
    """A small table as one CSV file."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def read_records(spark: SparkSession, paths: list[str], ckey: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Normalized records of some Parquet tables; filter and columns reach the scans."""
    df = reduce(lambda a, b: a.unionByName(b), [spark.read.parquet(p) for p in paths])
    df = df if ckey is None else df.where(F.col("ckey") == ckey)
    return df if columns is None else df.select(*columns)


def query_count(records: DataFrame, ckey: str) -> int:
    """Records of source 1 in a country."""
    return records.where((F.col("ckey") == ckey) & F.col("entity_id").startswith("S1-")).count()


def countries(records: DataFrame) -> DataFrame:
    return records.select("ckey").distinct().orderBy("ckey")
