"""The corpus pipeline: quality, near copies, repeated passages, mixture, tokens.

``STAGES`` are applied in order; each works on what its predecessor left,
written as Parquet and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from mergewell.llm import bpe, dedup, jaccard, mixing, quality
from mergewell.llm.common import checkpointed, shared_folder
from mergewell.llm.queries import tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or have too little content go."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # numbered, since a table may have columns with the names of the verdicts
    numbered = {c: f"_{k}" for k, c in enumerate(docs.columns)}
    rows = docs.select("doc_id", "text", *(F.col(c).alias(n) for c, n in numbered.items()))
    good = quality.judge(rows, model, keep=tuple(numbered.values())).where("kept")
    return good.select(*(F.col(n).alias(c) for c, n in numbered.items()))


def _row_key(docs: DataFrame) -> Column:
    """A string for each ``doc_id`` and text, in the order of ids; rows without an id come last."""
    own = F.col("doc_id")
    if isinstance(docs.schema["doc_id"].dataType, IntegralType):
        own = F.lpad(F.hex(own.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    own = F.coalesce(F.concat(F.lit("0"), own.cast("string")), F.lit("1"))
    return F.concat(own, F.lit("\0"), F.md5(F.encode(F.coalesce("text", F.lit("")), "UTF-8")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows one with the smallest doc_id stays.

    Rows are documents of their own, also those that repeat a doc_id or have
    none; a row without one stays only if no row of its group has one. Rows
    without a word link to nothing and stay.
    """
    keyed = docs.withColumn("_key", _row_key(docs))
    links = jaccard.link(keyed.select(F.col("_key").alias("doc_id"), "text")).where("doc_id = component_id")
    heads = checkpointed(links.groupBy(F.col("doc_id").alias("_key")).agg(((F.count("*") > 1) & (F.max("n_shingles") > 0)).alias("_again")))
    kept = keyed.join(heads.where("not _again"), "_key", "left_semi")
    if not (again := heads.where("_again")).isEmpty():
        kept = kept.unionByName(keyed.join(again, "_key", "left_semi").dropDuplicates(["_key"]))
    return kept.select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes stay where they come first; documents with nothing else go."""
    out = dedup.cleaned(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks."""
    return mixing.repeated(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    done = bpe.encode(docs, tokenizer_file())
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", source_mixture),
    ("BPE encoding and decoding", tokens),
]

#: The trained model of the first stage has no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
