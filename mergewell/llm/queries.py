"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewell.llm import bpe, chat, dedup, hmm, html, jaccard, knn, mixing, quality, sharding
from mergewell.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.digests(table(spark, sf_dir, "documents"))


def op2_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    done = chat.render(chat.fold(chat.turn_events(rows)))
    done = done.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.encode(spoken, "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


OP4_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r0, text AS t0 FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, r0 NULLS FIRST, t0 NULLS FIRST)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, r0 NULLS FIRST, t0 NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(21 + length(role) + length(text)
    + len(regexp_extract_all(role, '[<\[]\\*(?:/?s>|/?INST\])')) + len(regexp_extract_all(text, '[<\[]\\*(?:/?s>|/?INST\])')))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_file())
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=24)


OP6_SQL = """
WITH crc_table AS (
  SELECT list(list_reduce([i::BIGINT] || range(8)::BIGINT[], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS entries
  FROM range(256) t(i)),
rows AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 8 AS size, hex(encode(coalesce(text, ''))) AS digits,
    ('0x' || substr(md5(concat('7:', coalesce(doc_id::VARCHAR, 'null'), ':', coalesce(md5(text), 'null'))), 1, 15))::BIGINT AS h
  FROM documents),
summed AS (
  SELECT doc_id, source, size, h,
    xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(range(size - 8), lambda i: ('0x' || digits[2 * i + 1:2 * i + 2])::BIGINT),
      lambda a, b: xor(entries[xor(a & 255, b) + 1], a >> 8))) AS text_crc32
  FROM rows, crc_table),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST, text_crc32, size) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM summed),
placed AS (
  SELECT *, row_number() OVER (ORDER BY ((2 * r + 1) * 67108864) // n, source IS NULL, coalesce(source, ''), r) - 1 AS k, count(*) OVER () AS total FROM ranked)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, ((k * 24) // total)::INT AS shard,
  (k - (((k * 24) // total) * total + 23) // 24)::BIGINT AS slot, NULL::INT AS grown_shard
FROM placed
"""


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    done = quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return knn.search(rows, rows.where("vec_id % 20 = 0"), k=10)


OP9_SQL = """
WITH codes AS (
  SELECT vec_id, list_sum(list_transform(embedding, lambda x, i: CASE WHEN x > 0 THEN 1::HUGEINT << (i - 1)::INT ELSE 0 END))::UBIGINT AS code
  FROM embeddings WHERE embedding IS NOT NULL),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, bit_count(xor(q.code, c.code))::INT AS distance
  FROM codes q, codes c WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INT AS rank, vec_id, distance
FROM pairs QUALIFY rank <= 10
"""


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP10_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5(concat('11:', coalesce(doc_id::VARCHAR, 'null'), ':', coalesce(md5(text), 'null'))), 1, 15))::BIGINT AS h
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, row_number() OVER (ORDER BY source NULLS LAST) AS turn
  FROM rows GROUP BY source),
levels AS (
  SELECT *, source_size * 3.0::DOUBLE / weight AS ratio,
    (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (ORDER BY source_size * 3.0::DOUBLE / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / sum(weight) OVER (ORDER BY source_size * 3.0::DOUBLE / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources),
goals AS (
  SELECT source, source_size, coalesce(least(source_size * 3.0::DOUBLE, (SELECT level FROM levels WHERE ratio >= level ORDER BY ratio, turn LIMIT 1) * weight), 0) AS target FROM levels),
running AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole,
    sum(size) OVER (PARTITION BY rows.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS so_far
  FROM rows JOIN goals ON rows.source IS NOT DISTINCT FROM goals.source)
SELECT doc_id, size, source_size, target,
  (size * (whole + (so_far - size / 2.0::DOUBLE <= target - whole * source_size AND size > 0)::INT))::BIGINT AS taken
FROM running
"""


def queries() -> dict[str, Query]:
    return {
        "op1_suffixes": op1_suffixes,
        "op2_hmm": op2_hmm,
        "op3_jaccard": op3_jaccard,
        "op4_chat": op4_chat,
        "op5_bpe": op5_bpe,
        "op6_sharding": op6_sharding,
        "op7_html": op7_html,
        "op8_quality": op8_quality,
        "op9_knn": op9_knn,
        "op10_mixing": op10_mixing,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_chat": OP4_SQL, "op6_sharding": OP6_SQL, "op9_knn": OP9_SQL, "op10_mixing": OP10_SQL}
