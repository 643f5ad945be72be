"""Business-like records from web pages, and which of them belong together.

A page's title is the name and its language the country. Records of one title
spell name and address differently by page number, so that every table and
rule of the normalization has records to work on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mergewell.functions.normalize import normalize_records, with_name_frequency
from mergewell.operators.lineage import written

#: Country by language, and spellings of regions in it: names and codes of the same two, and one of several words.
COUNTRIES = {"en": " US", "es": "India", "fr": "France ", "de": "Germany"}
REGIONS = {
    "en": ("Arizona", "AZ", "North Carolina", "NC", "New York"),
    "es": ("Maharashtra", "महाराष्ट्र", "West Bengal", "পশ্চিমবঙ্গ", "Tamil Nadu"),
    "fr": ("Île-de-France", "Ile de France", "Bretagne", "bretagne", "Hauts-de-France"),
    "de": ("Berlin", "Berlin", "Bayern", "Bayern", "Baden"),
}
#: How a name is written, by the number of the page: before and behind the title.
NAMES = (
    ("", ""), ("", " Pvt. Ltd."), ("M/s ", " Corp"), ("Holding doing business as ", ""), ("", " | www.example.com"), ("", " मार्केटिंग"),
    ("", " S3rvices"), ("Сервис ", ""), ("", ", P.C."), ("The ", " & Bros"), ("", " Εταιρεία"),
)
#: How a street is written.
STREETS = ("th Main Street, ", "th main st., Suite 5, ", " MAIN STR, near ")


def _choice(values: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def _by_language(of: dict[str, Column], other: Column) -> Column:
    return reduce(lambda c, k: c.when(F.col("lang") == k, of[k]), of, F).otherwise(other)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, entity_id, lang, title, host``; the rest of a page is not read further."""
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return rows.select(
        "page_id", F.concat(F.lit("S"), (1 + F.col("page_id") % 3).cast("string"), F.lit("-"), F.col("page_id").cast("string")).alias("entity_id"),
        F.regexp_extract("url", "/([a-z][a-z])/", 1).alias("lang"), F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"), F.regexp_extract("url", "//([^/]*)", 1).alias("host"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``entity_id, business_name, business_address, country``: sources 1, 2 and 3 by id, some without name or address."""
    rows = pages(spark, sf_dir)
    n, size = F.col("page_id"), F.char_length("title")
    name = F.concat(_choice(tuple(a for a, _ in NAMES), n), "title", _choice(tuple(b for _, b in NAMES), n))
    # records of one title are in one of two regions, by either spelling; every fifth title is in the third
    region = _by_language({k: F.when(size % 5 == 0, F.lit(v[4])).otherwise(_choice(v[:4], 2 * (size % 2) + n % 2)) for k, v in REGIONS.items()}, F.lit("Nowhere"))
    where = F.concat(F.lit("00"), size.cast("string"), _choice(STREETS, n), region, F.lit(" "), "host")
    return rows.select(
        "entity_id", F.when(n % 97 != 5, name).alias("business_name"),
        F.when(n % 13 == 3, "NULL").when(n % 13 != 4, where).alias("business_address"), _by_language({k: F.lit(v) for k, v in COUNTRIES.items()}, F.lit(None).cast("string")).alias("country"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(with_name_frequency(normalize_records(raw(spark, sf_dir))))


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries (source 1) and targets (sources 2 and 3)."""
    return rows.where("entity_id like 'S1-%'"), rows.where("entity_id not like 'S1-%'")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``s1_id, t_id``: records of one title and country belong together by two of each source in the order of pages.

    So a title of very many pages gives pairs in proportion, not all with all.
    """
    rows = pages(spark, sf_dir).where("title <> ''").withColumn("source", F.substring("entity_id", 1, 2))
    place = F.row_number().over(Window.partitionBy("title", "lang", "source").orderBy("page_id")) - 1
    rows = rows.select("entity_id", "title", "lang", F.floor(place / 2).alias("_pair"))
    q, t = split(rows)
    q, t = q.withColumnRenamed("entity_id", "s1_id"), t.withColumnRenamed("entity_id", "t_id")
    return written(q.join(t, ["title", "lang", "_pair"]).select("s1_id", "t_id"))
