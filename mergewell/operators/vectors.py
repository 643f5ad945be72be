"""TF-IDF vectors of all channels as one table of postings: a row for each record, channel and term."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A term with more searchable targets than this is split over as many join keys as needed.
SPLIT = 20_000


@dataclass(frozen=True)
class Field:
    """One block of terms: ``kind`` is word, char or cross, over a column or two."""

    column: str
    kind: str = "word"
    weight: float = 1.0
    other: str | None = None
    n: int = 3

    @property
    def source(self) -> tuple:
        """What decides the terms; fields that differ only in weight share them."""
        return self.column, self.kind, self.other, self.n if self.kind == "char" else 0


@dataclass(frozen=True)
class Channel:
    """One way to retrieve: its blocks, how many targets for a query, and which targets count.

    ``pool`` is ``no_addr`` (targets without an address), any boolean column, or None for all.
    """

    name: str
    fields: tuple[Field, ...]
    top_k: int = 40
    max_df_frac: float = 0.01
    min_score: float = 0.05
    pool: str | None = None


def in_pool(pool: str | None) -> Column:
    if pool is None:
        return F.lit(True)
    return ~F.col("has_addr") if pool == "no_addr" else F.col(pool)


def words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda t: t != "")


def grams(text: Column, n: int) -> Column:
    """All windows of ``n`` characters of each word between marks; a shorter word is one gram."""

    def of(token: Column) -> Column:
        padded = F.concat(F.lit("<"), token, F.lit(">"))
        last = F.greatest(F.char_length(padded) - n + 1, F.lit(1))
        return F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(padded, i, F.lit(n)))

    return F.flatten(F.transform(words(text), of))


def conjunctions(left: Column, right: Column) -> Column:
    """Every ``a|b`` of a word with letters first on the left and a word on the right."""
    names = F.filter(words(left), lambda t: t.rlike("^[a-z][a-z0-9]+$"))
    return F.flatten(F.transform(names, lambda a: F.transform(words(right), lambda b: F.concat(a, F.lit("|"), b))))


def terms(source: tuple) -> Column:
    column, kind, other, n = source
    if kind == "word":
        return words(F.col(column))
    if kind == "char":
        return grams(F.col(column), n)
    return conjunctions(F.col(column), F.col(other))


def _sources(channels: tuple[Channel, ...]) -> list[tuple]:
    return list(dict.fromkeys(f.source for c in channels for f in c.fields))


def _pools(channels: tuple[Channel, ...]) -> list[str | None]:
    return list(dict.fromkeys(c.pool for c in channels))


def counted(records: DataFrame, channels: tuple[Channel, ...]) -> DataFrame:
    """``entity_id, ckey, is_target, pools, source, term, tf``: the terms of all channels in one pass and one shuffle.

    Channels that read the same columns in the same way share their terms.
    ``pools`` are the numbers of the pools that a record is in.
    """

    def tagged(k: int, source: tuple) -> Column:
        return F.transform(terms(source), lambda t: F.struct(F.lit(k).alias("source"), t.alias("term")))

    pools = F.filter(F.array(*(F.when(in_pool(p), F.lit(k)) for k, p in enumerate(_pools(channels)))), lambda x: x.isNotNull())
    every = F.array(*(tagged(k, s) for k, s in enumerate(_sources(channels))))
    rows = records.select("entity_id", "ckey", "is_target", pools.alias("pools"), F.explode(F.flatten(every)).alias("x"))
    return rows.groupBy("entity_id", "ckey", "is_target", "pools", "x.source", "x.term").agg(F.count("*").alias("tf")).select("entity_id", "ckey", "is_target", "pools", "source", "term", "tf")


def weights(counts: DataFrame, records: DataFrame, channels: tuple[Channel, ...]) -> DataFrame:
    """``ckey, source, term, uses``: for each channel and block that keeps the term its idf and number of splits.

    Numbers come from the targets in the channel's pool; the cut is max(50,
    max_df_frac of the pool), and idf = ln((1 + n) / (1 + df)) + 1. Terms of no
    searchable target are in no channel. One aggregation serves all channels.
    """
    pools, sources = _pools(channels), _sources(channels)
    sizes = records.where("is_target").groupBy("ckey").agg(F.array(*(F.count_if(in_pool(p)) for p in pools)).alias("n"))
    df = counts.where("is_target").groupBy("ckey", "source", "term").agg(F.array(*(F.count_if(F.array_contains("pools", k)) for k in range(len(pools)))).alias("df"))

    def use(c: int, block: int, field: Field, channel: Channel) -> Column:
        n, d = (F.col(x)[pools.index(channel.pool)] for x in ("n", "df"))
        kept = (F.col("source") == sources.index(field.source)) & (d > 0) & (d <= F.greatest(F.lit(50), F.floor(F.lit(channel.max_df_frac) * n)))
        idf = F.ln((1.0 + n) / (1.0 + d)) + 1
        return F.when(kept, F.struct(F.lit(c).alias("channel"), F.lit(block).alias("block"), F.lit(float(field.weight)).alias("share"), idf.alias("idf"), F.ceil(d / F.lit(float(SPLIT))).cast("int").alias("splits")))

    uses = F.filter(F.array(*(use(c, b, f, channel) for c, channel in enumerate(channels) for b, f in enumerate(channel.fields))), lambda x: x.isNotNull())
    return df.join(sizes, "ckey").select("ckey", "source", "term", uses.alias("uses")).where(F.size("uses") > 0)


def postings(queries: DataFrame, targets: DataFrame, channels: tuple[Channel, ...], corpus: DataFrame | None = None) -> DataFrame:
    """``entity_id, ckey, is_target, searchable, channel, block, term, splits, w`` of all records and channels.

    w = (1 + ln tf) idf, each block of length sqrt(its weight), the whole of
    length 1. ``channel`` is the number of the channel; the plan is one chain,
    however many there are. Both norms are taken in the records' partitions.
    Term weights are those of ``targets``, or of a ``corpus`` where one is given.
    """
    columns = ["entity_id", "ckey", *sorted({x for c in channels for f in c.fields for x in (f.column, f.other) if x} | {"has_addr" if c.pool == "no_addr" else c.pool for c in channels if c.pool})]
    records = queries.select(*columns, F.lit(False).alias("is_target")).unionByName(targets.select(*columns, F.lit(True).alias("is_target")))
    counts = counted(records, channels)
    known = records if corpus is None else corpus.select(*columns, F.lit(True).alias("is_target"))
    idf = weights(counts if corpus is None else counted(known, channels), known, channels)
    rows = counts.join(idf, ["ckey", "source", "term"])
    rows = rows.select("entity_id", "ckey", "is_target", "pools", "term", (1 + F.ln("tf")).alias("_tf"), F.explode("uses").alias("u"))
    rows = rows.select("entity_id", "ckey", "is_target", "pools", "u.channel", "u.block", "term", "u.splits", "u.share", (F.col("_tf") * F.col("u.idf")).alias("x"))
    pools = _pools(channels)
    pool_of = F.element_at(F.array(*(F.lit(pools.index(c.pool)) for c in channels)), F.col("channel") + 1)
    of_block, of_all = Window.partitionBy("entity_id", "is_target", "channel", "block"), Window.partitionBy("entity_id", "is_target", "channel")
    rows = rows.repartition("entity_id").withColumn("x", F.col("x") * F.sqrt("share") / F.sqrt(F.sum(F.col("x") * F.col("x")).over(of_block)))
    return rows.select(
        "entity_id", "ckey", "is_target", F.array_contains("pools", pool_of).alias("searchable"), "channel", "block", "term", "splits",
        (F.col("x") / F.sqrt(F.sum(F.col("x") * F.col("x")).over(of_all))).alias("w"),
    )


def sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Postings of queries (``s1_id, wq``) and of targets (``t_id, wt``)."""
    q = rows.where("not is_target").select(F.col("entity_id").alias("s1_id"), "ckey", "channel", "block", "term", "splits", F.col("w").alias("wq"))
    t = rows.where("is_target").select(F.col("entity_id").alias("t_id"), "ckey", "channel", "block", "term", "splits", "searchable", F.col("w").alias("wt"))
    return q, t


def dot_products(pairs: DataFrame, rows: DataFrame, channels: tuple[Channel, ...], decimals: int) -> DataFrame:
    """``s1_id, t_id`` and ``cos_<c>`` of every channel for exactly these pairs, by one join; 0 where no term is shared."""
    q, t = sides(rows)
    keys = ["t_id", "channel", "block", "term"]
    shared = pairs.select("s1_id", "t_id").join(q.select("s1_id", "channel", "block", "term", "wq"), "s1_id").join(t.select(*keys, "wt"), keys)
    sums = [F.sum(F.when(F.col("channel") == k, F.col("wq") * F.col("wt"))).alias(f"cos_{c.name}") for k, c in enumerate(channels)]
    dots = shared.groupBy("s1_id", "t_id").agg(*sums)
    out = pairs.join(dots, ["s1_id", "t_id"], "left")
    return out.withColumns({f"cos_{c.name}": F.coalesce(F.round(f"cos_{c.name}", decimals), F.lit(0.0)) for c in channels})
