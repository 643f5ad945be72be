"""Pair, context and second-stage features: windows and expressions on pair rows."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergewell.functions.strings import all_scored

CONTEXT = ("cos_both", "cos_name", "cos_addr")
#: Competitors of a target that are told apart.
TOP = 8
#: Name, column and scorer of each string feature.
STRINGS = (
    ("n_ratio", "name_core", "ratio"), ("n_tsort", "name_core", "token_sort"), ("n_tset", "name_core", "token_set"), ("n_partial", "name_core", "partial"),
    ("n_jw", "name_core", "jaro_winkler"), ("n_full_ratio", "name_norm", "ratio"), ("n_alt_tset", "name_alt", "token_set"), ("n_phon_ratio", "name_phon", "ratio"),
    ("n_nospace_ratio", "name_nospace", "ratio"), ("a_ratio", "addr_norm", "ratio"), ("a_tset", "addr_norm", "token_set"), ("a_tsort", "addr_norm", "token_sort"),
)


def dealt(rows: DataFrame) -> DataFrame:
    """Rows in as many parts as a shuffle has: scoring takes long for its bytes, and parts of equal bytes would be too few."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def channel_names(pairs: DataFrame) -> list[str]:
    return [c.removeprefix("cos_") for c in pairs.columns if c.startswith("cos_")]


def stage0(pairs: DataFrame) -> DataFrame:
    """What retrieval alone tells: numbers of pairs and channels, gaps to the best of the query and of the target."""
    of_q, of_t, names = Window.partitionBy("s1_id"), Window.partitionBy("t_id"), channel_names(pairs)
    new = {
        "s0_q_n": F.count("*").over(of_q), "s0_t_n": F.count("*").over(of_t),
        "s0_n_channels": reduce(add, [(F.col(f"rank_{c}") >= 0).cast("int") for c in names]),
    }
    for c in names:
        new[f"s0_qgap_{c}"] = F.col(f"cos_{c}") - F.max(f"cos_{c}").over(of_q)
        new[f"s0_tgap_{c}"] = F.col(f"cos_{c}") - F.max(f"cos_{c}").over(of_t)
    return pairs.withColumns(new)


def _best_of(pairs: DataFrame, score: str, n: int, *also: str) -> DataFrame:
    """``t_id, _top``: the ``n`` best rows of each target as structs of the score and ``also``, best first.

    Each task keeps ``n`` rows of a target before the shuffle, so a target that very many queries hold is no hot task.
    """
    place = F.row_number().over(Window.partitionBy("t_id").orderBy(F.desc(score), "s1_id"))
    rows = pairs.select("t_id", "s1_id", score, *also).withColumn("_n", place).where(F.col("_n") <= n)
    return rows.groupBy("t_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", score, "s1_id", *also))), lambda x: x.dropFields("_n")).alias("_top"))


def competition(pairs: DataFrame) -> DataFrame:
    """For each target how many queries hold it, its ``TOP`` best ``cos_both`` and its best other cosines."""
    sums = pairs.groupBy("t_id").agg(F.count("*").alias("t_n_q"), *(F.max(s).alias(f"_max_{s}") for s in CONTEXT))
    best = _best_of(pairs, "cos_both", TOP).select("t_id", F.transform("_top", lambda x: x["cos_both"]).alias("_top"))
    return sums.join(best, "t_id")


def context(pairs: DataFrame) -> DataFrame:
    """Competition within the query and for the target.

    The rank for a target is 1 and the number of strictly better queries among
    its ``TOP`` best; the margin is to the second best for the best one, to
    the best for the others. What a target knows is one aggregated row, joined back.
    """
    of_q = Window.partitionBy("s1_id")
    new = {"q_n_cands": F.count("*").over(of_q)}
    for s in CONTEXT:
        new[f"q_gap_{s}"] = F.col(s) - F.max(s).over(of_q)
        new[f"q_rank_{s}"] = F.row_number().over(of_q.orderBy(F.desc(s), "t_id"))
    rows = pairs.withColumns(new).join(competition(pairs), "t_id")
    mine, best = F.col("cos_both"), F.col("_max_cos_both")
    rows = rows.withColumns({f"t_gap_{s}": F.col(s) - F.col(f"_max_{s}") for s in CONTEXT})
    rows = rows.withColumn("t_rank_cos_both", 1 + F.size(F.filter("_top", lambda x: x > mine)))
    second = F.coalesce(F.get("_top", F.lit(1)), F.lit(0.0))
    rows = rows.withColumn("t_margin_cos_both", F.when(mine >= best, mine - second).otherwise(mine - best))
    return rows.select(*pairs.columns, *(c for c in rows.columns if c not in pairs.columns and not c.startswith("_")))


def with_records(pairs: DataFrame, queries: DataFrame, targets: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Pairs with ``q_<c>`` and ``t_<c>`` of both records."""
    q = queries.select(F.col("entity_id").alias("s1_id"), *(F.col(c).alias(f"q_{c}") for c in columns))
    t = targets.select(F.col("entity_id").alias("t_id"), *(F.col(c).alias(f"t_{c}") for c in columns))
    return pairs.join(q, "s1_id").join(t, "t_id")


def overlap(a: Column, b: Column, prefix: str) -> dict[str, Column]:
    """Common distinct values, and their share of all; null if there are none."""
    both, every = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return {f"{prefix}_common": both, f"{prefix}_jacc": F.when(every > 0, both / every)}


def sets_and_flags(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """Overlaps of words and numbers, first elements, conflicts and record flags."""
    rows = with_records(pairs.select("s1_id", "t_id"), queries, targets, ("name_core", "addr_norm", "addr_nums", "has_addr", "translit", "name_freq"))
    qn, tn, qa, ta = (F.split(c, " ") for c in ("q_name_core", "t_name_core", "q_addr_norm", "t_addr_norm"))
    qd, td, first = F.col("q_addr_nums"), F.col("t_addr_nums"), F.lit(0)
    new = overlap(qn, tn, "ntok") | overlap(qa, ta, "atok") | overlap(qd, td, "num")
    new |= {
        "q_n_nums": F.size(qd), "t_n_nums": F.size(td), "num_first_eq": (F.get(qd, first) == F.get(td, first)).cast("int"),
        "ntok_first_eq": (F.get(qn, first) == F.get(tn, first)).cast("int"), "q_n_tokens": F.size(qn), "t_n_tokens": F.size(tn),
        "num_conflict": ((F.size(qd) > 0) & (F.size(td) > 0) & (F.size(F.array_intersect(qd, td)) == 0)).cast("int"),
        "num_t_subset": ((F.size(td) > 0) & (F.size(F.array_intersect(qd, td)) == F.size(td))).cast("int"),
        "t_is_s3": F.col("t_id").startswith("S3-").cast("int"), "t_translit": F.col("t_translit").cast("int"), "t_has_addr": F.col("t_has_addr").cast("int"),
        "name_core_eq": (F.col("q_name_core") == F.col("t_name_core")).cast("int"), "addr_eq": (F.col("q_addr_norm") == F.col("t_addr_norm")).cast("int"),
        "q_name_freq": F.col("q_name_freq"), "t_name_freq": F.col("t_name_freq"), "len_diff": F.abs(F.char_length("q_name_core") - F.char_length("t_name_core")),
    }
    return rows.select("s1_id", "t_id", *(e.alias(k) for k, e in new.items()))


def strings(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """The twelve string similarities, in [0, 1], from one pass of a vectorized function over the pairs."""
    bare = F.replace("name_core", F.lit(" "), F.lit(""))
    columns = tuple(dict.fromkeys(c for _, c, _ in STRINGS))
    rows = with_records(pairs.select("s1_id", "t_id"), queries.withColumn("name_nospace", bare), targets.withColumn("name_nospace", bare), columns)
    return dealt(rows).select("s1_id", "t_id", all_scored(STRINGS, [F.col(f"q_{c}") for c in columns], [F.col(f"t_{c}") for c in columns], columns).alias("x")).select("s1_id", "t_id", "x.*")


def pair_features(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """All features of a pair: ``pairs`` with string scores, overlaps and flags."""
    return pairs.join(strings(pairs, queries, targets), ["s1_id", "t_id"]).join(sets_and_flags(pairs, queries, targets), ["s1_id", "t_id"])


def query_context(pairs: DataFrame) -> DataFrame:
    """``s1_id`` with the best, second and sum of ``p1``, numbers of likely pairs, and the two best targets."""
    place = F.row_number().over(Window.partitionBy("s1_id").orderBy(F.desc("p1"), "t_id"))
    rows = pairs.select("s1_id", "t_id", "p1").withColumn("_n", place)
    at = lambda n, c: F.max(F.when(F.col("_n") == n, F.col(c)))
    return rows.groupBy("s1_id").agg(
        F.max("p1").alias("q_p1_max"), F.coalesce(at(2, "p1"), F.lit(0.0)).alias("q_p1_second"), F.sum("p1").alias("q_p1_sum"),
        F.count_if(F.col("p1") >= 0.5).alias("q_p1_n50"), F.count_if(F.col("p1") >= 0.2).alias("q_p1_n20"), at(1, "t_id").alias("_top1"), at(2, "t_id").alias("_top2"),
    )


def target_context(pairs: DataFrame) -> DataFrame:
    """``t_id`` with the best and second ``p1``, the best query and the number of likely pairs."""
    sums = pairs.groupBy("t_id").agg(F.max("p1").alias("t_p1_max"), F.count_if(F.col("p1") >= 0.2).alias("t_p1_n20"))
    best = _best_of(pairs, "p1", 2).select("t_id", F.coalesce(F.get("_top", F.lit(1))["p1"], F.lit(0.0)).alias("t_p1_second"), F.get("_top", F.lit(0))["s1_id"].alias("_best_q"))
    return sums.join(best, "t_id")


def standing(pairs: DataFrame) -> DataFrame:
    """From ``s1_id, t_id, p1``: how the pair stands among those of its query and of its target."""
    rank = F.row_number().over(Window.partitionBy("s1_id").orderBy(F.desc("p1"), "t_id"))
    rows = pairs.withColumn("q_p1_rank", rank).join(query_context(pairs), "s1_id").join(target_context(pairs), "t_id")
    mine = F.col("s1_id") == F.col("_best_q")
    rows = rows.withColumns({
        "q_p1_gap": F.col("p1") - F.col("q_p1_max"), "q_p1_share": F.col("p1") / F.greatest("q_p1_sum", F.lit(1e-6)), "t_is_best_q": mine.cast("int"),
        "t_p1_best_other": F.when(mine, F.col("t_p1_second")).otherwise(F.col("t_p1_max")), "is_top1": (F.col("t_id") == F.col("_top1")).cast("int"),
    })
    return rows.withColumn("t_p1_margin", F.col("p1") - F.col("t_p1_best_other")).drop("_best_q")


def stage2(pairs: DataFrame, targets: DataFrame) -> DataFrame:
    """``standing``, and how the target's name and address resemble those of the query's two best; null without such a one."""
    rows = standing(pairs)
    for k in ("", "1", "2"):
        side = targets.select(F.col("entity_id").alias("_id"), F.col("name_core").alias(f"_name{k}"), F.col("addr_norm").alias(f"_addr{k}"))
        rows = rows.join(side, F.col("_id") == F.col(f"_top{k}" if k else "t_id"), "left").drop("_id")
    plan = tuple((f"sib_top{k}_{f}", f"{f}{k}", "token_set") for k in "12" for f in ("name", "addr"))
    columns = tuple(c for _, c, _ in plan)
    found = all_scored(plan, [F.col(f"_{c[:-1]}") for c in columns], [F.col(f"_{c}") for c in columns], columns)
    rows = dealt(rows).withColumn("_x", found)
    return rows.select(*(c for c in rows.columns if not c.startswith("_")), "_x.*")
