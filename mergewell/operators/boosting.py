"""Boosted trees of several models at once, from histograms of rows that are binned once.

The trees are those of Spark ML's ``GBTClassifier`` (logistic loss, first tree
on the labels, 32 bins, variance as impurity) and come as its models. There
each model reads, bins and keeps the rows for itself and each of its trees
makes jobs of its own; here one job serves a level of all models' trees, and a
row is a byte for each feature. Sums are whole numbers, so they don't depend
on how rows are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BINS, SHARE = 32, 0.8
#: Rows whose values decide where bins end, as many as in Spark ML or more; all rows are learned from.
SAMPLE = 20_000
#: Rows of a block. Sums of a block are packed into one float: counts from bit 36, gradients of at most 4 below, at a scale of 2^19.
BLOCK, COUNT, SCALE = 8192, 1 << 36, float(1 << 19)
#: Rounds after which margins are taken from the rows anew, so that lineage stays short.
RENEW = 25
#: Least gain of the loss on rows held out, as in Spark ML.
TOLERANCE = 0.01
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Tree:
    """A tree as a heap of nodes; ``feature`` is -1 where it ends."""

    depth: int
    feature: np.ndarray = field(init=False)
    bin: np.ndarray = field(init=False)
    stats: np.ndarray = field(init=False)  # of each node: rows, sum and squares of what it predicts

    def __post_init__(self) -> None:
        n = (1 << self.depth) - 1
        self.feature, self.bin, self.stats = np.full(n, -1), np.zeros(n, np.int64), np.zeros((2 * n + 1, 3))

    def mean(self, node: int) -> float:
        return float(self.stats[node, 1] / max(self.stats[node, 0], 1))

    def predictor(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The tree with all leaves at the bottom: rows at the end of a branch go left from there."""
        value = np.array([self.mean(node) for node in range(len(self.stats))])
        ended = self.feature < 0
        for node in np.flatnonzero(ended):
            value[2 * node + 1] = value[node]
        return np.where(ended, 0, self.feature), np.where(ended, 255, self.bin), value


def _blocks(batches: Iterator[pa.RecordBatch], ends: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Blocks of bins by feature, label, models that learn from the row or are stopped by it, and the row's hash."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            x = [_values(c.to_numpy(zero_copy_only=False)) for c in part.columns[: len(ends)]]
            codes = np.stack([np.searchsorted(e, v) for e, v in zip(ends, x, strict=True)]).astype(np.uint8)
            rest = [c.to_numpy(zero_copy_only=False) for c in part.columns[len(ends) :]]
            yield pa.RecordBatch.from_pydict({name: pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for name, v in zip(("codes", "y", "learns", "stops", "row"), (codes, *rest), strict=True)})


def _values(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return np.where(np.isnan(x), -1.0, x)


def _state(row, models: int) -> list[np.ndarray]:
    learns, stops, key = (np.frombuffer(x, np.int64) for x in (row.learns, row.stops, row.row))
    y = np.where(np.frombuffer(row.y, np.int64) > 0, 1.0, -1.0)
    return [np.frombuffer(row.codes, np.uint8).reshape(-1, len(y)), y, learns, stops, key.view(np.uint64), np.zeros((models, len(y)))]


def _descend(codes: np.ndarray, rows: np.ndarray, feature: np.ndarray, bins: np.ndarray, levels: int) -> np.ndarray:
    node = np.zeros(len(rows), np.int64)
    flat, n = codes.ravel(), codes.shape[1]
    for _ in range(levels):
        node = 2 * node + 1 + (flat[feature[node] * n + rows] > bins[node])
    return node


def _advanced(state: list[np.ndarray], grown: list[list[tuple]], depth: int) -> list[np.ndarray]:
    """Margins with the trees of ``grown`` (a list for each model, of weights and trees)."""
    *rest, margins = state
    margins, rows = margins.copy(), np.arange(margins.shape[1])
    for k, trees in enumerate(grown):
        for weight, (feature, bins, value) in trees:
            margins[k] += weight * value[_descend(rest[0], rows, feature, bins, depth)]
    return [*rest, margins]


def _summed(states: Iterator[list[np.ndarray]], asked: list[tuple], level: int, first: bool, share: float) -> Iterator[list]:
    """For each model that is asked for: sums by slot, feature and bin, squares by slot, and loss and number of the rows that stop it."""
    out: list | None = None
    for codes, y, learns, stops, key, margins in states:
        found = []
        for k, salt, feature, bins, slot, n in asked:
            margin, bit = margins[k], np.int64(1 << k)
            mixed = (key ^ np.uint64(salt)) * _MIX
            mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX
            taken = ((learns & bit) != 0) & ((mixed >> np.uint64(40)) < np.uint64(int(share * (1 << 24))))
            rows = np.flatnonzero(taken)
            node = _descend(codes, rows, feature, bins, level)
            at = slot[node]
            rows, at = rows[at >= 0], at[at >= 0]
            g = y[rows] if first else 4 * y[rows] / (1 + np.exp(np.minimum(2 * y[rows] * margin[rows], 700)))
            packed, base = np.rint(g * SCALE) + COUNT, at * BINS
            sums = np.stack([np.bincount(base + c[rows], packed, n * BINS) for c in codes]).astype(np.int64)
            counts = (sums + COUNT // 2) // COUNT
            squares = np.bincount(at, np.rint(g * g * SCALE), n).astype(np.int64)
            loss = np.zeros(2, np.int64)
            if level == 0 and not first and (held := (stops & bit) != 0).any():
                loss[:] = np.rint(2 * np.logaddexp(0, -2 * y[held] * margin[held]) * SCALE).sum(), held.sum()
            found += [counts, sums - counts * COUNT, squares, loss]
        out = found if out is None else list(map(add, out, found))
    if out is not None:
        yield out


def _total(found: RDD) -> list:
    join = lambda a, b: list(map(add, a, b))
    return found.treeReduce(join) if found.getNumPartitions() > 32 else found.reduce(join)


def _ends(df: DataFrame, columns: list[str], rows: int) -> list[np.ndarray]:
    """Upper ends of all bins but the last of each feature: between its values, or in equal parts where they are too many."""
    share = min(1.0, SAMPLE / max(rows, 1))
    some = df.where(F.pmod(F.xxhash64("_row"), F.lit(1_000_000)) < F.lit(int(np.ceil(share * 1_000_000)))).select(*columns).toArrow()
    out = []
    for c in some.columns:
        x = np.sort(_values(c.to_numpy()))
        own = np.unique(x)
        if len(own) > BINS:
            own = np.unique(x[np.linspace(0, len(x) - 1, BINS + 1).astype(int)[1:-1]])
            out.append(own[own < x[-1]])
        else:
            out.append((own[1:] + own[:-1]) / 2)
    return out


def _split(tree: Tree, node: int, counts: np.ndarray, sums: np.ndarray, squares: int, features: np.ndarray, least: int) -> None:
    """The node's numbers, and its best split among ``features`` if one gains."""
    tree.stats[node] = counts[0].sum(), sums[0].sum() / SCALE, squares / SCALE
    n, total = counts[0].sum(), sums[0].sum() / SCALE
    left_n, left = counts[features].cumsum(1), sums[features].cumsum(1) / SCALE
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left**2 / left_n + (total - left) ** 2 / (n - left_n) - total**2 / n
    gain = np.where((left_n >= least) & (n - left_n >= least), gain, 0.0)
    best = np.unravel_index(gain.argmax(), gain.shape)
    if gain[best] <= 1e-9 * max(n, 1):
        return
    tree.feature[node], tree.bin[node] = features[best[0]], best[1]
    tree.stats[2 * node + 1, :2] = left_n[best], left[best]
    tree.stats[2 * node + 2, :2] = n - left_n[best], total - left[best]


def _grow(states: RDD, running: list[int], salts: dict[int, int], columns: int, depth: int, least: int, first: bool, share: float) -> tuple[dict[int, Tree], dict[int, np.ndarray]]:
    """One tree of each running model, and the loss before it on the rows held out; one job for each level.

    Of two siblings the one with fewer rows is summed; the other is what is left of their parent.
    """
    trees, losses, known = {k: Tree(depth) for k in running}, {}, {k: {} for k in running}
    width = int(np.ceil(share * columns))
    for level in range(depth):
        asked = []
        for k in running:
            t = trees[k]
            nodes = [0] if level == 0 else [2 * p + 1 + int(t.stats[2 * p + 1, 0] > t.stats[2 * p + 2, 0]) for p in range((1 << level - 1) - 1, (1 << level) - 1) if t.feature[p] >= 0]
            if nodes:
                slot = np.full((1 << level + 1) - 1, -1)
                slot[nodes] = np.arange(len(nodes))
                # rows in a branch that has ended go on to nodes without a slot
                asked.append((k, salts[k], np.maximum(t.feature, 0), t.bin, slot, nodes))
        if not asked:
            break
        found = iter(_total(states.mapPartitions(partial(_summed, asked=[(*a[:5], len(a[5])) for a in asked], level=level, first=first, share=share))))
        for k, _, _, _, _, nodes in asked:
            counts, sums, squares, loss = (next(found) for _ in range(4))
            if level == 0:
                losses[k] = loss
            own = {}
            for i, node in enumerate(nodes):
                own[node] = counts[:, i * BINS : (i + 1) * BINS], sums[:, i * BINS : (i + 1) * BINS], squares[i]
                if node:
                    own[node + 1 if node % 2 else node - 1] = tuple(a - b for a, b in zip(known[k][(node - 1) // 2], own[node], strict=True))
            known[k] = own
            for node in own:
                features = np.sort(np.random.default_rng([salts[k], node]).permutation(columns)[:width])
                _split(trees[k], node, *own[node], features, least)
    for k in running:
        # the squares of nodes at the bottom are not summed; where nothing is known of them they count as equal values
        t = trees[k]
        low = t.stats[:, 2] == 0
        t.stats[low, 2] = t.stats[low, 1] ** 2 / np.maximum(t.stats[low, 0], 1)
    return trees, losses


def _model(spark: SparkSession, trees: list[Tree], ends: list[np.ndarray], weights: list[float]) -> GBTClassificationModel:
    """Spark ML's model of these trees."""
    sc = spark.sparkContext
    jvm, gateway = sc._jvm, sc._gateway
    ml, uid = jvm.org.apache.spark.ml, jvm.org.apache.spark.ml.util.Identifiable.randomUID
    # looked up once: each step of such a name is a call to the JVM
    leaf, inner, threshold, piece, numbers_of = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, jvm.java.util.Arrays.copyOfRange, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator

    def made(t: Tree, stats, node: int):
        n, total, squares = t.stats[node]
        mean = t.mean(node)
        spread = float(max(squares / max(n, 1) - mean * mean, 0.0))
        numbers = numbers_of(piece(stats, 3 * node, 3 * node + 3), int(n))
        if node >= len(t.feature) or t.feature[node] < 0:
            return leaf(mean, spread, numbers)
        f, (low, high) = int(t.feature[node]), (t.stats[2 * node + 1], t.stats[2 * node + 2])
        gain = (low[1] ** 2 / low[0] + high[1] ** 2 / high[0] - total**2 / n) / n
        return inner(mean, spread, float(gain), made(t, stats, 2 * node + 1), made(t, stats, 2 * node + 2), threshold(f, float(ends[f][t.bin[node]])), numbers)

    tree_of = ml.regression.DecisionTreeRegressionModel
    forest, scale = gateway.new_array(tree_of, len(trees)), gateway.new_array(jvm.double, len(trees))
    for i, (t, w) in enumerate(zip(trees, weights, strict=True)):
        forest[i] = tree_of(uid("dtr"), made(t, _py2java(sc, DenseVector(t.stats.ravel())).toArray(), 0), len(ends))
        scale[i] = float(w)
    return GBTClassificationModel(ml.classification.GBTClassificationModel(uid("GBTClassifier"), forest, scale, len(ends), 2)).setFeaturesCol("_features")


def boosted(df: DataFrame, columns: list[str], learns: list[Column], stops: list[Column] | None, rounds: int, depth: int, rate: float, seed: int, least_rows: int, share: float = SHARE) -> list[GBTClassificationModel]:
    """A model for each condition of ``learns``, from the rows that meet it.

    Rows that meet the model's condition in ``stops`` too decide when to stop
    instead; without such rows, or without others, all are learned from and
    all rounds are run. A tree learns from a ``share`` of the rows, and a node
    from one of the columns. ``df`` has ``label`` and is read a few times.
    """
    spark, models = df.sparkSession, range(len(learns))
    bits = lambda of: sum((F.when(c, F.lit(1 << k)).otherwise(0) for k, c in enumerate(of)), F.lit(0)).cast("long")
    held = [F.coalesce(a & b, F.lit(False)) for a, b in zip(learns, stops, strict=True)] if stops else [F.lit(False) for _ in models]
    kinds = dict(df.dtypes)
    keys = [c for c in ("s1_id", "t_id") if c in df.columns]
    rows = df.select(
        *(F.col(c).cast("int" if kinds[c] == "boolean" else kinds[c]).alias(c) for c in columns), F.col("label").cast("long").alias("_y"),
        bits(learns).alias("_learns"), bits(held).alias("_stops"), F.xxhash64(*(keys if len(keys) == 2 else columns)).alias("_row"),
    )
    count = rows.agg(
        F.count("*"), F.count_if(F.col("_y").isNull() | ~F.col("_y").isin(0, 1)),
        *(F.count_if(F.col("_learns").bitwiseAND(1 << k) != 0) for k in models), *(F.count_if(F.col("_stops").bitwiseAND(1 << k) != 0) for k in models),
    ).first()
    if count[1]:
        raise ValueError(f"{count[1]} labels are not 0 or 1")
    if not all(count[2 : 2 + len(models)]):
        raise ValueError("a model has no row to learn from")
    stopping = [k for k in models if 0 < count[2 + len(models) + k] < count[2 + k]]
    mask = F.lit(sum(1 << k for k in stopping)).cast("long")
    rows = rows.withColumn("_stops", F.col("_stops").bitwiseAND(mask)).withColumn("_learns", F.col("_learns").bitwiseAND(F.bitwise_not("_stops")))
    ends = _ends(rows, columns, count[0])
    blocks = rows.mapInArrow(partial(_blocks, ends=ends), "codes binary, y binary, learns binary, stops binary, row binary").rdd.map(partial(_state, models=len(models)))
    forests: list[list[Tree]] = [[] for _ in models]
    kept, best, running, states = [rounds] * len(models), [np.inf] * len(models), list(models), None
    weight = lambda m: 1.0 if m == 0 else rate

    def of(first: int) -> list[list[tuple]]:
        return [[(weight(m), t.predictor()) for m, t in enumerate(f) if m >= first] if k in running else [] for k, f in enumerate(forests)]

    for m in range(rounds + 1):
        if m == rounds and not set(running) & set(stopping):
            break
        was, states = states, (blocks.map(partial(_advanced, grown=of(0), depth=depth)) if m % RENEW == 0 else states.map(partial(_advanced, grown=of(m - 1), depth=depth))).persist(StorageLevel.MEMORY_AND_DISK)
        # after the last round only the loss is asked for
        salts = {k: (seed * 1_000_003 + k * 10_007 + m) * 2 + 1 for k in running}
        trees, losses = _grow(states, running, salts, len(columns), depth if m < rounds else 1, least_rows, m == 0, share)
        if was is not None:
            was.unpersist()
        for k in set(running) & set(stopping) if m else ():
            loss = losses[k][0] / SCALE / losses[k][1]
            if best[k] - loss < TOLERANCE * max(loss, 0.01):
                kept[k] = m - 1
                running.remove(k)
            else:
                best[k] = loss
        if m == rounds or not running:
            break
        for k in running:
            forests[k].append(trees[k])
    if states is not None:
        states.unpersist()
    return [_model(spark, f[: kept[k]], ends, [weight(m) for m in range(len(f[: kept[k]]))]) for k, f in enumerate(forests)]
