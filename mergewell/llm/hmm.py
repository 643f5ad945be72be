"""Language-model scoring with a hidden Markov model trained by Baum-Welch."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergewell.llm.common import checkpointed
from mergewell.llm.packing import aside, bounds, bucket_count, pack, squeeze, unpack, unsqueeze, word_keys
from mergewell.llm.suffixes import ragged

#: Hidden states, words with emissions of their own, and classes of all other words.
STATES, HEAD, CLASSES = 8, 16_384, 256
#: Words whose neighbours give the first guess, rounds of training, and tokens of the prior.
SEEDS, ROUNDS, PRIOR = 512, 3, 50.0
#: Text of one block of documents, plan bytes for one bucket of words, tokens of one batch of sequences.
BLOCK_CHARS, BUCKET_BYTES, BATCH_TOKENS = 6_000_000, 12_000_000, 300_000
#: Emission counts travel in so many slices.
SLICES = 16


class _Keys(dict):
    """A word's key: 56 bits of its hash, and 8 for its class by ending."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        stem = word.rstrip(b".,;:!?)'\"") or word
        ending = zlib.crc32(stem[-2:] + (b"." if len(stem) < len(word) else b""))
        key = xxhash.xxh3_64_intdigest(word) & ~0xFF | ending & 0xFF
        if len(word) < 64:
            self[word] = key
        return key


_ROW = "bucket int, block long, ids array<{kind}>, sizes binary, train binary, n_train long, tokens binary, keys binary, counts binary, top array<bigint>, held array<bigint>, totals array<bigint>"
_NAMES = [c.split()[0] for c in _ROW.split(", ")]


def _held_out(doc_id: object) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def _tokenized(buckets: int, kind: pa.DataType):
    """Documents in blocks → for each bucket a block's words with their training counts, and a row with the block's token numbers."""
    edges = bounds(buckets)

    def block(number: int, ids: list, texts: list, keys: _Keys) -> pa.RecordBatch:
        flat, size = word_keys(texts, keys)
        train = np.array([not _held_out(i) for i in ids], bool)
        every, token = np.unique(flat, return_inverse=True)
        counts = np.bincount(token, weights=np.repeat(train, size), minlength=len(every)).astype(np.uint32)
        cut = np.concatenate([[0], np.searchsorted(every, edges), [len(every)]])
        full = [b for b in range(buckets) if cut[b] < cut[b + 1]]
        none = [None] * len(full)
        return pa.RecordBatch.from_arrays([
            pa.array([*full, aside(number)], pa.int32()), pa.array([number] * (len(full) + 1), pa.int64()),
            pa.array([*none, ids], pa.list_(kind)), pa.array([*none, size.astype(np.uint32).tobytes()], pa.binary()), pa.array([*none, train.tobytes()], pa.binary()), pa.array([*none, int(train.sum())], pa.int64()),
            pa.array([*none, squeeze(token.astype(np.uint32))], pa.binary()),
            pa.array([*(pack(every[cut[b] : cut[b + 1]]) for b in full), None], pa.binary()), pa.array([*(counts[cut[b] : cut[b + 1]].tobytes() for b in full), None], pa.binary()),
            *(pa.array([None] * (len(full) + 1), pa.list_(pa.int64())) for _ in range(3)),
        ], names=_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = _Keys()
        number, ids, texts, chars = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                ids.append(batch.column(0)[k].as_py())
                texts.append(batch.column(1)[k].as_py())
                chars += len(texts[-1] or "")
                if chars > BLOCK_CHARS:
                    yield block(number, ids, texts, keys)
                    number, ids, texts, chars = number + 1, [], [], 0
        if ids:
            yield block(number, ids, texts, keys)

    return run


def _counted(table: pa.Table) -> pa.Table:
    """A bucket of words: sums the counts of all blocks and answers each block with the sums.

    One more row has the bucket's most frequent words, and tokens and words by class.
    """
    if table.column("bucket")[0].as_py() < 0:
        return table
    keys = [unpack(x.as_py()) for x in table.column("keys")]
    every, back = np.unique(np.concatenate(keys), return_inverse=True)
    held = np.bincount(back, weights=np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table.column("counts")]), minlength=len(every)).astype(np.uint64)
    cut = np.cumsum([0, *map(len, keys)])
    top = np.lexsort((every, -held.astype(np.int64)))[:HEAD]
    top = top[held[top] > 0]
    cls = (every & np.uint64(0xFF)).astype(np.int64)
    totals = np.concatenate([np.bincount(cls, weights=held, minlength=CLASSES), np.bincount(cls, weights=held > 0, minlength=CLASSES)]).astype(np.int64)
    rows = table.to_pylist()
    for row, x, y in zip(rows, cut[:-1], cut[1:], strict=True):
        row["counts"] = held[back[x:y]].tobytes()
    rows.append({"bucket": rows[0]["bucket"], "block": -1 - rows[0]["bucket"], "top": every[top].view(np.int64), "held": held[top].view(np.int64), "totals": totals})
    return pa.Table.from_pylist(rows, table.schema)


def _gathered(table: pa.Table) -> pa.Table:
    """A block: its row about tokens, with its words and their counts from all buckets."""
    if table.column("block")[0].as_py() < 0:
        return table
    rows = table.sort_by("bucket").to_pylist()
    own = next(r for r in rows if r["tokens"] is not None)
    answers = [r for r in rows if r["tokens"] is None]
    own["keys"] = b"".join(unpack(r["keys"]).tobytes() for r in answers)
    own["counts"] = b"".join(r["counts"] for r in answers)
    return pa.Table.from_pylist([own], table.schema)


class Model:
    """States with start, move and emission probabilities, over symbols.

    Symbols are the head words, the classes of all other words, and the end.
    A word outside the head has its class's emission times (c + 1) / (tokens +
    words + 1) of its class: all words of the class and one unknown share it.
    """

    def __init__(self, head: np.ndarray, rare: np.ndarray, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.head, self.rare, self.start, self.move, self.emit = head, rare, start, move, emit

    def symbols(self, keys: np.ndarray) -> np.ndarray:
        n = len(self.head)
        if not n:
            return (keys & np.uint64(0xFF)).astype(np.int64)
        at = np.minimum(np.searchsorted(self.head, keys), n - 1)
        return np.where(self.head[at] == keys, at, n + (keys & np.uint64(0xFF)).astype(np.int64))

    @property
    def end(self) -> int:
        return len(self.head) + CLASSES


class _Batch:
    """Sequences side by side, the longest first, laid out step by step."""

    def __init__(self, flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        self.size = size
        self.alive = np.searchsorted(-size, -np.arange(size[0]), "left")
        self.at = np.concatenate([[0], np.cumsum(self.alive)])
        step = ragged(np.zeros(len(size), np.int64), size)
        self.rank = np.empty(len(step), np.int64)
        place = self.at[step] + np.repeat(np.arange(len(size)), size)
        self.rank[place] = np.repeat(np.arange(len(size)), size)
        self.symbol = np.empty(len(step), np.int64)
        self.symbol[place] = flat[ragged(start, size)]

    def forward(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scaled forward probabilities, their scales, and the emissions."""
        emit = model.emit.T[self.symbol]
        alpha, scale = np.empty_like(emit), np.empty(len(emit))
        a = np.broadcast_to(model.start, (self.alive[0], len(model.start)))
        for t in range(len(self.alive)):
            s, e = self.at[t], self.at[t + 1]
            a = (a[: e - s] @ model.move if t else a) * emit[s:e]
            total = a.sum(1)
            a /= total[:, None]
            alpha[s:e], scale[s:e] = a, total
        return alpha, scale, emit

    def likelihood(self, model: Model) -> np.ndarray:
        """log10 of the probability of each sequence."""
        return np.bincount(self.rank, weights=np.log10(self.forward(model)[1]), minlength=len(self.size))

    def counts(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, moves and emissions."""
        alpha, scale, emit = self.forward(model)
        emit /= scale[:, None]
        moves, beta = np.zeros_like(model.move), np.ones((self.alive[-1], len(model.start)))
        for t in range(len(self.alive) - 1, 0, -1):
            s, e, before = self.at[t], self.at[t + 1], self.at[t - 1]
            ahead = emit[s:e] * beta
            moves += alpha[before : before + e - s].T @ ahead
            alpha[s:e] *= beta
            beta = np.ones((s - before, alpha.shape[1]))
            beta[: e - s] = ahead @ model.move.T
        alpha[: self.at[1]] *= beta
        emits = np.stack([np.bincount(self.symbol, weights=alpha[:, k], minlength=model.emit.shape[1]) for k in range(alpha.shape[1])])
        return alpha[: self.at[1]].sum(0), moves * model.move, emits


def _sequences(row: dict, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A block's symbols with an end behind each document, starts, sizes, training flags, token numbers and counts."""
    size = np.frombuffer(row["sizes"], np.uint32).astype(np.int64)
    token = unsqueeze(row["tokens"], np.uint32)
    keys, counts = np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["counts"], np.uint64)
    flat = np.full(len(token) + len(size), model.end)
    start = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    symbol = model.symbols(keys)
    flat[ragged(start, size)] = symbol[token]
    return flat, start, size + 1, np.frombuffer(row["train"], bool), token, counts


def _batches(start: np.ndarray, size: np.ndarray, mine: np.ndarray) -> Iterator[np.ndarray]:
    """Sequences of similar sizes, with a bounded number of tokens unless one alone has more."""
    order = mine[np.argsort(-size[mine], kind="stable")]
    cuts = np.flatnonzero(np.diff((np.cumsum(size[order]) - size[order]) // BATCH_TOKENS)) + 1
    yield from (part for part in np.split(order, cuts) if len(part))


def _expected(model: Model):
    """A pass over blocks → expected counts, in slices of the emissions; slice -1 has starts and moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, moves, emits = np.zeros_like(model.start), np.zeros_like(model.move), np.zeros_like(model.emit)
        any_ = False
        for batch in batches:
            for k in range(batch.num_rows):
                flat, start, size, train, _, _ = _sequences(batch.slice(k, 1).to_pylist()[0], model)
                for part in _batches(start, size, np.flatnonzero(train)):
                    a, b, c = _Batch(flat, start[part], size[part]).counts(model)
                    starts, moves, emits, any_ = starts + a, moves + b, emits + c, True
        if any_:
            parts = [np.concatenate([starts, moves.ravel()]).tobytes(), *(x.tobytes() for x in np.array_split(emits, SLICES, axis=1))]
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, SLICES), pa.int32()), pa.array(parts, pa.binary())], names=["slice", "counts"])

    return run


def _pairs(model: Model, seeds: np.ndarray):
    """A pass over blocks → how often one seed word follows another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(seeds)
        number = np.full(model.end + 1, -1)
        number[seeds] = np.arange(n)
        total = np.zeros(n * n)
        for batch in batches:
            for k in range(batch.num_rows):
                flat, start, size, train, _, _ = _sequences(batch.slice(k, 1).to_pylist()[0], model)
                own = number[flat[ragged(start[train], size[train])]]
                a, b = own[:-1], own[1:]
                both = (a >= 0) & (b >= 0)
                total += np.bincount(a[both] * n + b[both], minlength=n * n)
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([x.tobytes() for x in np.array_split(total, SLICES)], pa.binary())], names=["slice", "counts"])

    return run


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.float64) for x in table.column("counts"))
    return pa.table({"slice": table.column("slice").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def _sum(blocks: DataFrame, run) -> dict[int, np.ndarray]:
    """Counts of all partitions, added slice by slice in two steps; their size is that of the model.

    The first step adds the square root of all partitions in each task, so no task reads a slice of every one.
    """
    tens = max(1, isqrt(blocks.rdd.getNumPartitions()))
    parts = blocks.mapInArrow(run, "slice int, counts binary").withColumn("part", F.pmod(F.spark_partition_id(), F.lit(tens)))
    some = parts.groupBy("slice", "part").applyInArrow(_added, "slice int, counts binary")
    return {r.slice: np.frombuffer(r.counts, np.float64) for r in some.groupBy("slice").applyInArrow(_added, "slice int, counts binary").collect()}


def _head(about: DataFrame, n: int) -> list:
    """The ``n`` most frequent words (``top, held``; ties by key) from the lists of all buckets.

    How many words have each count decides the least one that is needed, so only
    the words above it and those level with it reach the last sort.
    """
    words = about.select(F.explode(F.arrays_zip("top", "held")).alias("x")).select("x.top", "x.held")
    sizes = words.groupBy(F.floor(64 * F.log2("held")).alias("size")).agg(F.count("*").alias("n")).collect()  # by 1 %, so few rows
    least, total = 0, 0
    for r in sorted(sizes, key=lambda r: -r.size):
        least, total = r.size, total + r.n
        if total >= n:
            break
    words = words.where(F.floor(64 * F.log2("held")) >= least)
    return words.repartition(max(1, -(-total // (4 * n))), "top").orderBy(F.desc("held"), "top").limit(n).collect()


def clusters(pairs: np.ndarray, states: int) -> np.ndarray:
    """Groups words by what follows and precedes them: farthest-first seeds, then k-means on cosines."""
    rows = np.sqrt(np.hstack([pairs, pairs.T]))
    rows = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    centres = [int(np.argmax(pairs.sum(0) + pairs.sum(1)))]
    near = rows @ rows[centres[0]]
    weight = np.sqrt(pairs.sum(0) + pairs.sum(1))
    while len(centres) < states:
        centres.append(int(np.argmax((1 - near) * weight)))
        near = np.maximum(near, rows @ rows[centres[-1]])
    middle = rows[centres]
    for _ in range(30):
        own = np.argmax(rows @ middle.T, axis=1)
        middle = np.stack([rows[own == k].sum(0) if (own == k).any() else middle[k] for k in range(states)])
        middle = middle / np.maximum(np.linalg.norm(middle, axis=1, keepdims=True), 1e-9)
    return own


def train(blocks: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> tuple[Model, int, int, int]:
    """The model, and tokens, distinct tokens and documents of the training part, from tokenized blocks.

    The head is the most frequent words of all training documents, and all counts are
    sums over all of them. The first guess groups frequent words by their
    neighbours and lets each group be a state; words outside the groups say
    nothing yet. Each Baum-Welch round adds up expected counts of all
    partitions slice by slice; only sums, as large as the model, reach the driver.
    """
    about = blocks.where("block < 0")
    top = _head(about, HEAD)
    totals = about.select(F.posexplode("totals").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect()
    sums = np.zeros(2 * CLASSES, np.int64)
    for r in totals:
        sums[r.k] = r.n
    blocks = blocks.where("block >= 0")
    docs = blocks.agg(F.sum("n_train")).first()[0] or 0
    tokens, words = int(sums[:CLASSES].sum()) + docs, int(sums[CLASSES:].sum()) + (docs > 0)
    keys = np.array([r.top for r in top], np.int64).view(np.uint64)
    held = np.array([r.held for r in top], np.float64)
    order = np.argsort(keys)
    head, held = keys[order], held[order]
    cls = (head & np.uint64(0xFF)).astype(np.int64)
    rare_tokens = sums[:CLASSES] - np.bincount(cls, weights=held, minlength=CLASSES)
    rare_words = sums[CLASSES:] - np.bincount(cls, minlength=CLASSES)
    usual = np.concatenate([held, rare_tokens, [docs]]) + 1
    usual = usual / usual.sum()
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    model = Model(head, rare_tokens + rare_words + 1, np.full(states, 1 / states), move, np.tile(usual, (states, 1)))
    seeds = np.sort(np.lexsort((np.arange(len(held)), -held))[:SEEDS])
    if not docs or len(seeds) < 2 * states:
        return model, tokens, words, docs
    got = _sum(blocks, _pairs(model, seeds))
    own = clusters(np.concatenate([got[k] for k in range(SLICES)]).reshape(len(seeds), -1), states)
    guess = np.full((states, len(seeds)), 0.1)
    guess[own, np.arange(len(seeds))] = states
    model.emit[:, seeds] *= guess
    model.emit /= model.emit.sum(1, keepdims=True)
    for _ in range(rounds):
        got = _sum(blocks, _expected(model))
        starts, moves = got[-1][:states], got[-1][states:].reshape(states, states)
        emits = np.hstack([got[k].reshape(states, -1) for k in range(SLICES)])
        model = Model(
            head, model.rare, (starts + 1 / states) / (starts.sum() + 1), (moves + 1 / states) / (moves.sum(1, keepdims=True) + 1),
            (emits + PRIOR * usual) / (emits.sum(1, keepdims=True) + PRIOR),
        )
    return model, tokens, words, docs


def _scored(model: Model, tokens: int, words: int, docs: int, kind: pa.DataType):
    """A pass over blocks → the scores of their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = np.log10(tokens + words + 1)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                flat, start, size, train, token, counts = _sequences(row.to_pylist()[0], model)
                keys = np.frombuffer(row.column("keys")[0].as_py(), np.uint64)
                owner = np.repeat(np.arange(len(size)), size - 1)
                add = lambda x: np.bincount(owner, weights=x[token], minlength=len(size))  # noqa: B023, E731
                each = np.log10(counts.astype(float) + 1)
                base = add(each) + np.log10(docs + 1) - size * floor
                rare = np.where(model.symbols(keys) >= len(model.head), each - np.log10(model.rare[(keys & np.uint64(0xFF)).astype(np.int64)]), 0.0)
                hidden = np.zeros(len(size))
                for part in _batches(start, size, np.arange(len(size))):
                    hidden[part] = _Batch(flat, start[part], size[part]).likelihood(model)
                yield pa.RecordBatch.from_arrays([
                    row.column("ids")[0].values.cast(kind), pa.array(~train), pa.array(size), pa.array(add((counts > 0).astype(float)).astype(np.int64) + (docs > 0)),
                    pa.array(np.full(len(size), tokens)), pa.array(base), pa.array(hidden + add(rare)),
                ], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def tokenized(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` as blocks of token numbers with the training counts of their words.

    A hot word is one entry for each block that has it.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    row = _ROW.format(kind=kind)
    buckets = bucket_count(docs.select("doc_id", "text"), BUCKET_BYTES)
    parts = docs.select("doc_id", "text").mapInArrow(_tokenized(buckets, _arrow(kind)), row)
    counted = parts.groupBy("bucket").applyInArrow(_counted, row)
    return checkpointed(counted.groupBy("block").applyInArrow(_gathered, row))


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())


def score(docs: DataFrame) -> DataFrame:
    """Scores each row of ``doc_id, text`` by a model of the training rows.

    Training rows are those whose crc32(doc_id as text) mod 7 is not 2 (null:
    empty text). Tokens are words in lower case (A-Z) and one end. Returns
    ``doc_id, held_out, n_tokens, n_known`` (seen in training),
    ``train_tokens, base_score`` (unigrams with add-one smoothing) and ``score``, the
    model's log10 probability of the text by the scaled forward recursion.

    Null or empty text is its end alone. Very long texts are sequences like
    others. Rows that repeat a doc_id are separate. Without training rows all
    words are unknown. No rows, no rows. Words are told apart by 56 bits of
    hash and 8 of class.
    """
    blocks = tokenized(docs)
    model, tokens, words, n_docs = train(blocks)
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.where("block >= 0").mapInArrow(_scored(model, tokens, words, n_docs, _arrow(kind)), out)
