"""Suffix-array dedup of 50-byte strings across documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergewell.llm.packing import bounds, bucket_count, mixed, pack, pack_runs, tidy, unpack, unpack_runs
from mergewell.llm.suffixes import ragged, sorted_suffixes

#: Bytes of a string that counts as repeated, and of the grams among which its key is chosen.
LENGTH, GRAM = 50, 16
#: Plan bytes for one block of texts and for one bucket of keys.
BLOCK_BYTES, BUCKET_BYTES = 2_000_000, 1_500_000
#: Bytes of text whose grams are hashed together, and of pieces whose windows are compared together.
PART, SYMBOLS = 500_000, 500_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_NEVER = np.iinfo(np.int64).max


class Runs:
    """The windows of some texts, in runs of neighbours with one key.

    A window is 50 bytes; its key is the least hash of its 35 grams of 16
    bytes, so equal windows have equal keys wherever they are, and a run
    of windows with one key is one piece of text to send to that key's bucket.
    """

    def __init__(self, texts: list[bytes]) -> None:
        size = np.array([len(t) for t in texts], np.int64)
        self.data = b"".join(texts)
        self.text_at = np.concatenate([[0], np.cumsum(size)])
        parts = [self._part(texts, size, a, b) for a, b in self._slices(size)]
        #: Of each run: its key, its text, its first window and how many windows it has.
        self.key, self.text, self.start, self.windows = (np.concatenate(x) if parts else np.zeros(0, np.int64) for x in (zip(*parts, strict=True) if parts else [()] * 4))

    @staticmethod
    def _slices(size: np.ndarray) -> list[tuple[int, int]]:
        """Neighbouring texts of about ``PART`` bytes together."""
        cuts = np.flatnonzero(np.diff(np.cumsum(size) // PART)) + 1
        ends = [0, *cuts.tolist(), len(size)]
        return [(a, b) for a, b in zip(ends[:-1], ends[1:], strict=True) if a < b]

    def _part(self, texts: list[bytes], size: np.ndarray, a: int, b: int) -> tuple[np.ndarray, ...]:
        data = b"".join(texts[a:b]) + bytes(LENGTH + 14)
        words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)).copy()
        low = mixed(words[:-8] * _ODD + mixed(words[8:] + _ODD))
        for step in (1, 2, 4, 8, 16, 3):
            low = np.minimum(low[:-step], low[step:])
        windows = np.maximum(size[a:b] - LENGTH + 1, 0)
        begin = self.text_at[a]
        where = ragged(self.text_at[a:b] - begin, windows)
        owner = np.repeat(np.arange(a, b), windows)
        key = low[where]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        # least hashes crowd at the low end; mixed once more they fill the range of keys evenly
        return mixed(key[at] + _ODD), owner[at], where[at] + begin, np.diff(np.append(at, len(key)))


def _texts(table: pa.Table) -> tuple[list[str], list[bytes]]:
    """The distinct texts of a block by fingerprint, in its order."""
    found: dict[str, bytes] = {}
    for h, t in zip(table.column("h"), table.column("text"), strict=True):
        found.setdefault(h.as_py(), t.as_py())
    names = sorted(found)
    return names, [found[h] for h in names]


def _cut(keys: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _deal(buckets: int):
    """A block → for each bucket the block's keys and whether two of its texts hold them."""
    edges = bounds(buckets)

    def run(table: pa.Table) -> pa.Table:
        runs = Runs(_texts(table)[1])
        order = np.lexsort((runs.text, runs.key))
        key, text = runs.key[order], runs.text[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(key))[: len(first)] - 1
        keys, twice = key[first], text[first] != text[last]
        cut = _cut(keys, edges)
        full = [b for b in range(buckets) if cut[b] < cut[b + 1]]
        tidy()
        return pa.table({
            "bucket": pa.array(full, pa.int32()), "block": pa.array([table.column("block")[0].as_py()] * len(full), pa.int32()),
            "keys": pa.array([pack(keys[cut[b] : cut[b + 1]]) for b in full], pa.binary()),
            "twice": pa.array([np.packbits(twice[cut[b] : cut[b + 1]]).tobytes() for b in full], pa.binary()),
        })

    return run


def _shared(table: pa.Table) -> pa.Table:
    """A bucket → for each block those of its keys that another text holds too."""
    keys = [unpack(x.as_py()) for x in table.column("keys")]
    twice = [np.unpackbits(np.frombuffer(x.as_py(), np.uint8))[: len(k)] for x, k in zip(table.column("twice"), keys, strict=True)]
    _, back, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    count[back[np.concatenate(twice) > 0]] = 2
    cut = np.cumsum([0, *map(len, keys)])
    sent = [k[count[back[a:b]] > 1] for k, a, b in zip(keys, cut[:-1], cut[1:], strict=True)]
    return pa.table({"block": table.column("block"), "keys": pa.array(map(pack, sent), pa.binary())})


_PIECES = "bucket int, block int, keys binary, sizes binary, ids binary, bytes binary, about binary"


def _send(buckets: int):
    """A block with its shared keys → for each bucket the distinct pieces of text under its keys.

    A piece is sent once for a block, with the smallest doc_id that holds it.
    What is needed to apply the answers stays in a row about the block.
    """
    edges = bounds(buckets)

    def run(table: pa.Table, known: pa.Table) -> pa.Table:
        names, texts = _texts(table)
        number = (table if len(table) else known).column("block")[0].as_py()
        owner = {h.as_py(): (_NEVER if i.as_py() is None else i.as_py()) for h, i in zip(known.column("h"), known.column("first_id"), strict=True) if h.as_py() is not None}
        ids = np.array([owner[h] for h in names], np.int64)
        runs = Runs(texts)
        shared = np.unique(np.concatenate([np.zeros(0, np.uint64), *(unpack(k.as_py()) for k in known.column("keys") if k.as_py() is not None)]))
        mine = np.flatnonzero(np.isin(runs.key, shared))
        mine = mine[np.argsort(runs.key[mine], kind="stable")]
        data, start, windows = runs.data, runs.start[mine], runs.windows[mine]
        piece: dict[bytes, int] = {}
        which = np.fromiter((piece.setdefault(data[a:b], len(piece)) for a, b in zip(start.tolist(), (start + windows + LENGTH - 1).tolist(), strict=True)), np.int64, len(mine))
        least = np.full(len(piece), _NEVER)
        np.minimum.at(least, which, ids[runs.text[mine]])
        first = np.zeros(len(piece), np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
        keys, sizes, pieces = runs.key[mine][first], np.array([len(p) for p in piece], np.uint32), list(piece)
        cut = _cut(keys, edges)
        full = [b for b in range(buckets) if cut[b] < cut[b + 1]]
        about = ids.tobytes() + b"".join(np.ascontiguousarray(x.astype(np.uint32)).tobytes() for x in (runs.text[mine], start - runs.text_at[runs.text[mine]], windows, which))
        parts = [slice(cut[b], cut[b + 1]) for b in full]
        tidy()
        return pa.table({
            "bucket": pa.array([*full, -1 - number % buckets], pa.int32()), "block": pa.array([number] * (len(full) + 1), pa.int32()),
            "keys": pa.array([*(pack(keys[p]) for p in parts), None], pa.binary()), "sizes": pa.array([*(sizes[p].tobytes() for p in parts), None], pa.binary()),
            "ids": pa.array([*(least[p].tobytes() for p in parts), None], pa.binary()), "bytes": pa.array([*(b"".join(pieces[p]) for p in parts), None], pa.binary()),
            "about": pa.array([None] * len(full) + [about], pa.binary()),
        })

    return run


def _candidates(text: np.ndarray, at: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What of the pieces may repeat: place, number of windows, group and first window of each stretch.

    A stretch is neighbouring windows of one piece whose 50-byte hash some other
    window of the group has too. Equal windows have equal hashes, so nothing
    that repeats is lost, and the suffix array decides what does.
    """
    windows = size - LENGTH + 1
    slot = np.cumsum(windows) - windows
    several = np.flatnonzero(np.bincount(group)[group] > 1)
    where, owner = ragged(at[several], windows[several]), np.repeat(several, windows[several])
    padded = np.append(text, np.zeros(8, np.uint8))
    words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    h = mixed(group[owner].astype(np.uint64) * _ODD)
    for step in (0, 8, 16, 24, 32, 40, LENGTH - 8):
        h = mixed(h ^ words[where + step])
    _, back, count = np.unique(h, return_inverse=True, return_counts=True)
    twice = count[back] > 1
    new = twice.copy()
    new[1:] &= ~twice[:-1] | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    number = np.add.reduceat(twice, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
    return where[first], number, group[owner[first]], ragged(slot[several], windows[several])[first]


def _earliest(text: np.ndarray, at: np.ndarray, size: np.ndarray, ids: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each window of distinct pieces the smallest id of a piece of its group that holds it.

    ``at`` and ``size`` place the pieces, which come group by group, in
    ``text``. The distinct stretches of a group that may repeat are one text, with
    a separator behind each; in its suffix array equal windows are neighbours.
    """
    least = np.repeat(ids, size - LENGTH + 1)
    at, windows, group, slot = _candidates(text, at, size, group)
    # equal stretches are one; their windows have one key, so they are in one group
    data, stretch = text.tobytes(), {}
    which = np.fromiter((stretch.setdefault(data[a:b], len(stretch)) for a, b in zip(at.tolist(), (at + windows + LENGTH - 1).tolist(), strict=True)), np.int64, len(at))
    first = np.zeros(len(stretch), np.int64)
    first[which[::-1]] = np.arange(len(which))[::-1]
    low = np.full(len(stretch), _NEVER)
    np.minimum.at(low, which, least[slot])
    found = np.repeat(low, windows[first])
    begin = np.cumsum(windows[first]) - windows[first]
    several = np.flatnonzero(np.bincount(group[first])[group[first]] > 1) if len(first) else first
    if len(several):
        own = first[several]
        _sorted_minimum(text, at[own], windows[own], group[own], begin[several], found)
    least[ragged(slot, windows)] = found[ragged(begin[which], windows)]
    return least


def _sorted_minimum(text: np.ndarray, at: np.ndarray, windows: np.ndarray, group: np.ndarray, slot: np.ndarray, least: np.ndarray) -> None:
    """Lowers ``least`` of each window to the smallest of the equal windows of its group, which a suffix array finds.

    ``slot`` is the place of a stretch's first window in ``least``.
    """
    size = windows + LENGTH - 1
    place = np.concatenate([[0], np.cumsum(size + 1)])
    joined = np.zeros(place[-1], np.int16)
    joined[ragged(place[:-1], size)] = text[ragged(at, size)].astype(np.int16) + 1
    borders = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    start = np.append(place[borders], place[-1])
    order = sorted_suffixes(joined, start)
    # the window that begins at each symbol, if one does
    window = np.full(len(joined), -1)
    window[ragged(place[:-1], windows)] = ragged(slot, windows)
    origin = np.zeros(len(joined), np.int64)
    origin[ragged(place[:-1], size)] = ragged(at, size)
    home = np.repeat(np.arange(len(borders)), np.diff(start))
    order = order[window[order] >= 0]
    padded = np.append(text, np.zeros(8, np.uint8))
    words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    where, same = origin[order], home[order][1:] == home[order][:-1]
    for step in (0, 8, 16, 24, 32, 40, LENGTH - 8):
        w = words[where + step]
        same &= w[1:] == w[:-1]
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    found = least[window[order]]
    least[window[order]] = np.repeat(np.minimum.reduceat(found, first), np.diff(np.append(first, len(found))))


def _resolve(table: pa.Table) -> pa.Table:
    """A bucket → for each block and each piece it sent, the smallest doc_id for each window."""
    if table.column("bucket")[0].as_py() < 0:
        return pa.table([table.column("bucket"), table.column("block"), pa.array([None] * len(table), pa.binary()), table.column("about")], names=["bucket", "block", "ids", "about"])
    keys = [unpack(x.as_py()) for x in table.column("keys")]
    sizes = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table.column("sizes")]).astype(np.int64)
    ids = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column("ids")])
    data = b"".join(x.as_py() for x in table.column("bytes"))
    key, at = np.concatenate(keys), np.concatenate([[0], np.cumsum(sizes)])
    piece: dict[bytes, int] = {}
    which = np.fromiter((piece.setdefault(data[a:b], len(piece)) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)), np.int64, len(sizes))
    first = np.zeros(len(piece), np.int64)
    first[which[::-1]] = np.arange(len(which))[::-1]
    least = np.full(len(piece), _NEVER)
    np.minimum.at(least, which, ids)
    # distinct pieces, group by group
    order = np.argsort(key[first], kind="stable")
    one = key[first][order]
    group = np.cumsum(np.concatenate([[False], one[1:] != one[:-1]]))
    size, text = sizes[first][order], np.frombuffer(data, np.uint8)
    # some groups at a time
    ends = np.flatnonzero(np.append(group[1:] != group[:-1], True)) + 1
    steps = [0, *ends[np.flatnonzero(np.diff(np.cumsum(size)[ends - 1] // SYMBOLS))].tolist(), len(group)]
    at = at[first][order]
    found = np.concatenate([_earliest(text, at[a:b], size[a:b], least[order][a:b], group[a:b] - group[a]) for a, b in zip(steps[:-1], steps[1:], strict=True) if a < b])
    slot = np.concatenate([[0], np.cumsum(size - LENGTH + 1)])
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    mine = back[which]
    cut = np.cumsum([0, *map(len, keys)])
    sent = [pack_runs(found[ragged(slot[mine[a:b]], sizes[a:b] - LENGTH + 1)]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    tidy()
    return pa.table([table.column("bucket"), table.column("block"), pa.array(sent, pa.binary()), pa.array([None] * len(keys), pa.binary())], names=["bucket", "block", "ids", "about"])


def _apply(table: pa.Table, answers: pa.Table) -> pa.Table:
    """A block with its answers → first holder, spans to remove and remaining bytes of each distinct text."""
    return _removed(table, answers, "kept")


def _apply_to_text(table: pa.Table, answers: pa.Table) -> pa.Table:
    """``_apply`` with what is left as text: a character that lost a byte goes whole."""
    return _removed(table, answers, "kept_text")


def _removed(table: pa.Table, answers: pa.Table, form: str) -> pa.Table:
    names, texts = _texts(table)
    about = next(x.as_py() for x in answers.column("about") if x.as_py() is not None)
    ids = np.frombuffer(about[: 8 * len(names)], np.int64)
    text, start, windows, which = np.frombuffer(about[8 * len(names) :], np.uint32).astype(np.int64).reshape(4, -1)
    sent = sorted((b.as_py(), x.as_py()) for b, x in zip(answers.column("bucket"), answers.column("ids"), strict=True) if x.as_py() is not None)
    least = np.concatenate([np.zeros(0, np.int64), *(unpack_runs(x) for _, x in sent)])
    size = np.array([len(t) for t in texts], np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    of_piece = np.zeros(which.max() + 1 if len(which) else 0, np.int64)
    of_piece[which] = windows
    slot = np.concatenate([[0], np.cumsum(of_piece)])
    hit = least[ragged(slot[which], windows)] < np.repeat(ids[text], windows)
    where = np.sort(ragged(at[text] + start, windows)[hit])
    del hit, least
    owner = np.searchsorted(at, where, "right") - 1
    # windows that overlap or touch in one text are one span
    first = np.flatnonzero(np.concatenate([[True], (where[1:] > where[:-1] + LENGTH) | (owner[1:] != owner[:-1])])) if len(where) else where
    last = np.append(first[1:], len(where))[: len(first)] - 1
    owner = owner[first]
    begin, end = where[first] - at[owner], where[last] + LENGTH - at[owner]
    offsets = np.searchsorted(owner, np.arange(len(names) + 1))
    cut = _without if form == "kept" else _without_characters
    kept = pa.array((cut(t, begin[a:b].tolist(), end[a:b].tolist()) for t, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True)), pa.binary())
    spans = pa.StructArray.from_arrays([pa.array(begin), pa.array(end)], ["start", "end"])
    tidy()
    return pa.table({
        "h": pa.array(names, pa.string()), "first_id": pa.array(ids, mask=ids == _NEVER), "spans": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans),
        form: kept.cast(pa.string()) if form == "kept_text" else kept,
    })


def _without(text: bytes, begin: list[int], end: list[int]) -> bytes:
    if not begin:
        return text
    return b"".join(text[a:b] for a, b in zip([0, *end], [*begin, len(text)], strict=True))


def _without_characters(text: bytes, begin: list[int], end: list[int]) -> bytes:
    """Without the spans and what is left of characters that they cut."""
    out, at = [], 0
    for a, b in zip(begin, end, strict=True):
        while a > at and text[a] & 0xC0 == 0x80:
            a -= 1
        while b < len(text) and text[b] & 0xC0 == 0x80:
            b += 1
        out.append(text[at:a])
        at = max(at, b)
    return b"".join([*out, text[at:]])


def _each_once(blocks: int):
    """Texts by fingerprint; a task sends a text that it has sent before not again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows: list[tuple[int, str, bytes]] = []
                for t in batch.column(0).slice(at, 1000):
                    data = (t.as_py() or "").encode()
                    h = hashlib.md5(data).digest()
                    if h not in seen:
                        seen.add(h)
                        rows.append((int.from_bytes(h[:4], "big") % blocks, h.hex(), data))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.binary())], names=["block", "h", "text"])

    return run


def repeated_strings(docs: DataFrame, form: str = "kept") -> tuple[DataFrame, DataFrame]:
    """What to remove from the texts of ``doc_id, text``, by distinct text.

    The first table has ``doc_id, h, n_bytes`` for each row, the second for
    each distinct text ``h`` the smallest id that holds it, ``spans`` (start
    and end in bytes) to remove there, and what is left: in the ``form``
    ``kept`` as bytes, in ``kept_text`` without characters that lost a byte.

    1. Equal texts are one text from the start.
    2. Every 50-byte window has a key, the least hash of its 16-byte grams. Keys
       are dealt by hash and those of one text only are dropped.
    3. For the other keys the pieces of text whose windows have that key meet,
       equal pieces once for each block. Of a key's distinct pieces the stretches
       whose windows have a hash twice go into a suffix array, built by linear
       grouping; it puts equal windows side by side, and each gets the smallest
       doc_id of all.
    4. Each text removes the windows that a smaller doc_id holds.
    """
    blocks, buckets = (bucket_count(docs.select("doc_id", "text"), b) for b in (BLOCK_BYTES, BUCKET_BYTES))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.encode(text, "UTF-8")).alias("h"), F.octet_length(text).cast("long").alias("n_bytes"))
    texts = docs.select("text").mapInArrow(_each_once(blocks), "block int, h string, text binary").groupBy("block")
    keys = texts.applyInArrow(_deal(buckets), "bucket int, block int, keys binary, twice binary")
    shared = keys.groupBy("bucket").applyInArrow(_shared, "block int, keys binary")
    first = rows.groupBy("h").agg(F.min("doc_id").alias("first_id"))
    first = first.select((F.conv(F.substring("h", 1, 8), 16, 10).cast("long") % blocks).cast("int").alias("block"), F.lit(None).cast("binary").alias("keys"), "h", "first_id")
    known = shared.select("block", "keys", F.lit(None).cast("string").alias("h"), F.lit(None).cast("long").alias("first_id")).unionByName(first)
    pieces = texts.cogroup(known.groupBy("block")).applyInArrow(_send(buckets), _PIECES)
    # sorting takes long for its bytes: as many tasks as buckets, whatever their size
    answers = pieces.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_resolve, "bucket int, block int, ids binary, about binary")
    done = texts.cogroup(answers.groupBy("block")).applyInArrow(_apply if form == "kept" else _apply_to_text, f"h string, first_id long, spans array<struct<start:bigint,end:bigint>>, {form} {'binary' if form == 'kept' else 'string'}")
    return rows, done


def dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, h, n_bytes, n_removed, n_spans, kept`` for each row of ``doc_id, text``.

    Each byte is removed that is covered by a 50-byte string which also starts
    in a document with a smaller doc_id. Overlaps count, strings are those of
    the input, and no string crosses documents. ``kept`` is the rest as bytes.

    Null text counts as empty. A null doc_id is greater than every other.
    Rows with the same doc_id take nothing from each other. Extra columns are
    left out. No rows, no rows.
    """
    rows, done = repeated_strings(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    done = done.select("h", "first_id", "kept", removed.alias("_removed"), F.size("spans").cast("long").alias("_spans"))
    return _by_row(rows, done, "kept")


def _by_row(rows: DataFrame, done: DataFrame, *kept: str) -> DataFrame:
    """A row that is not the first with its text loses all of it, if it is long enough."""
    copy = ~F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("n_bytes") >= LENGTH)
    return rows.join(done, "h").select(
        "doc_id", "h", "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(F.col("_removed")).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.col("_spans")).alias("n_spans"), *(F.when(copy, F.lit("") if k == "kept_sha256" else F.lit(b"")).otherwise(F.col(k)).alias(k) for k in kept),
    )


def digests(docs: DataFrame) -> DataFrame:
    """``dedup`` with the SHA-256 of what is kept in place of the bytes themselves."""
    rows, done = repeated_strings(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    done = done.select("h", "first_id", F.sha2("kept", 256).alias("kept_sha256"), removed.alias("_removed"), F.size("spans").cast("long").alias("_spans"))
    out = _by_row(rows, done, "kept_sha256")
    return out.withColumn("kept_sha256", F.when(F.col("kept_sha256") == "", F.sha2(F.lit(b""), 256)).otherwise(F.col("kept_sha256"))).drop("h")


def cleaned(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with what ``dedup`` keeps of their texts; rows that lose all of it go.

    Rows with empty or null text stay as they are. The texts themselves do not
    go through the join with what is left of them.
    """
    _, done = repeated_strings(docs, "kept_text")
    done = done.select(F.col("h").alias("_h"), F.col("first_id").alias("_first"), F.col("kept_text").alias("_text"))
    text, others = F.coalesce("text", F.lit("")), [c for c in docs.columns if c != "text"]
    rows = docs.select(
        F.struct(*others).alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.md5(F.encode(text, "UTF-8")).alias("_h"),
        (F.octet_length(text) >= LENGTH).alias("_long"), (text == "").alias("_empty"), F.isnull("text").alias("_null"),
    ).join(done, "_h")
    left = F.when(F.col("_long") & ~F.col("_id").eqNullSafe(F.col("_first")), F.lit("")).otherwise(F.col("_text"))
    rows = rows.withColumn("_left", left).where((F.col("_left") != "") | F.col("_empty"))
    return rows.select(*(F.when(~F.col("_null"), F.col("_left")).alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns))
