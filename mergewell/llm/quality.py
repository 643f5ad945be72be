"""Quality rules: base counts, and a line-labelling conditional random field."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergewell.llm.common import seeded

WINDOW = 8
#: Bounds of the training sample: labelled documents of each quality, and lines of one document.
TRAIN_DOCS, TRAIN_LINES = 1500, 2000
#: A document stays if at least this share of its characters is on content lines.
CONTENT_SHARE = 0.5
#: The features of a line, in the order of ``features``.
FEATURES = (
    "any", "words<=2", "words3-5", "words6-10", "words11-20", "words>20", "words>60",
    "symbols2%", "symbols10%", "symbols30%", "digits5%", "digits20%", "bars10%", "bars30%",
    "fresh<75%", "fresh<50%", "fresh<25%", "fresh<10%",
    "ends_sentence", "ends_clause", "ends_quote", "not_lower", "upper_or_wide",
    "mean<3", "mean>8", "mean>14", "seen", "link", "at_sign", "indented", "all_upper",
)
N_FEATURES = len(FEATURES)
_BITS = tuple(1 << k for k in range(N_FEATURES))
SEEN = _BITS[FEATURES.index("seen")]
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(1)) * _ODD
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of 8 words that occur twice or more in the list."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    if len(number) == len(words):
        return 0
    ids = _mixed(ids)
    h = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        h = _mixed(h + ids[k : k + n])
    _, back, count = np.unique(h, return_inverse=True, return_counts=True)
    hit = count[back] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(hit), 1)
    np.add.at(cover, np.flatnonzero(hit) + WINDOW, -1)
    return int((np.cumsum(cover) > 0).sum())


def features(line: bytes, words: list[bytes], seen: bool) -> int:
    """The binary features of a line as bits; lengths are in code points."""
    n, chars = len(words), sum(map(len, words)) if line.isascii() else len(b"".join(words).decode())
    symbols = sum(map(line.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">", b"{", b"}", b"=", b"_")))
    digits = len(line) - len(line.translate(None, b"0123456789"))
    bars = sum(1 for w in words if len(w) == 1 and w in b"|*#-=>")
    fresh, mean = len(set(words)) / n, chars / n
    last, first = words[-1][-1:], words[0][:1]
    on = [
        True, n <= 2, 3 <= n <= 5, 6 <= n <= 10, 11 <= n <= 20, n > 20, n > 60,
        symbols >= 0.02 * chars, symbols >= 0.1 * chars, symbols >= 0.3 * chars,
        digits >= 0.05 * chars, digits >= 0.2 * chars,
        bars >= 0.1 * n, bars >= 0.3 * n,
        n >= 6 and fresh < 0.75, n >= 6 and fresh < 0.5, n >= 6 and fresh < 0.25, n >= 20 and fresh < 0.1,
        last in b".!?", last in b",;:", last in b'"\')', not first.islower(), first.isupper() or first > b"\x7f",
        mean < 3, mean > 8, mean > 14, seen,
        b"http" in line or b"www." in line, b"@" in line, line[:1] in b" \t", line.isupper(),
    ]
    return sum(b for b, x in zip(_BITS, on, strict=True) if x)


def lines_of(data: bytes) -> tuple[list[int], list[int], int]:
    """Feature bits and word bytes of each line with a word, and how many equal an earlier one."""
    seen: set[bytes] = set()
    bits, size, repeats = [], [], 0
    for line in data.split(b"\n"):
        words = line.split()
        if words:
            again = line in seen
            repeats += again
            seen.add(line)
            bits.append(features(line, words, again))
            size.append(sum(map(len, words)))
    return bits, size, repeats


def _unpacked(bits: np.ndarray) -> np.ndarray:
    return ((bits[:, None] >> np.arange(N_FEATURES)) & 1).astype(float)


class Crf:
    """A linear chain over lines with labels 0 (boilerplate) and 1 (content)."""

    def __init__(self, emit: np.ndarray, move: np.ndarray) -> None:
        self.emit, self.move = emit, move

    @classmethod
    def trained(cls, lines: list[np.ndarray], labels: list[np.ndarray], steps: int = 120, rate: float = 0.1, decay: float = 1e-3) -> Crf:
        """Maximum conditional likelihood by forward and backward sums and Adam.

        Documents run side by side, sorted by length, so that each position is
        one array step. Everything is deterministic.
        """
        order = sorted(range(len(lines)), key=lambda k: -len(lines[k]))
        x = [lines[k] for k in order]
        y = [labels[k] for k in order]
        n = np.array([len(a) for a in x])
        alive = [int((n > t).sum()) for t in range(n[0])]
        at = [np.array([a[t] for a in x[: alive[t]]]) for t in range(n[0])]
        start = np.concatenate([[0], np.cumsum(alive)])
        flat = _unpacked(np.concatenate(at))
        gold = np.eye(2)[np.concatenate([[b[t] for b in y[: alive[t]]] for t in range(n[0])]).astype(int)]
        moves = np.zeros((2, 2))
        for t in range(1, n[0]):
            p, q = gold[start[t - 1] : start[t - 1] + alive[t]], gold[start[t] : start[t + 1]]
            moves += p.T @ q
        seen = flat.T @ gold
        w = np.zeros((N_FEATURES + 2, 2))
        m, v, total = np.zeros_like(w), np.zeros_like(w), float(len(flat))
        for step in range(1, steps + 1):
            emit, move = w[:-2], w[-2:]
            score, jump = flat @ emit, np.exp(move)
            local = np.exp(score - score.max(1, keepdims=True))
            forward, scale = [local[: alive[0]]], []
            for t in range(n[0]):
                if t:
                    forward.append(forward[-1][: alive[t]] @ jump * local[start[t] : start[t + 1]])
                scale.append(forward[-1].sum(1, keepdims=True))
                forward[-1] = forward[-1] / scale[-1]
            back, expected, pairs = np.ones((alive[-1], 2)), np.zeros_like(flat[:, :2]), np.zeros((2, 2))
            for t in range(n[0] - 1, -1, -1):
                p = forward[t] * back
                expected[start[t] : start[t + 1]] = p / p.sum(1, keepdims=True)
                if t:
                    ahead = local[start[t] : start[t + 1]] * back / scale[t]
                    pairs += forward[t - 1][: alive[t]].T @ ahead * jump
                    back = np.vstack([ahead @ jump.T, np.ones((alive[t - 1] - alive[t], 2))])
            grad = np.vstack([seen - flat.T @ expected, moves - pairs]) / total - decay * w
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            w = w + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return cls(w[:-2], w[-2:])

    def viterbi(self, bits: list[int]) -> list[int]:
        """The most likely labels; of equal ones, content."""
        score = (_unpacked(np.array(bits, np.int64)) @ self.emit).tolist()
        (ab, ac), (cb, cc) = self.move.tolist()
        b, c = score[0]
        back = []
        for eb, ec in score[1:]:
            from_c_b, from_c_c = c + cb >= b + ab, c + cc >= b + ac
            back.append((int(from_c_b), int(from_c_c)))
            b, c = (c + cb if from_c_b else b + ab) + eb, (c + cc if from_c_c else b + ac) + ec
        out = [int(c >= b)]
        for step in reversed(back):
            out.append(step[out[-1]])
        return out[::-1]


def fit(docs: DataFrame, labels: DataFrame, seed: int = 3) -> Crf | None:
    """Trains on at most ``TRAIN_DOCS`` labelled documents of each quality.

    They are the first in a seeded order of ids, so the sample is bounded at
    any size of the corpus; only feature bits of their lines reach the driver,
    and documents of over ``TRAIN_LINES`` lines are left out of the sample.
    Lines of good documents count as content unless they repeat an earlier
    line, lines of bad ones as boilerplate. None if one quality has no line.
    """
    both = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_good"))
    rank = seeded(seed, F.col("doc_id"))
    picked = both.where("_good = 1").orderBy(rank).limit(TRAIN_DOCS).unionByName(both.where("_good = 0").orderBy(rank).limit(TRAIN_DOCS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(g, lines_of((t or "").encode())[0]) for g, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            rows = [r for r in rows if 0 < len(r[1]) <= TRAIN_LINES]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))], names=["good", "bits"])

    # the bound on the sample is the bound on what is broadcast
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(F.col("_good").cast("int"), "text")
    rows = sorted((r.good, list(r.bits)) for r in sample.mapInArrow(run, "good int, bits array<bigint>").collect())
    if len({g for g, _ in rows}) < 2:
        return None
    return Crf.trained([np.array(b, np.int64) for _, b in rows], [np.array([int(g and not x & SEEN) for x in b]) for g, b in rows])


def judge(docs: DataFrame, model: Crf | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Counts and verdict for each row of ``doc_id, text``; ``keep`` columns follow.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long),
    ``base_failed`` (under 20 words, or over 30 % of them in repeated windows
    of 8), ``content_share`` (of the bytes of words, on lines that the field
    marks as content) and ``kept``: not ``base_failed`` and a content share of
    ``CONTENT_SHARE`` or more. Without a model every line is content. Null or
    empty text: no words, failed. Rows are judged where they are read, without
    a shuffle; repeated rows each get their own verdict; no rows, no rows.
    """

    def verdict(text: str | None) -> tuple:
        data = (text or "").encode()
        words = data.split()
        bits, size, repeats = lines_of(data)
        word_chars = len(text or "") - (len(data) - sum(map(len, words)))
        again = repeated_words(words)
        failed = len(words) < 20 or 100 * again > 30 * len(words)
        share = 1.0 if model is None else sum(s for s, y in zip(size, model.viterbi(bits), strict=True) if y) / sum(size) if bits else 0.0
        return len(words), word_chars, sum(map(data.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))), repeats, again, failed, share, not failed and share >= CONTENT_SHARE

    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = list(zip(*(verdict(part.column(1)[k].as_py()) for k in range(part.num_rows)), strict=True))
                columns = [part.column(0), *(part.column(k) for k in range(2, part.num_columns)), *(pa.array(x, kind) for x, kind in zip(found, kinds, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *keep_names, *names])

    keep_names = [f"_keep_{c}" for c in keep]
    rows = docs.select("doc_id", "text", *(F.col(c).alias(f"_keep_{c}") for c in keep))
    schema = ", ".join([f"doc_id {docs.schema['doc_id'].dataType.simpleString()}", *(f"{n} {rows.schema[n].dataType.simpleString()}" for n in keep_names), *(f"{n} {k}" for n, k in zip(names, ["bigint"] * 5 + ["boolean", "double", "boolean"], strict=True))])
    out = rows.mapInArrow(run, schema)
    return out.select("doc_id", *names, *(F.col(f"_keep_{c}").alias(c) for c in keep))
