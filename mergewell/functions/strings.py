"""Paired string scorers, computed for whole Arrow batches at once.

Each scorer takes two lists of strings and returns an array. The distinct pairs
of a batch are laid out as matrices of code points; a loop runs over positions
in the strings, and each step treats all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Pairs of one matrix; cells of one, so that long strings come in fewer pairs.
PAIRS, CELLS = 4096, 4_000_000
_NO_A, _NO_B = np.uint32(0), np.uint32(0xFFFFFFFF)


def _codes(texts: list[str], pad: np.uint32) -> tuple[np.ndarray, np.ndarray]:
    """Code points plus one, padded on the right, and lengths."""
    size = np.array([len(t) for t in texts])
    width = max(1, int(size.max(initial=0)))
    grid = np.array(texts, f"<U{width}").view(np.uint32).reshape(len(texts), width) + np.uint32(1)
    grid[np.arange(width) >= size[:, None]] = pad
    return grid, size


def _chunks(a: list[str], b: list[str]) -> Iterator[np.ndarray]:
    """Numbers of pairs with similar lengths together."""
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    order = np.lexsort((la, lb))
    at = 0
    while at < len(order):
        n = PAIRS
        while n > 1 and n * (int(la[order[at : at + n]].max()) + 64) * 4 > CELLS:
            n //= 2
        yield order[at : at + n]
        at += n


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of its table as the bits of one number."""
    places: dict[str, int] = {}
    for k, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & places.get(ch, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def lcs(a: list[str], b: list[str]) -> np.ndarray:
    """Lengths of the longest common subsequences; rows of their tables are bits of 64-bit words where the shorter string fits in one."""
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b, strict=True)]
    out = np.zeros(len(pairs), np.int64)
    short = [k for k, (x, _) in enumerate(pairs) if 0 < len(x) <= 64]
    for k, (x, y) in enumerate(pairs):
        if len(x) > 64:
            out[k] = _common(x, y)
    left, right = [pairs[k][0] for k in short], [pairs[k][1] for k in short]
    place = np.array(short, np.int64)
    for part in _chunks(left, right):
        x, nx = _codes([left[k] for k in part], _NO_A)
        y, _ = _codes([right[k] for k in part], _NO_B)
        x = np.pad(x, ((0, 0), (0, 64 - x.shape[1])))
        row = np.full(len(part), ~np.uint64(0))
        for j in range(y.shape[1]):
            bits = np.packbits(x == y[:, j : j + 1], axis=1, bitorder="little").view("<u8").ravel()
            hit = row & bits
            row = (row + hit) | (row - hit)
        full = ~np.uint64(0) >> (64 - nx).astype(np.uint64)
        out[place[part]] = nx - np.bitwise_count(row & full)
    return out


def ratio(a: list[str], b: list[str]) -> np.ndarray:
    """Twice the common subsequence by the lengths; two empty strings are equal."""
    total = np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)])
    return np.where(total > 0, 2 * lcs(a, b) / np.maximum(total, 1), 1.0)


def token_sort(a: list[str], b: list[str]) -> np.ndarray:
    """``ratio`` of the words in order."""
    return ratio(*([" ".join(sorted(x.split())) for x in side] for side in (a, b)))


def token_set(a: list[str], b: list[str]) -> np.ndarray:
    """The best ratio of the shared words, and of them with the rest of either side; 1 if one side has no rest, 0 without words."""
    out, left, right, owner = np.zeros(len(a)), [], [], []
    for k, (x, y) in enumerate(zip(map(str.split, a), map(str.split, b), strict=True)):
        x, y = set(x), set(y)
        shared = " ".join(sorted(x & y))
        if not x or not y or (shared and (x <= y or y <= x)):
            out[k] = float(bool(x) and bool(y))
            continue
        one, two = (" ".join(filter(None, (shared, " ".join(sorted(rest))))) for rest in (x - y, y - x))
        for p, q in ((one, two), (shared, one), (shared, two))[: 3 if shared else 1]:
            left.append(p)
            right.append(q)
            owner.append(k)
    np.maximum.at(out, np.array(owner, np.int64), ratio(left, right))
    return out


def _windows(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each column of y where the strand begins that leaves at its bottom.

    Strands enter a grid of x by y from the left and the top and cross each
    other once at most: where symbols match, or where they have crossed, they
    turn away. The common subsequence of x and y[i:j] is j - i less the strands
    that enter at the top from column i on and leave before column j.
    """
    m, n = x.shape[1], y.shape[1]
    across = [np.full(len(x), m - 1 - k, np.int32) for k in range(m)]
    down = [np.full(len(x), m + k, np.int32) for k in range(n)]
    for i in range(m):
        h = across[i]
        for j in range(n):
            v = down[j]
            turn = (x[:, i] == y[:, j]) | (h > v)
            h, down[j] = np.where(turn, v, h), np.where(turn, h, v)
    return np.stack(down, axis=1) - m


def partial(a: list[str], b: list[str]) -> np.ndarray:
    """The best ratio of the shorter string with a window of the longer one, cut windows at its ends included.

    Of equal lengths either is the shorter. All windows of a pair come from one pass over its grid.
    """
    pairs = [(k, *sorted((x, y), key=len)) for k, (x, y) in enumerate(zip(a, b, strict=True))]
    pairs += [(k, y, x) for k, x, y in pairs if len(x) == len(y) and x != y]
    out = np.array([float(not x and not y) for x, y in zip(a, b, strict=True)])
    pairs = [p for p in pairs if p[1]]
    left, right, owner = [p[1] for p in pairs], [p[2] for p in pairs], np.array([p[0] for p in pairs], np.int64)
    for part in _chunks(left, right):
        (x, nx), (y, ny) = _codes([left[k] for k in part], _NO_A), _codes([right[k] for k in part], _NO_B)
        start, best, column = _windows(x, y), np.zeros(len(part)), np.arange(y.shape[1])
        for k in range(1 - int(nx.max()), int(ny.max())):
            i, j = np.maximum(k, 0), np.minimum(k + nx, ny)
            size = j - i
            lost = ((column < j[:, None]) & (start >= np.broadcast_to(i, len(part))[:, None])).sum(1)
            best = np.where((size > 0) & (k > -nx) & (k < ny), np.maximum(best, 2 * (size - lost) / (nx + np.maximum(size, 1))), best)
        np.maximum.at(out, owner[part], best)
    return out


def jaro_winkler(a: list[str], b: list[str]) -> np.ndarray:
    """Jaro similarity, raised by a common prefix of up to four characters if above 0.7."""
    out = np.zeros(len(a))
    for part in _chunks(a, b):
        (x, nx), (y, ny) = _codes([a[k] for k in part], _NO_A), _codes([b[k] for k in part], _NO_B)
        reach = np.maximum(0, np.maximum(nx, ny) // 2 - 1)[:, None]
        column, rows = np.arange(y.shape[1]), np.arange(len(part))
        mine, free = np.zeros(x.shape, bool), np.ones(y.shape, bool)
        for i in range(x.shape[1]):
            can = (y == x[:, i : i + 1]) & free & (np.abs(column - i) <= reach)
            first = can.argmax(1)
            hit = can[rows, first]
            mine[:, i] = hit
            free[rows[hit], first[hit]] = False
        m = mine.sum(1)
        most = max(1, int(m.max(initial=0)))
        p, q = (np.take_along_axis(grid, np.argsort(~on, axis=1, kind="stable"), 1)[:, :most] for grid, on in ((x, mine), (y, ~free)))
        swaps = ((p != q) & (np.arange(most) < m[:, None])).sum(1) // 2
        some = np.maximum(m, 1)
        jaro = np.where(m > 0, (m / np.maximum(nx, 1) + m / np.maximum(ny, 1) + (m - swaps) / some) / 3, 0.0)
        width = min(4, x.shape[1], y.shape[1])
        prefix = np.cumprod(x[:, :width] == y[:, :width], axis=1).sum(1)
        found = np.where(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro), jaro)
        out[part] = np.where((nx == 0) & (ny == 0), 1.0, found)
    return out


SCORERS: dict[str, Callable[[list[str], list[str]], np.ndarray]] = {"ratio": ratio, "token_sort": token_sort, "token_set": token_set, "partial": partial, "jaro_winkler": jaro_winkler}


def score(name: str, a: pd.Series, b: pd.Series) -> pd.Series:
    """A scorer over two columns, each distinct pair of values once; null if either is null."""
    number: dict[tuple[str, str], int] = {}
    which = np.fromiter((-1 if x is None or y is None else number.setdefault((x, y), len(number)) for x, y in zip(a, b, strict=True)), np.int64, len(a))
    found = SCORERS[name]([x for x, _ in number], [y for _, y in number]) if number else np.zeros(0)
    return pd.Series(np.where(which >= 0, np.append(found, np.nan)[which], np.nan)).astype(object).where(which >= 0, None).astype("float64")


def all_scored(plan: tuple[tuple[str, str, str], ...], left: list[Column], right: list[Column], columns: tuple[str, ...]) -> Column:
    """A struct with every score of ``plan`` (name, column, scorer) over ``columns`` of both sides; a row goes to Python once."""

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({name: score(scorer, batch[columns.index(c)], batch[columns.index(c) + len(columns)]) for name, c, scorer in plan})

    return F.pandas_udf(run, ", ".join(f"{name} double" for name, _, _ in plan))(*left, *right)
