"""Suffix arrays by linear grouping, without recursion.

Phase 1 sorts suffixes into groups, at first by their first symbol, at last
by their longest Lyndon prefix. Groups are taken from the highest to the
lowest. For each suffix i of a group, prev(i) is the nearest position before
it that is in a lower group; that suffix's known prefix ends where i begins,
so it grows by the prefix of the group, as often as it is the prev of a
member. Grown suffixes move to the end of their group, those that grew more
often behind those that grew less, as groups of their own. Phase 2 emits each
group's order: suffixes are read in ascending order, and for each one the
position before it, its prev, the prev of that and so on take the next free
places of their groups, up to the first that has its place. No suffix is renamed, nothing recurses.
"""

from __future__ import annotations

from array import array

import numpy as np


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All of start[k], start[k] + 1, ... (size[k] numbers), one after the other."""
    ends = np.cumsum(size)
    out = np.arange(ends[-1] if len(ends) else 0, dtype=start.dtype)
    out += np.repeat((start - (ends - size)).astype(start.dtype), size)
    return out


def suffix_array(text: list[int] | np.ndarray) -> np.ndarray:
    """The suffix array of one text of non-negative symbols; seven numbers of 4 bytes for each symbol."""
    symbols = np.asarray(text)
    n = len(symbols)
    order = np.argsort(symbols, kind="stable").astype(np.int32)
    first = np.flatnonzero(np.concatenate([[True], symbols[order][1:] != symbols[order][:-1]])) if n else np.zeros(0, np.int64)
    numbers = lambda x: array("i", np.ascontiguousarray(x, np.int32).tobytes())
    rank, head, last = np.empty(n, np.int32), np.empty(n, np.int32), np.zeros(n, np.int32)
    rank[order] = np.arange(n)
    head[order] = np.repeat(first, np.diff(np.append(first, n)))
    last[first] = np.append(first[1:], n)[: len(first)] - 1
    sa, place, group, end, prev = numbers(order), numbers(rank), numbers(head), numbers(last), numbers(np.arange(-1, n - 1))
    top = n - 1
    while top >= 0:
        low = group[sa[top]]
        grown: dict[int, int] = {}
        # in the order of positions, so that the prev of a member before is known
        for i in sorted(sa[low : top + 1]) if low < top else (sa[low],):
            p = prev[i]
            while p >= 0 and group[p] >= low:
                p = prev[p]
            prev[i] = p
            if p >= 0:
                grown[p] = grown.get(p, 0) + 1
        top = low - 1
        by: dict[int, list[tuple[int, int]]] = {}
        for p, c in grown.items():
            by.setdefault(group[p], []).append((c, p))
        for h, moved in by.items():
            if len(moved) > 1:
                moved.sort()
            at = end[h]
            end[h] = at - len(moved)
            # from the back: each moved suffix changes places with the one at the end
            for _, p in reversed(moved):
                q, k = sa[at], place[p]
                sa[at], sa[k], place[p], place[q] = p, q, at, k
                at -= 1
            at = end[h] + 1
            last = 0
            for c, p in moved:
                if c != last:
                    last, begin = c, at
                group[p] = begin
                end[begin] = at
                at += 1
    out, free, done = numbers(np.full(n, -1)), numbers(np.arange(n)), bytearray(n)
    for k in range(-1, n if n else -1):
        j = out[k] - 1 if k >= 0 else n - 1
        while j >= 0 and not done[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            done[j] = 1
            j = prev[j]
    return np.frombuffer(out, np.int32)


def suffix_arrays(text: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The suffix arrays of many texts at once: text k is text[start[k]:start[k + 1]].

    The same algorithm; each array step treats the current group of every
    text. Positions are those of the whole array, text after text.
    """
    n, texts = len(text), len(start) - 1
    sizes = np.diff(start)
    # positions take 4 bytes where they fit
    kind = np.int32 if n < 1 << 31 else np.int64
    start, sizes = start.astype(kind), sizes.astype(kind)
    owner = np.repeat(np.arange(texts, dtype=kind), sizes)
    sa = np.lexsort((text, owner)).astype(kind)
    place = np.empty(n, kind)
    place[sa] = np.arange(n, dtype=kind)
    new = np.ones(n, bool)
    new[1:] = (owner[sa[1:]] != owner[sa[:-1]]) | (text[sa[1:]] != text[sa[:-1]])
    first = np.flatnonzero(new)
    group, end = np.empty(n, kind), np.empty(n, kind)
    group[sa] = np.repeat(first, np.diff(np.append(first, n)))
    end[first] = np.append(first[1:], n) - 1
    del owner, new
    prev = np.arange(-1, n - 1, dtype=kind)
    prev[start[:-1][sizes > 0]] = -1
    moving = np.zeros(n, bool)
    live = np.flatnonzero(sizes > 0)
    top = start[1:] - 1
    while len(live):
        high = top[live]
        low = group[sa[high]]
        size = high - low + 1
        members = sa[ragged(low, size)]
        level = np.repeat(low, size)
        p = prev[members]
        check = np.flatnonzero(p >= 0)
        check = check[group[p[check]] >= level[check]]
        while len(check):
            p[check] = prev[p[check]]
            prev[members[check]] = p[check]
            check = check[p[check] >= 0]
            check = check[group[p[check]] >= level[check]]
        top[live] = low - 1
        live = live[top[live] >= start[live]]
        grown = np.sort(p[p >= 0])
        if not len(grown):
            continue
        edge = np.flatnonzero(np.concatenate([[True], grown[1:] != grown[:-1]]))
        count = np.diff(np.append(edge, len(grown)))
        grown = grown[edge]
        home = group[grown]
        order = np.lexsort((count, home))
        grown, count, home = grown[order], count[order], home[order]
        change = np.concatenate([[True], home[1:] != home[:-1]])
        begin = np.flatnonzero(change)
        moved = np.diff(np.append(begin, len(home)))
        tail = end[home[begin]] - moved + 1
        to = ragged(tail, moved)
        # who is at the end and stays changes places with who leaves the front
        moving[grown] = True
        there = sa[to]
        there = there[~moving[there]]
        here = place[grown]
        here = here[here < np.repeat(tail, moved)]
        sa[here], place[there] = there, here
        sa[to], place[grown] = grown, to
        moving[grown] = False
        end[home[begin]] = tail - 1
        change[1:] |= count[1:] != count[:-1]
        begin = np.flatnonzero(change)
        head = to[begin]
        group[grown] = np.repeat(head, np.diff(np.append(begin, len(to))))
        end[head] = to[np.append(begin[1:], len(to)) - 1]
    out, free, done = np.full(n, -1, kind), np.arange(n, dtype=kind), np.zeros(n, bool)
    floor, ceiling = start[:-1], start[1:]
    live = np.flatnonzero(sizes > 0)
    at = start[:-1] - 1
    j = ceiling[live] - 1
    while len(live):
        go = j >= floor[live]
        j = j[go]
        j = j[~done[j]]
        while len(j):
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            done[j] = True
            j = prev[j]
            j = j[j >= 0]
            j = j[~done[j]]
        at[live] += 1
        live = live[at[live] < ceiling[live]]
        j = out[at[live]] - 1
    return out


#: Texts longer than this are sorted one by one.
ALONE = 6000


def sorted_suffixes(text: np.ndarray, start: np.ndarray, together: int = 400_000) -> np.ndarray:
    """``suffix_arrays`` in batches of similar sizes; long texts go through ``suffix_array``."""
    sizes = np.diff(start)
    out = np.empty(len(text), np.int64)
    order = np.argsort(sizes, kind="stable")
    for k in order[sizes[order] > ALONE].tolist():
        a, b = start[k], start[k + 1]
        out[a:b] = suffix_array(text[a:b]) + np.int64(a)
    order = order[sizes[order] <= ALONE]
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes[order]) // together)) + 1
    for part in np.split(order, cuts) if len(order) else ():
        where = ragged(start[part], sizes[part])
        own = np.concatenate([[0], np.cumsum(sizes[part])])
        out[where] = where[suffix_arrays(text[where], own)]
    return out
