"""Suffix orders of many short texts at once, by linear grouping.

First the suffixes of a text are grouped by their Lyndon prefixes. Groups begin
as the suffixes of one first symbol and are taken in descending order; each
member of the group taken points at the nearest position before it that is in a
smaller group, and what is pointed at leaves its own group for a new one right
after it, the higher the more members point there. Then the order is given out
from the smallest suffix on: one that has its place hands the next free place of
their groups to the position before it and to those that this points at. No
suffix is compared with another and no names are made.

A numpy step does this for all texts at the same time, each with a group (or a
suffix) of its own, so the number of steps is that of the longest text.
"""

from __future__ import annotations

import numpy as np


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start .. start + size - 1 of each range, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def grouped(symbols: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position the place where the group of its Lyndon prefix begins, and the position that it points at (none: -1)."""
    n = len(symbols)
    text = np.repeat(np.arange(len(sizes)), sizes)
    key = text * (int(symbols.max()) + 1) + symbols
    order = np.argsort(key, kind="stable").astype(np.int32)
    begins = np.flatnonzero(np.diff(key[order], prepend=-1))
    del text, key
    place = np.empty(n, np.int32)
    place[order] = np.arange(n)
    size_at = np.zeros(n, np.int32)
    size_at[begins] = np.diff(begins, append=n)
    group = np.empty(n, np.int32)
    group[order] = np.repeat(begins, size_at[begins])
    before = np.arange(-1, n - 1, dtype=np.int32)
    before[firsts] = -1
    marked = np.zeros(n, bool)

    first, last = firsts, firsts + sizes - 1  # of the texts that have groups left; the end symbol's group needs no step
    while True:
        more = last > first
        first, last = first[more], last[more]
        if not len(first):
            return group, before
        begin = group[order[last]]
        count = last - begin + 1
        member = order[ragged(begin, count)]
        own = np.repeat(begin, count)
        last = begin - 1

        left = before[member]
        open_, at = np.flatnonzero(left >= 0), left
        while len(open_):
            open_ = open_[group[at[open_]] >= own[open_]]
            at[open_] = before[at[open_]]
            before[member[open_]] = at[open_]
            open_ = open_[at[open_] >= 0]

        target, times = np.unique(at[at >= 0], return_counts=True)
        if not len(target):
            continue
        from_ = group[target]
        sort = np.lexsort((times, from_))
        target, times, from_ = target[sort], times[sort], from_[sort]
        new_from = np.diff(from_, prepend=-1) != 0
        heads = np.flatnonzero(new_from)
        moved = np.diff(heads, append=len(target))
        zone = from_[heads] + size_at[from_[heads]] - moved  # the last places of the old group
        slot = ragged(zone, moved)
        old = place[target]
        marked[target] = True
        there = order[slot]
        there = there[~marked[there]]
        marked[target] = False
        free = old[old < np.repeat(zone, moved)]
        order[free], place[there] = there, free
        order[slot], place[target] = target, slot
        size_at[from_[heads]] -= moved
        new = np.flatnonzero(new_from | (np.diff(times, prepend=-1) != 0))
        sizes_new = np.diff(new, append=len(target))
        size_at[slot[new]] = sizes_new
        group[target] = np.repeat(slot[new], sizes_new)


def suffix_orders(symbols: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, text by text.

    ``symbols`` holds all texts, each from its ``firsts`` on with its ``sizes``;
    the last symbol of a text is 0, all others are larger.
    """
    group, before = grouped(symbols, firsts, sizes)
    n = len(symbols)
    order = np.empty(n, np.int32)
    order[firsts] = firsts + sizes - 1
    given = np.zeros(n, bool)
    given[firsts + sizes - 1] = True
    free = np.arange(n, dtype=np.int32)  # the next free place of the group that begins here
    by_size = np.argsort(-sizes, kind="stable")
    firsts, sizes = firsts[by_size], sizes[by_size]
    count = len(sizes)
    for step in range(int(sizes[0]) if count else 0):
        while sizes[count - 1] <= step:
            count -= 1
        first = firsts[:count]
        at = order[first + step] - 1
        at = at[at >= first]
        while len(at):
            at = at[~given[at]]
            own = group[at]
            slot = free[own]
            order[slot] = at
            free[own] = slot + 1
            given[at] = True
            at = before[at]
            at = at[at >= 0]
    return order
