"""Strings of a given length that occur more than once, from the Burrows-Wheeler transform of a set of segments."""

from __future__ import annotations

import numpy as np

#: Symbols of a block; three numbers below it fit one sort key.
MOST = 1 << 21


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and its inverse of segments that each end with a 0; a 0 is smaller the earlier it stands.

    Prefix doubling: suffixes that agree on h symbols are told apart by those h symbols further on, all at once.
    """
    n = len(symbols)
    if n >= MOST:
        raise ValueError("the block is too long")
    places = np.arange(n)
    wide = np.concatenate([symbols.astype(np.int64), np.zeros(4, np.int64)])
    key = np.zeros(n, np.int64)
    alive = np.ones(n, bool)
    for k in range(4):
        part = wide[k : k + n]
        key = key << 9 | np.where(alive, part, 0)
        alive &= part > 0
    key = np.sort(key << 21 | places)
    order = key & MOST - 1
    key >>= 21
    new = np.ones(n, bool)
    new[1:] = (key[1:] != key[:-1]) | (key[1:] & 511 == 0)
    rank = np.empty(n, np.int64)
    heads = np.maximum.accumulate(np.where(new, places, 0))
    rank[order] = heads
    size = np.diff(np.append(np.flatnonzero(new), n))
    open_ = order[np.repeat(size, size) > 1]
    h = 4
    while len(open_):
        key = np.sort(rank[open_] << 42 | rank[open_ + h] << 21 | open_)
        spot = key & MOST - 1
        head = key >> 42
        both = key >> 21
        at = np.arange(len(key))
        group = np.ones(len(key), bool)
        group[1:] = head[1:] != head[:-1]
        slot = head + at - np.maximum.accumulate(np.where(group, at, 0))
        new = np.ones(len(key), bool)
        new[1:] = both[1:] != both[:-1]
        order[slot] = spot
        rank[spot] = slot[np.maximum.accumulate(np.where(new, at, 0))]
        size = np.diff(np.append(np.flatnonzero(new), len(key)))
        open_ = spot[np.repeat(size, size) > 1]
        h *= 2
    return order, rank


def spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All places of the intervals, one after the other."""
    sizes = ends - starts
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


def repeated(symbols: np.ndarray, least: int) -> np.ndarray:
    """Which places start a string of ``least`` symbols that starts elsewhere too; segments end with 0, others are not 0.

    Suffixes that agree on l symbols are an interval of the suffix order. Each interval that splits because its suffixes
    differ after l symbols makes those intervals split that lie one symbol to the left, after l + 1 symbols: for two
    neighbours i < j among the suffixes preceded by the same symbol, now in different parts, the suffixes one longer
    differ there. So the common prefixes come out by increasing value, level by level, until ``least``; what then still
    lies together agrees on ``least`` symbols or more. Of the parts of a split all but the largest are looked through,
    so no place is looked at more often than the logarithm of its interval's size.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, bool)
    order, rank = suffix_order(symbols)
    before = np.where(order > 0, symbols[order - 1], 0)
    left = np.where(before > 0, rank[order - 1], -1)
    by_symbol = np.argsort(before.astype(np.uint16), kind="stable")
    same = (before[by_symbol][1:] == before[by_symbol][:-1]) & (before[by_symbol][1:] > 0)
    previous, following = np.full(n, -1), np.full(n, n)
    previous[by_symbol[1:][same]] = by_symbol[:-1][same]
    following[by_symbol[:-1][same]] = by_symbol[1:][same]

    first = symbols[order]
    bound = np.zeros(n + 1, bool)
    bound[n] = True
    start = np.ones(n, bool)
    start[1:] = (first[1:] != first[:-1]) | (first[1:] == 0)
    interval = np.zeros(n, np.int64)
    lows, highs = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    lows[0], highs[0] = 0, n
    used = 1
    bound[0] = True
    new = np.flatnonzero(start)[1:]
    for _ in range(least):
        if not len(new):
            break
        bound[new] = True
        # the parts that the new bounds cut each interval into
        owner = interval[new]
        opens = np.ones(len(new), bool)
        opens[1:] = owner[1:] != owner[:-1]
        firsts = np.flatnonzero(opens)
        counts = np.diff(np.append(firsts, len(new)))
        parts = len(new) + len(firsts)
        part_start = np.empty(parts, np.int64)
        lead = firsts + np.arange(len(firsts))
        inner = np.ones(parts, bool)
        inner[lead] = False
        part_start[lead] = lows[owner[firsts]]
        part_start[inner] = new
        part_owner = np.repeat(owner[firsts], counts + 1)
        part_end = np.append(part_start[1:], 0)
        part_end[np.append(lead[1:], parts) - 1] = highs[owner[firsts]]
        size = part_end - part_start
        # the largest part of each keeps the interval's number
        group = np.repeat(np.arange(len(firsts)), counts + 1)
        largest = np.lexsort((-size, group))[lead]
        moved = np.ones(parts, bool)
        moved[largest] = False
        number = part_owner.copy()
        number[moved] = used + np.arange(int(moved.sum()))
        used += int(moved.sum())
        old_low, old_high = lows[part_owner][moved], highs[part_owner][moved]
        lows[number], highs[number] = part_start, part_end
        looked = spans(part_start[moved], part_end[moved])
        widths = size[moved]
        interval[looked] = np.repeat(number[moved], widths)
        mine = interval[looked]
        prior, later = previous[looked], following[looked]
        split = (prior >= np.repeat(old_low, widths)) & (left[looked] >= 0)
        split[split] = interval[prior[split]] != mine[split]
        behind = later < np.repeat(old_high, widths)
        behind[behind] = interval[later[behind]] != mine[behind]
        found = np.unique(np.concatenate([left[looked[split]], left[later[behind]]]))
        new = found[~bound[found]]
    out = np.zeros(n, bool)
    out[order] = ~(bound[:-1] & bound[1:])
    return out
