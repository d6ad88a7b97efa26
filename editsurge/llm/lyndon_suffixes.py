"""Suffix array of an integer string by linear grouping of Lyndon prefixes.

Phase 1 puts suffixes into groups by their first symbol and takes the groups in
descending order.  For each suffix of a group the previous-smaller pointer names the
nearest suffix to its left that is in a lower group; the suffixes so named are
refined: those that are followed by more copies of the group's prefix move into a
higher new group right after their old one.  In the end a group holds exactly the
suffixes with one Lyndon prefix, and groups are in lexicographic order.

Phase 2 walks the suffix array from the least suffix and emits every group's order
directly: the suffix before a placed one, and those along its pointers, take the
next free places of their groups.  Nothing is renamed and there is no recursion.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix array of non-negative integers (a shorter suffix that is a prefix is smaller)."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    begin = np.flatnonzero(new)
    group_begin = np.repeat(begin, np.diff(np.append(begin, n)))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    group_of = np.empty(n, np.int64)
    group_of[order] = group_begin
    size_at = np.zeros(n + 1, np.int64)
    size_at[begin] = np.diff(np.append(begin, n))

    at, place, group, size = order.tolist(), place.tolist(), group_of.tolist(), size_at.tolist()
    before = [-1] * n                       # previous-smaller pointers
    end = n
    while end > 0:
        start = group[at[end - 1]]
        members = at[start:end] if end - start == 1 else sorted(at[start:end])
        followers: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = before[j]
            before[i] = j
            if j >= 0:
                followers[j] = followers.get(j, 0) + 1
        if followers:
            most = max(followers.values())
            if most == 1:
                _refine(followers, at, place, group, size)
            else:
                by_count: dict[int, list[int]] = {}
                for j, c in followers.items():
                    by_count.setdefault(c, []).append(j)
                for c in sorted(by_count, reverse=True):
                    _refine(by_count[c], at, place, group, size)
        end = start

    # phase 2: the end of the string is the least suffix of all
    free = group
    head = list(range(n))                   # next free place of the group that starts here
    out, done = [-1] * n, bytearray(n)
    j = n - 1
    while j >= 0:
        if not done[j]:
            g = free[j]
            out[head[g]] = j
            head[g] += 1
            done[j] = 1
        j = before[j]
    for r in range(n):
        j = out[r] - 1
        while j >= 0 and not done[j]:
            g = free[j]
            out[head[g]] = j
            head[g] += 1
            done[j] = 1
            j = before[j]
    return np.array(out, np.int64)


def _refine(chosen, at, place, group, size) -> None:
    """Move the chosen suffixes of each group into a new group right after it."""
    moved: dict[int, list[int]] = {}
    for j in chosen:
        g = group[j]
        last = g + size[g] - 1
        k, p = at[last], place[j]
        if k != j:
            at[p], at[last] = k, j
            place[k], place[j] = p, last
        size[g] -= 1
        if g in moved:
            moved[g].append(j)
        else:
            moved[g] = [j]
    for g, js in moved.items():
        fresh = g + size[g]
        size[fresh] = len(js)
        if fresh != g:
            for j in js:
                group[j] = fresh


def common_prefixes(symbols: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Symbols that each suffix shares with its predecessor in the suffix array (0 for the first)."""
    n = len(symbols)
    s, sa = symbols.tolist(), order.tolist()
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    rank = rank.tolist()
    out, h = [0] * n, 0
    for i in range(n):
        r = rank[i]
        if r:
            j = sa[r - 1]
            while i + h < n and j + h < n and s[i + h] == s[j + h]:
                h += 1
            out[r] = h
            if h:
                h -= 1
        else:
            h = 0
    return np.array(out, np.int64)
