"""Suffix arrays by grouping Lyndon prefixes, in linear time and without recursion or renaming.

Every suffix starts with a longest Lyndon word.  The first phase sorts the suffixes into groups of equal words.  Groups are
taken from the highest down; each suffix of a group looks up its previous smaller suffix by following the pointers found so
far, and those predecessors move up within their own groups, the further the more followers of this group they have.  The
second phase goes through the suffixes in ascending order and puts those whose word ends where a suffix begins at the front
of their groups.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Start positions of all suffixes in lexicographic order; an end of text is below every symbol."""
    n = len(text)
    counts: dict[int, int] = {}
    for symbol in text:
        counts[symbol] = counts.get(symbol, 0) + 1
    free, at = {}, 0
    for symbol in sorted(counts):
        free[symbol] = at
        at += counts[symbol]
    begin = dict(free)
    start = [begin[symbol] for symbol in text]  # where the group of each suffix begins
    order, place = [0] * n, [0] * n
    for suffix, symbol in enumerate(text):
        order[free[symbol]] = suffix
        place[suffix] = free[symbol]
        free[symbol] += 1
    end_of = {begin[s]: free[s] for s in counts}  # group begin -> end, of groups not yet taken
    before = list(range(-1, n - 1))

    end = n
    while end:
        first = start[order[end - 1]]
        followers: dict[int, int] = {}
        for suffix in order[first:end]:
            p = before[suffix]
            while p >= 0 and start[p] >= first:
                p = before[p]
            before[suffix] = p
            if p >= 0:
                followers[p] = followers.get(p, 0) + 1
        if followers:
            levels: dict[int, list[int]] = {}
            for p, k in followers.items():
                if k in levels:
                    levels[k].append(p)
                else:
                    levels[k] = [p]
            for k in sorted(levels, reverse=True):
                # To the back of their groups; a suffix that moved for a larger k lies beyond the group's end already.
                grown: dict[int, int] = {}
                for p in levels[k]:
                    group = start[p]
                    back = end_of[group] - 1
                    end_of[group] = back
                    other, here = order[back], place[p]
                    order[here], place[other] = other, here
                    order[back], place[p] = p, back
                    grown[group] = grown.get(group, 0) + 1
                for p in levels[k]:
                    group = start[p]
                    if group in grown:
                        size = grown.pop(group)
                        new = end_of[group]
                        end_of[new] = new + size
                        for moved in order[new : new + size]:
                            start[moved] = new
        end = first

    ready, fill = [False] * n, list(range(n))  # the next place in the group that begins here
    for i in range(-1, n):
        p = n - 1 if i < 0 else order[i] - 1
        while p >= 0 and not ready[p]:
            ready[p] = True
            group = start[p]
            order[fill[group]] = p
            fill[group] += 1
            p = before[p]
    return order
