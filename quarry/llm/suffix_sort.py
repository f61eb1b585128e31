"""Suffix array by Lyndon groups, in linear time and without renaming.

The suffixes are first grouped by their longest Lyndon prefix. Groups start as the distinct
symbols and are processed from the greatest to the least. The previous-smaller pointer of a
suffix is the nearest suffix to its left in a group not processed yet; when a group is
processed, the suffixes its members point to are extended by the group's prefix, once for each
member that points to them, and leave their group for new ones just above it. Then one
sweep over the array emits every group in order, following the same pointers.
"""

from __future__ import annotations

from collections import defaultdict


def suffix_array(text: list[int]) -> list[int]:
    """Order of all suffixes of ``text``, whose last symbol is its least and occurs once."""
    n = len(text)
    members: list[list[int]] = []
    below: list[int] = []  # the next lower group
    group = [0] * n
    by_symbol = defaultdict(list)
    for i, c in enumerate(text):
        by_symbol[c].append(i)
    last = -1
    for c in sorted(by_symbol):
        for i in by_symbol[c]:
            group[i] = len(members)
        members.append(by_symbol[c])
        below.append(last)
        last = len(members) - 1
    size = [len(m) for m in members]
    above = [-1] * len(members)
    for g, b in enumerate(below):
        if b >= 0:
            above[b] = g
    done = bytearray(n + 1)  # the last entry, also met as -1, ends a chase
    smaller = [-1] * n  # previous-smaller pointers
    descending = []

    def leave(at: int, js: list[int]) -> int:
        """A new group of ``js`` just above the group ``at``."""
        new, top = len(members), above[at]
        members.append(js)
        size.append(len(js))
        for j in js:
            group[j] = new
        below.append(at)
        above.append(top)
        above[at] = new
        if top >= 0:
            below[top] = new
        return new

    current = last
    while current >= 0:
        own = members[current]
        if len(own) > size[current]:  # some have left
            own = members[current] = [i for i in own if group[i] == current]
        descending.append(current)
        if len(own) == 1:
            i = own[0]
            done[i] = 1
            j = i - 1
            while done[j]:
                j = smaller[j]
            smaller[i] = j
            if j >= 0 and size[g := group[j]] > 1:
                size[g] -= 1
                leave(g, [j])
            current = below[current]
            continue
        own.sort()
        for i in own:
            done[i] = 1
        pointed = []
        for i in own:
            j = i - 1
            while done[j]:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                pointed.append(j)
        if len(pointed) == 1 or len(set(pointed)) == len(pointed):  # each is extended once
            parts: dict[int, list[int]] = {}
            for j in pointed:
                g = group[j]
                if g in parts:
                    parts[g].append(j)
                else:
                    parts[g] = [j]
            for g, js in parts.items():
                if len(js) < size[g]:  # else the whole group is extended alike and stays one
                    size[g] -= len(js)
                    leave(g, js)
            current = below[current]
            continue
        times: dict[int, int] = {}
        for j in pointed:
            times[j] = times.get(j, 0) + 1
        leaving: dict[int, dict[int, list[int]]] = {}
        for j, k in times.items():
            leaving.setdefault(group[j], {}).setdefault(k, []).append(j)
        for g, by_times in leaving.items():
            total = sum(map(len, by_times.values()))
            order = sorted(by_times)
            if total == size[g]:  # nobody stays: the group becomes its lowest part
                members[g] = by_times[order[0]]
                size[g] = len(members[g])
                order = order[1:]
            else:
                size[g] -= total
            at = g
            for k in order:
                at = leave(at, by_times[k])
        current = below[current]
    start, total = [0] * len(members), 0
    for g in reversed(descending):
        start[g] = total
        total += len(members[g])
    order = [-1] * n
    order[0] = n - 1
    placed = bytearray(n + 1)  # the last entry, also met as -1, ends a chase
    placed[n - 1] = placed[n] = 1
    for at in range(n):
        j = order[at] - 1
        while not placed[j]:
            g = group[j]
            order[start[g]] = j
            start[g] += 1
            placed[j] = 1
            j = smaller[j]
    return order
