"""Suffix arrays by linear grouping.

The first phase sorts suffixes into groups that share their longest Lyndon prefix.  It starts from
groups by first symbol and takes groups in descending order: each suffix of the group finds the
nearest earlier suffix of a smaller group (its previous-smaller pointer), and the suffixes so found
move, by how many of the group they carry, into new groups just above their old ones.  The second
phase walks the array from the smallest suffix: the suffix before each placed one, and those along
its pointers, are the next of their groups.  No names are assigned anew and nothing recurs.
"""

from __future__ import annotations


def suffix_array(symbols: list[int]) -> list[int]:
    """Start positions of the suffixes in order; symbols are non-negative integers."""
    n = len(symbols) + 1
    text = [s + 1 for s in symbols]
    text.append(0)  # smaller than all and met once
    order = sorted(range(n), key=text.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    start = 0
    for rank, i in enumerate(order):
        if rank and text[i] != text[order[rank - 1]]:
            start = rank
        place[i], group[i] = rank, start
        size[start] += 1
    smaller = [-1] * n
    end = n
    while end > 0:
        first = group[order[end - 1]]
        carried: dict[int, int] = {}
        if end - first == 1:
            s = order[first]
            p = s - 1
            while p >= 0 and group[p] > first:
                p = smaller[p]
            smaller[s] = p
            # A suffix carries this one alone: it is the highest of what is left of its group.
            if p >= 0:
                g = group[p]
                c = size[g]
                if c > 1:
                    at, last = place[p], g + c - 1
                    q = order[last]
                    order[at], place[q] = q, at
                    order[last], place[p] = p, last
                    group[p], size[last], size[g] = last, 1, c - 1
        else:
            for s in sorted(order[first:end]):
                p = s - 1
                while p >= 0 and group[p] > first:
                    p = smaller[p]
                if p >= 0 and group[p] == first:
                    p = smaller[p]
                smaller[s] = p
                if p >= 0:
                    carried[p] = carried.get(p, 0) + 1
            for p in sorted(carried, key=carried.__getitem__, reverse=True) if len(carried) > 1 else carried:
                carried[p] = (carried[p], group[p])
            moved: dict[tuple[int, int], list[int]] = {}
            for p, key in carried.items():
                moved.setdefault(key, []).append(p)
            for (_, g), members in sorted(moved.items(), reverse=True) if len(moved) > 1 else moved.items():
                c = size[g]
                top = g + c - len(members)
                if top == g:
                    continue
                to = g + c - 1
                for p in members:
                    at = place[p]
                    q = order[to]
                    order[at], place[q] = q, at
                    order[to], place[p] = p, to
                    to -= 1
                    group[p] = top
                size[top], size[g] = len(members), c - len(members)
        end = first
    free = list(range(n))
    result = [-1] * n
    result[0] = n - 1
    done = bytearray(n)
    done[n - 1] = 1
    for rank in range(n):
        s = result[rank] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            result[free[g]] = s
            free[g] += 1
            done[s] = 1
            s = smaller[s]
    return result[1:]
