"""Suffix arrays of many short strings at once, by linear grouping construction.

Phase 1 groups the suffixes of each string by their Lyndon prefix. Groups are worked off
from the highest down; each suffix of the current group points at the nearest suffix before
it that is in a lower group (its previous smaller suffix), and the suffixes
pointed at move to new groups right behind their old ones, ordered by how many pointers
they got. Phase 2 walks the suffixes in ascending order and puts the suffix in front of each,
and those it points back at, into the next free slot of their groups. Nothing is renamed
and nothing recurs.

A step takes the next group of every string together, so the work is done in numpy. The
number of steps is that of the longest string; the work is linear in all symbols but for
the sorting of what one step moves.
"""

from __future__ import annotations

import numpy as np


def _ranges(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """low[k], low[k] + 1, ... for each k, ``size[k]`` of them, end to end."""
    ahead = np.cumsum(size) - size
    return np.repeat(low - ahead, size) + np.arange(int(size.sum()))


def _lyndon_groups(symbols: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix the first slot of its group, and its previous smaller suffix
    or -1. Slots are counted over all strings."""
    n = len(symbols)
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    key = owner * (int(symbols.max()) + 1) + symbols
    slots = np.argsort(key, kind="stable")
    place = np.empty(n, np.int64)
    place[slots] = np.arange(n)
    opens = np.concatenate([[True], np.diff(key[slots]) != 0])
    heads = np.flatnonzero(opens)
    size = np.zeros(n, np.int64)
    size[heads] = np.diff(np.append(heads, n))
    group = np.empty(n, np.int64)
    group[slots] = np.repeat(heads, size[heads])

    previous = np.full(n, -1)
    skip = np.full(n, -1)  # like previous, shortened on the way
    moving = np.zeros(n, bool)
    bound = begins[1:].copy()
    live = np.arange(len(bound))
    while len(live):
        high = bound[live]
        low = group[slots[high - 1]]
        bound[live] = low
        own = slots[_ranges(low, high - low)]
        here = np.repeat(low, high - low)
        before = own - 1
        before[before < begins[owner[own]]] = -1
        climb = np.flatnonzero((before >= 0) & (group[before] > here))
        while len(climb):
            before[climb] = skip[before[climb]]
            climb = climb[(before[climb] >= 0) & (group[before[climb]] > here[climb])]
        # Pointers within the group itself are followed to its outside, doubling.
        skip[own] = before
        inner = np.flatnonzero((before >= 0) & (group[before] == here))
        while len(inner):
            before[inner] = skip[before[inner]]
            skip[own] = before
            inner = inner[(before[inner] >= 0) & (group[before[inner]] == here[inner])]
        previous[own] = before

        target, pointers = np.unique(before[before >= 0], return_counts=True)
        if len(target):
            order = np.lexsort((pointers, group[target]))
            target, pointers = target[order], pointers[order]
            old = group[target]
            first = np.concatenate([[True], np.diff(old) != 0])
            heads = np.flatnonzero(first)
            moved = np.diff(np.append(heads, len(old)))
            goal = _ranges(old[heads] + size[old[heads]] - moved, moved)
            moving[target] = True
            occupant = slots[goal]
            displaced = occupant[~moving[occupant]]
            left = place[target]
            vacated = left[left < np.repeat(goal[heads], moved)]
            slots[vacated], place[displaced] = displaced, vacated
            slots[goal], place[target] = target, goal
            moving[target] = False
            size[old[heads]] -= moved
            fresh = np.flatnonzero(first | np.concatenate([[True], np.diff(pointers) != 0]))
            count = np.diff(np.append(fresh, len(old)))
            size[goal[fresh]] = count
            group[target] = np.repeat(goal[fresh], count)
        live = live[bound[live] > begins[live]]
    return group, previous


def suffix_arrays(symbols: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Positions of all suffixes, string by string, in ascending order.

    String k is ``symbols[begins[k]:begins[k + 1]]`` and ends with a symbol that is
    less than all others in it.
    """
    begins = np.asarray(begins, np.int64)
    if not len(symbols):
        return np.zeros(0, np.int64)
    group, previous = _lyndon_groups(np.asarray(symbols, np.int64), begins)
    n = len(symbols)
    out, free, done = np.full(n, -1), np.arange(n), np.zeros(n, bool)
    length = np.diff(begins)
    live = np.argsort(-length, kind="stable")
    live = live[length[live] > 0]
    out[begins[live]] = begins[live + 1] - 1
    done[begins[live + 1] - 1] = True
    first = begins[live]
    ends = -length[live]
    for step in range(int(length.max())):
        count = int(np.searchsorted(ends, -step, side="left"))  # strings longer than step
        start = first[:count]
        s = out[start + step] - 1
        s = s[(s >= start) & ~done[s]]
        while len(s):
            slot = free[group[s]]
            free[group[s]] += 1
            out[slot] = s
            done[s] = True
            s = previous[s]
            s = s[s >= 0]
            s = s[~done[s]]
    return out
