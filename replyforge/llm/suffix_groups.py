"""Suffix arrays of many strings at a time by grouping suffixes with equal Lyndon prefixes.

Phase one keeps the suffixes of a string in groups, in the order of what is known of their Lyndon prefixes, first one
character. Groups are taken from the highest down. For each member the previous-smaller pointer is found: the nearest
suffix to its left in a lower group. The suffixes pointed to have the member's prefix behind their own; inside their
group they move up into new groups, the more members point at one the higher. When the lowest group is reached, groups
are those of equal Lyndon prefixes, in order.

Phase two emits the order without renaming anything: going through the suffix array from its smallest entry, the suffix
left of each entry, and then along the previous-smaller pointers every suffix not yet emitted, takes the next free place
of its group.

Each string takes one group (phase one) or one entry (phase two) per step, and all strings take their steps together as
array operations. A string's own number of operations is linear in its length but for the walk along equal neighbours.
"""

from __future__ import annotations

import numpy as np


def ranges(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``first .. first + size - 1``, one range after another."""
    ends = np.cumsum(sizes)
    return np.repeat(firsts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def suffix_arrays(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For strings one after another, the places of their suffixes in order, string by string.

    Symbols are numbers from 1 on. A suffix that is a prefix of another comes first.
    """
    if not len(symbols):
        return np.zeros(0, np.int64)
    longest_first = np.argsort(-lengths, kind="stable")
    n = lengths[longest_first]
    source = ranges((np.cumsum(lengths) - lengths)[longest_first], n)
    # Each string lies between a guard in front, lower than all groups, and an end mark, lower than all symbols.
    base = np.cumsum(n + 2) - (n + 2)
    total = int((n + 2).sum())
    places = ranges(base + 1, n)
    text = np.zeros(total, np.int64)
    text[places] = symbols[source]
    owner = np.repeat(np.arange(len(n)), n + 2)
    body = np.ones(total, bool)
    body[base] = False
    body = np.flatnonzero(body)

    key = owner[body] * (int(symbols.max()) + 1) + text[body]
    order = np.argsort(key, kind="stable")
    at = np.zeros(total, np.int64)  # place in the order -> suffix
    at[body] = body[order]
    place = np.zeros(total, np.int64)
    place[at[body]] = body
    ordered = key[order]
    fresh = np.append(True, ordered[1:] != ordered[:-1])
    firsts = body[fresh]
    sizes = np.diff(np.append(np.flatnonzero(fresh), len(body)))
    group = np.full(total, -1, np.int64)  # suffix -> first place of its group
    group[at[body]] = np.repeat(firsts, sizes)
    group_size = np.zeros(total, np.int64)
    group_size[firsts] = sizes
    previous = _group(at, place, group, group_size, base + 1, base + n + 2)
    return _emit(group, previous, base, n, source, places, longest_first, lengths)


def _group(at, place, group, group_size, low, high) -> np.ndarray:
    """Phase one; answers the previous-smaller pointers and leaves the final groups in ``group``."""
    total = len(at)
    previous, done, moving = np.zeros(total, np.int64), np.zeros(total, bool), np.zeros(total, bool)
    low, high = low[high > low + 1], high[high > low + 1]
    while len(low):
        first = group[at[high - 1]]
        size = high - first
        members = at[ranges(first, size)]
        own = np.repeat(first, size)
        left = members - 1
        walk = np.flatnonzero(group[left] >= own)
        while len(walk):
            now = left[walk]
            now = np.where(done[now], previous[now], now - 1)
            left[walk] = now
            walk = walk[group[now] >= own[walk]]
        previous[members] = left
        done[members] = True

        left = np.sort(left[group[left] >= 0])
        if len(left):
            new = np.append(True, left[1:] != left[:-1])
            count = np.diff(np.append(np.flatnonzero(new), len(left)))
            left = left[new]
            old = group[left]
            order = np.lexsort((count, old))
            left, count, old = left[order], count[order], old[order]
            heads = np.flatnonzero(np.append(True, old[1:] != old[:-1]))
            moved = np.diff(np.append(heads, len(left)))
            border = old[heads] + group_size[old[heads]] - moved
            targets = ranges(border, moved)
            # Those that stand where others move to change places with them.
            moving[left] = True
            there = at[targets]
            there = there[~moving[there]]
            free = place[left]
            free = free[free < np.repeat(border, moved)]
            at[free], place[there] = there, free
            at[targets], place[left] = left, targets
            moving[left] = False
            parts = np.flatnonzero(np.append(True, (old[1:] != old[:-1]) | (count[1:] != count[:-1])))
            part_size = np.diff(np.append(parts, len(left)))
            group[left] = np.repeat(targets[parts], part_size)
            group_size[old[heads]] -= moved
            group_size[targets[parts]] = part_size
        high = first
        more = high > low + 1
        low, high = low[more], high[more]
    return previous


def _emit(group, previous, base, n, source, places, longest_first, lengths) -> np.ndarray:
    """Phase two; answers the order as places in the caller's array of symbols."""
    total = len(group)
    out, free, emitted = np.zeros(total, np.int64), np.arange(total), np.zeros(total, bool)
    out[base + 1] = base + n + 1
    emitted[base + n + 1] = emitted[base] = True  # end marks, and the guards at which chains end
    active = len(n)
    for step in range(int(n[0]) + 1):
        while active and n[active - 1] < step:
            active -= 1
        suffix = out[base[:active] + 1 + step] - 1
        suffix = suffix[~emitted[suffix]]
        while len(suffix):
            own = group[suffix]
            spot = free[own]
            out[spot] = suffix
            free[own] = spot + 1
            emitted[suffix] = True
            suffix = previous[suffix]
            suffix = suffix[~emitted[suffix]]
    back = np.zeros(total, np.int64)
    back[places] = source
    found = back[out[ranges(base + 2, n)]]  # without the end marks
    result = np.empty(len(found), np.int64)
    result[ranges((np.cumsum(lengths) - lengths)[longest_first], n)] = found
    return result
