"""Suffix arrays by linear grouping (Baier, 2016), many strings at a time.

Phase 1 groups the suffixes of a string by their Lyndon prefix. Groups are processed
from the largest down. The unprocessed suffixes form a list; a suffix's left neighbour
in it is its previous smaller one, so taking the suffixes of the current group
off the list, each extends the Lyndon prefix of its neighbour by the group's. A
suffix that is extended ``k`` times moves up ``k`` groups, each placed directly above
the one it leaves.

Phase 2 emits the order within the groups: a suffix is its Lyndon prefix followed by
its next smaller suffix, so reading the suffix array from the left, the suffixes
whose next smaller one was just read take the next free places of their groups.
Nothing is renamed or sorted again.

Both phases are linear scans without large vectors, so a batch of strings is run
side by side: every string is a lane with its own cursors, and one array operation
advances all lanes that are in the same step.
"""

from __future__ import annotations

import numpy as np

_NONE = -1


def _groups(symbols: np.ndarray, offsets: np.ndarray, lengths: np.ndarray):
    """Phase 1: each suffix's group, and of the groups length, rank and size.

    Group numbers of lane ``s`` lie in ``[2 * offset, 2 * (offset + length))``; ranks
    count down from the lane's largest group.
    """
    n = len(symbols)
    at = np.arange(n, dtype=np.int32)
    lane_of = np.repeat(np.arange(len(offsets), dtype=np.int32), lengths)
    order = np.lexsort((at, symbols, lane_of)).astype(np.int32)
    lanes, syms = lane_of[order], symbols[order]
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (lanes[1:] != lanes[:-1]) | (syms[1:] != syms[:-1])
    first = np.flatnonzero(fresh)
    lane_first = np.searchsorted(lanes[first], np.arange(len(offsets)))
    number = np.arange(len(first)) - lane_first[lanes[first]] + 2 * offsets[lanes[first]]
    per_lane = np.bincount(lanes[first], minlength=len(offsets))

    cap = 2 * n
    head, tail = np.full(cap, _NONE, np.int32), np.full(cap, _NONE, np.int32)
    down, up = np.full(cap, _NONE, np.int32), np.full(cap, _NONE, np.int32)
    length, rank, count = np.zeros(cap, np.int32), np.full(cap, _NONE, np.int32), np.zeros(cap, np.int32)
    stamp, target = np.full(cap, _NONE, np.int32), np.full(cap, _NONE, np.int32)
    group = np.empty(n, np.int32)
    group[order] = np.repeat(number, np.diff(np.append(first, n)))
    head[number] = order[first]
    tail[number] = order[np.append(first[1:], n) - 1]
    length[number] = 1
    same = lanes[first][1:] == lanes[first][:-1]
    down[number[1:][same]] = number[:-1][same]
    up[number[:-1][same]] = number[1:][same]
    after, before = np.full(n, _NONE, np.int32), np.full(n, _NONE, np.int32)
    inner = ~fresh[1:]
    after[order[:-1][inner]] = order[1:][inner]
    before[order[1:][inner]] = order[:-1][inner]
    left, right = at - 1, at + 1
    left[offsets] = _NONE
    right[offsets + lengths - 1] = _NONE
    times, touched = np.zeros(n, np.int32), np.empty(n, np.int32)

    # Cursors of the lanes; step 0 takes a suffix off, 1 moves a touched one up.
    made = 2 * offsets + per_lane
    current = (2 * offsets + per_lane - 1).astype(np.int32)
    element = head[current]
    n_touched, read, keep = np.zeros_like(offsets), np.zeros_like(offsets), np.zeros_like(offsets)
    marks, ranks = np.zeros(len(offsets), np.int32), np.zeros(len(offsets), np.int32)
    step = np.zeros(len(offsets), np.int8)
    rank[current] = 0
    live = np.arange(len(offsets))
    rounds = 0
    while len(live):
        s = live[step[live] == 0]
        if len(s):
            e = element[s]
            g = current[s]
            count[g] += 1
            j, r = left[e], right[e]
            has, more = j >= 0, r >= 0
            right[j[has]] = r[has]
            left[r[more]] = j[more]
            s_has, j = s[has], j[has]
            t = times[j] + 1
            times[j] = t
            new = t == 1
            s_new = s_has[new]
            touched[offsets[s_new] + n_touched[s_new]] = j[new]
            n_touched[s_new] += 1
            e = after[e]
            element[s] = e
            done = s[e < 0]
            step[done] = np.where(n_touched[done] > 0, 1, 2)
            read[done] = 0
            keep[done] = 0
            marks[done] += 1
        s = live[step[live] == 1]
        if len(s):
            base = offsets[s]
            j = touched[base + read[s]]
            h = group[j]
            open_ = stamp[h] != marks[s]
            if open_.any():
                so, ho = s[open_], h[open_]
                x = made[so].astype(np.int32)
                made[so] += 1
                above = up[ho]
                up[x], down[x], up[ho] = above, ho, x
                ok = above >= 0
                down[above[ok]] = x[ok]
                length[x] = length[ho] + length[current[so]]
                stamp[ho], target[ho] = marks[so], x
            x = target[h]
            p, q = before[j], after[j]
            ok = p >= 0
            after[p[ok]] = q[ok]
            head[h[~ok]] = q[~ok]
            ok = q >= 0
            before[q[ok]] = p[ok]
            tail[h[~ok]] = p[~ok]
            end = tail[x]
            ok = end >= 0
            after[end[ok]] = j[ok]
            head[x[~ok]] = j[~ok]
            before[j], after[j], tail[x], group[j] = end, _NONE, j, x
            rest = times[j] - 1
            times[j] = rest
            ok = rest > 0
            so = s[ok]
            touched[offsets[so] + keep[so]] = j[ok]
            keep[so] += 1
            read[s] += 1
            done = s[read[s] == n_touched[s]]
            again = keep[done] > 0
            n_touched[done], read[done] = keep[done], 0
            keep[done] = 0
            marks[done] += 1
            step[done[~again]] = 2
        s = live[step[live] == 2]
        if len(s):
            g = down[current[s]]
            current[s] = g
            ok = g >= 0
            s, g = s[ok], g[ok]
            e = head[g]
            full = e >= 0
            s, g = s[full], g[full]
            ranks[s] += 1
            rank[g] = ranks[s]
            element[s] = e[full]
            step[s] = 0
        rounds += 1
        if rounds % 8 == 0:
            live = live[current[live] >= 0]
        else:
            step[live[current[live] < 0]] = 3
    return group, length, rank, count


def suffix_arrays(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Suffix arrays of concatenated strings, each ending in its only 0.

    The result holds positions in ``symbols``, lane after lane.
    """
    lengths = np.asarray(lengths, np.int64)
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int32)
    offsets = np.cumsum(lengths) - lengths
    group, length, rank, count = _groups(symbols, offsets, lengths)
    # Places: groups of a lane from the smallest, that is the last processed.
    used = np.flatnonzero(count > 0)
    lane = np.searchsorted(2 * offsets, used, side="right") - 1
    by = used[np.lexsort((-rank[used], lane))]
    free = np.zeros(len(count), np.int32)
    free[by] = np.cumsum(count[by]) - count[by]
    at = np.arange(n, dtype=np.int32)
    last = np.zeros(n, dtype=bool)
    last[offsets + lengths - 1] = True
    following = np.where(last, _NONE, at + length[group])
    # Suffixes by their next smaller one.
    child = np.flatnonzero(~last).astype(np.int32)
    child = child[np.argsort(following[child], kind="stable")]
    begin = np.searchsorted(following[child], at).astype(np.int32)
    end = np.searchsorted(following[child], at, side="right").astype(np.int32)
    out = np.full(n, _NONE, np.int32)
    out[offsets] = offsets + lengths - 1
    cursor, stop = offsets.copy(), offsets + lengths
    first = out[cursor]
    a, b = begin[first].copy(), end[first].copy()
    live = np.arange(len(offsets))
    while len(live):
        some = a[live] < b[live]
        s = live[some]
        if len(s):
            c = child[a[s]]
            g = group[c]
            out[free[g]] = c
            free[g] += 1
            a[s] += 1
        s = live[~some]
        if len(s):
            cursor[s] += 1
            go = cursor[s] < stop[s]
            s = s[go]
            x = out[cursor[s]]
            a[s], b[s] = begin[x], end[x]
            if not go.all():
                live = live[cursor[live] < stop[live]]
    return out
