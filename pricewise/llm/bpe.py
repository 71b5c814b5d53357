"""Byte-pair merging of many short sequences at once, as ragged numpy arrays.

Sequences of one length form a matrix. In each step every sequence of the matrix
merges its own lowest-ranked pair (the leftmost of equals) and so gets one symbol
shorter; the matrix joins the sequences of that length, and so on down to length 1.
Ranks of pairs are carried along, so that a merge looks up two new pairs only.
Sequences of over ``LONG`` symbols go through a heap one by one, in n log n.
"""

from __future__ import annotations

import heapq

import numpy as np

from pricewise.llm.ragged import U64, mix

NONE = np.int32(2**31 - 1)
LONG = 96
_C1, _C2, _C3 = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)


class Merges:
    """Pairs of symbols (ids from 0; negative ids never merge), the rank of each, and
    the symbol that it makes."""

    def __init__(self, left, right, rank, made):
        self.key = np.asarray(left, np.int64) << 32 | np.asarray(right, np.int64)
        self.rank, self.made = np.asarray(rank, np.int32), np.asarray(made, np.int32)
        # places by hash, an eighth full at most; a pair whose place is taken goes to the next
        self.bits = max(4, (8 * len(self.key)).bit_length())
        self.slot = np.full(1 << self.bits, -1, np.int32)
        self.slot_key = np.full(1 << self.bits, -1, np.int64)
        rows = np.unique(self.key, return_index=True)[1]
        at = self._hash(self.key[rows])
        while len(rows):
            free = self.slot[at] < 0
            one = np.flatnonzero(free)[np.unique(at[free], return_index=True)[1]]
            self.slot[at[one]], self.slot_key[at[one]] = rows[one], self.key[rows[one]]
            left_over = np.ones(len(rows), bool)
            left_over[one] = False
            rows, at = rows[left_over], (at[left_over] + 1) & (len(self.slot) - 1)

    def _hash(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(U64) * _C1) >> U64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the table, whether it is there) of each pair."""
        key = (a.astype(np.int64) << 32 | (b.astype(np.int64) & 0xFFFFFFFF)).ravel()
        at = self._hash(key)
        held = self.slot_key[at]
        there = held == key
        rest = np.flatnonzero(~there & (held != -1))
        while len(rest):
            at[rest] = (at[rest] + 1) & (len(self.slot) - 1)
            held = self.slot_key[at[rest]]
            same = held == key[rest]
            there[rest[same]] = True
            rest = rest[~same & (held != -1)]
        place = np.where(there, self.slot[at], 0).reshape(a.shape)
        return place, there.reshape(a.shape) & (a >= 0) & (b >= 0)

    def ranks(self, a, b, skip=None) -> np.ndarray:
        at, there = self.find(a, b)
        if skip is not None:
            there &= ~skip
        return np.where(there, self.rank[at], NONE)


def _place(start, mid, end) -> np.ndarray:
    """What a candidate, the join of [start, mid) and [mid, end), adds to its key."""
    return start.astype(U64) * _C1 + mid.astype(U64) * _C2 + end.astype(U64) * _C3


def below(h: np.ndarray, drop: float) -> np.ndarray:
    return (mix(h) >> U64(11)) < U64(int(drop * 2**53))


def _skipped(key, start, mid, end, drop: float) -> np.ndarray:
    """Whether the candidate that joins [start, mid) and [mid, end) is left out."""
    return below(key + _place(start, mid, end), drop)


def _merge_long(ids: np.ndarray, table: Merges, key, drop: float) -> np.ndarray:
    n = len(ids)
    sym, nxt, prv, end = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    agenda: list[tuple[int, int, int, int, int]] = []

    def offer(starts: list[int]) -> None:
        starts = [i for i in starts if i >= 0 and nxt[i] < n]
        if starts:
            i, j = np.array(starts), np.array([nxt[i] for i in starts])
            a, b = np.array([sym[k] for k in starts]), np.array([sym[k] for k in j.tolist()])
            at, there = table.find(a, b)
            if key is not None:
                there &= ~_skipped(key, i, j, np.array([end[k] for k in j.tolist()]), drop)
            for k in np.flatnonzero(there).tolist():
                heapq.heappush(agenda, (int(table.rank[at[k]]), starts[k], int(j[k]), end[int(j[k])], int(table.made[at[k]])))

    offer(list(range(n)))
    while agenda:
        _, i, j, stop, made = heapq.heappop(agenda)
        if sym[i] is None or nxt[i] != j or end[j] != stop:
            continue  # one of the two has merged since
        sym[i], sym[j], end[i], nxt[i] = made, None, stop, nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
        offer([prv[i], i])
    return np.array([s for s in sym if s is not None], np.int32)


def merge(flat: np.ndarray, off: np.ndarray, table: Merges, keys: np.ndarray | None = None, drop: float = 0.0,
          agenda: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All sequences merged, as flat symbols and offsets. With ``keys`` (one per
    sequence), a candidate is skipped with probability ``drop``, by its keyed hash.
    ``agenda`` takes up (sequences, places) of all candidates met, but for those of
    sequences of over ``LONG`` symbols."""
    n = np.diff(off)
    lens, done = n.copy(), []
    for row in np.flatnonzero(n > LONG):
        got = _merge_long(flat[off[row]:off[row + 1]], table, None if keys is None else keys[row], drop)
        lens[row] = len(got)
        done.append((np.array([row]), got[None, :]))
    order = np.argsort(n, kind="stable")
    bounds = np.searchsorted(n[order], np.arange(LONG + 2))
    held = None
    for size in range(min(LONG, int(n.max(initial=0))), 0, -1):
        rows = order[bounds[size]:bounds[size + 1]]
        x = flat[off[rows][:, None] + np.arange(size)]
        s = np.broadcast_to(np.arange(size, dtype=np.int32), x.shape)
        skip = None
        if keys is not None and size > 1:
            skip = _skipped(keys[rows][:, None], s[:, :-1], s[:, 1:], s[:, 1:] + 1, drop)
        r = table.ranks(x[:, :-1], x[:, 1:], skip)
        if agenda is not None:
            i, k = np.nonzero(r != NONE)
            agenda.append((rows[i], _place(k, k + 1, k + 2)))
        if held is not None:
            rows, x, s, r = (np.concatenate([a, b]) for a, b in zip(held, (rows, x, s, r)))
        if not len(rows):
            held = None
            continue
        if size == 1:
            done.append((rows, x))
            lens[rows] = 1
            break
        every = np.arange(len(rows))
        j = r.argmin(axis=1)
        live = r[every, j] != NONE
        if not live.all():
            done.append((rows[~live], x[~live]))
            lens[rows[~live]] = size
            rows, x, s, r, j = rows[live], x[live], s[live], r[live], j[live]
            every = np.arange(len(rows))
        x[every, j] = table.made[table.find(x[every, j], x[every, j + 1])[0]]
        keep = np.ones(x.shape, bool)
        keep[every, j + 1] = False
        x, s = x[keep].reshape(len(rows), size - 1), s[keep].reshape(len(rows), size - 1)
        keep = np.ones(r.shape, bool)
        keep[every, j] = False
        r = r[keep].reshape(len(rows), size - 2)
        for shift in (-1, 0):  # the pairs on both sides of the new symbol
            at = np.flatnonzero((j + shift >= 0) & (j + shift < size - 2))
            k = j[at] + shift
            skip = None
            if keys is not None:
                end = np.where(k + 2 < size - 1, s[at, np.minimum(k + 2, size - 2)], n[rows[at]])
                skip = _skipped(keys[rows[at]], s[at, k], s[at, k + 1], end, drop)
            r[at, k] = table.ranks(x[at, k], x[at, k + 1], skip)
            if agenda is not None:
                hit = r[at, k] != NONE
                i, c = at[hit], k[hit]
                end = np.where(c + 2 < size - 1, s[i, np.minimum(c + 2, size - 2)], n[rows[i]])
                agenda.append((rows[i], _place(s[i, c], s[i, c + 1], end)))
        held = (rows, x, s, r)
    out_off = np.r_[0, np.cumsum(lens)]
    out = np.empty(out_off[-1], np.int32)
    for rows, x in done:
        out[out_off[rows][:, None] + np.arange(x.shape[1])] = x
    return out, out_off
