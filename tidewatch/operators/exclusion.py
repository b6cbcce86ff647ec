"""Exclusion by counted failures, as array steps and as functions of whole chunks.

A counted failure starts an exclusion if the ``most``-th counted one before it lies within the interval.
Failures in an exclusion do not count; after it all count until the next exclusion starts. So between two
exclusions the counted rows lie together, and only the first ``most`` rows after an exclusion look back
over it; for later ones the answer is the same whatever came before: it is found for all rows at once,
and the next such row after any place by a minimum from the end.
"""

from __future__ import annotations

import pickle

import numpy as np

LEAST = np.iinfo(np.int64).min


def next_self_trigger(at: np.ndarray, most: int, interval: int) -> np.ndarray:
    """For each place, and the one after the end, the first row from there on whose ``most``-th
    predecessor lies within the interval (the number of rows if there is none)."""
    n = len(at)
    rows = np.full(n + 1, n, dtype=np.int64)
    if most < n:
        own = np.arange(most, n)
        rows[most:n] = np.where(at[most:] - interval <= at[:n - most], own, n)
    return np.minimum.accumulate(rows[::-1])[::-1]


def first_trigger(at: np.ndarray, start: int, before: np.ndarray, following: np.ndarray, n: int,
                  most: int, interval: int) -> int:
    """The first row from ``start`` on that starts an exclusion, if rows count from there and ``before``
    are the last counted times; ``n`` or more if there is none. ``at`` may end early by what is never read."""
    for k in range(min(most, n - start)):
        back = most - k
        if len(before) >= back and before[-back] >= at[start + k] - interval:
            return start + k
    return int(following[start + most]) if start + most < n else n


def last(times: np.ndarray, more: np.ndarray, number: int) -> np.ndarray:
    """The last ``number`` of both."""
    if len(more) >= number:
        return more[len(more) - number:]
    return np.concatenate([times, more])[-number:] if number else times[:0]


def interval_step(most: int, interval: int, timeout: int):
    """A step for ``sequential.fold``. State: end of the exclusion, then the counted times that a later row
    could still count."""
    def step(rows: dict[str, np.ndarray], state: list[int]):
        at = rows["__at"].astype(np.int64)
        n = len(at)
        until = state[0] if state else LEAST
        old = np.array(state[1:], dtype=np.int64)
        counted = np.zeros(n, dtype=bool)
        recent = np.zeros(n, dtype=np.int64)
        ends = np.full(n, -1, dtype=np.int64)
        following = next_self_trigger(at, most, interval)
        i, before = int(np.searchsorted(at, until, side="left")), old
        while i < n:
            found = first_trigger(at, i, before, following, n, most, interval)
            counted[i:found + 1] = True
            if found >= n:
                break
            before = last(before, at[max(i, found - most):found + 1], most)
            until = int(at[found]) + timeout
            ends[found] = until
            i = max(found + 1, int(np.searchsorted(at, until, side="left")))
        times = np.concatenate([old, at[counted]])
        recent[counted] = (np.arange(len(old), len(times)) + 1
                           - np.searchsorted(times, at[counted] - interval, side="left"))
        if n:
            times = times[np.searchsorted(times, at[-1] - interval, side="left"):]
            until = LEAST if until <= at[-1] else until
        return ({"tracked": counted, "recent": recent, "until_us": ends}, [int(until), *map(int, times)])
    return step


class IntervalChunks:
    """A chunk as a function of the state it is entered with, for intervals under twice the timeout.

    Then nothing before the exclusion that came last still counts at the end of the next one. The state is
    (end of the exclusion, the last ``most`` + 1 counted times). Within a chunk a node is a row that
    starts an exclusion and how many counted rows (``most`` + 1 at most) led to it since the exclusion
    before; each node has one successor, and doubling the successors gives the node at which its chain
    leaves the chunk. A chunk can only be entered by rows within one timeout of its first, and after two
    exclusions in it the entry state is forgotten, so the function needs the rows of two timeouts.
    """

    def __init__(self, most: int, interval: int, timeout: int):
        self.most, self.interval, self.timeout = most, interval, timeout

    @staticmethod
    def fits(interval: int, timeout: int) -> bool:
        return 0 < interval < 2 * timeout

    def summary(self, rows: dict[str, np.ndarray]) -> bytes:
        at = rows["__at"].astype(np.int64)
        n, most, kept = len(at), self.most, self.most + 1
        following = next_self_trigger(at, most, self.interval)
        start = np.searchsorted(at, at + self.timeout, side="left")
        row = np.arange(n)
        ends, succ = [], []
        for length in range(1, kept + 1):
            out = following[np.minimum(start + most, n)]
            for k in range(most - 1, -1, -1):
                back, here = most - k, start + k
                if length >= back:
                    own = np.maximum(row - back + 1, 0)
                    hit = (here < n) & (row >= back - 1)
                    hit &= at[own] >= at[np.minimum(here, n - 1)] - self.interval
                    out = np.where(hit, here, out)
            ends.append(out >= n)
            succ.append(np.where(out < n, out * kept + np.minimum(out - start, most), row * kept + length - 1))
        to = np.stack(succ, axis=1).ravel()
        while True:
            further = to[to]
            if (further == to).all():
                break
            to = further
        first = int(np.searchsorted(at, at[0] + self.timeout, side="right")) + most
        reach = int(np.searchsorted(at, at[min(first, n - 1)] + self.timeout, side="right")) + most + 1
        head = min(reach, n)
        onward = following[np.minimum(np.arange(head) + most, n)]
        whole = np.where(onward < n, to[np.minimum(onward, n - 1) * kept + most], -1)
        leaves = to[:head * kept]
        used = np.unique(np.concatenate([leaves, whole[whole >= 0]]))
        states = {int(x): self._left(at, start, *divmod(int(x), kept)) for x in used}
        return pickle.dumps((n, at[:head], following[:head + 1], whole, leaves, states,
                             at[max(0, n - kept):], int(at[-1])))

    def _left(self, at: np.ndarray, start: np.ndarray, row: int, length: int) -> list[int]:
        """The state after the chunk if the node (row, ``length`` + 1 counted rows) is its last one."""
        times = at[max(0, row - length):row + 1]
        if start[row] >= len(at):
            return [int(at[row]) + self.timeout, *times.tolist()]
        return [int(LEAST), *last(times, at[start[row]:], self.most + 1).tolist()]

    def leave(self, summary: bytes, state: list[int]) -> list[int]:
        n, at, following, whole, leaves, states, tail, final = pickle.loads(summary)
        kept = self.most + 1
        until, before = (state[0], np.array(state[1:], dtype=np.int64)) if state else (LEAST, np.zeros(0, np.int64))
        if until > final:
            return state
        i = int(np.searchsorted(at, until, side="left"))
        for fresh in (False, True):
            found = n
            for k in range(min(self.most, n - i)):
                back = self.most - k
                if len(before) >= back and before[-back] >= at[i + k] - self.interval:
                    found = i + k
                    break
            else:
                if whole[i] >= 0:
                    return states[int(whole[i])]
            if found >= n:
                return [int(LEAST), *last(before, tail[len(tail) - min(len(tail), n - i):], kept).tolist()]
            if fresh:
                return states[int(leaves[found * kept + found - i])]
            before = last(before, at[i:found + 1], kept)
            until = int(at[found]) + self.timeout
            if until > final:
                return [until, *before.tolist()]
            i = int(np.searchsorted(at, until, side="left"))
        raise AssertionError("two exclusions settle the state")
