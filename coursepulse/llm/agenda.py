"""Byte-pair merging of many words at once.

A word's agenda holds its adjacent symbol pairs that a merge exists for; the pair of the lowest
rank, leftmost on ties, is merged and the pairs beside it are looked up anew, until none is left.
All words take their next merge in the same numpy step, so a step costs a few array passes.

A word of more than ``LONG`` symbols would need as many steps as it has merges. In such a word all pairs merge at once that come
before every other pair within twice the length of the longest token on either side: what merges
before such a pair lies outside, no token reaches from there to it, and what grows from it cannot meet what grows there, so the
result is that of one merge after the other, after a number of steps that does not grow with the word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np

NEVER = np.int32(np.iinfo(np.int32).max)
_MIX = np.uint64(0x9E3779B97F4A7C15)
LONG = 512
_NONE = np.int64(np.iinfo(np.int64).max)


class PairTable:
    """``(left id, right id) -> (rank, merged id)`` as an open-addressing table in numpy arrays."""

    def __init__(self, merges: Iterable[tuple[int, int, int, int]]):
        rows = np.array(list(merges), np.int64).reshape(-1, 4)
        bits = max(8, int(np.ceil(np.log2(max(1, len(rows)) * 4))))
        self.longest = self._longest(rows)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, NEVER, np.int32)
        self.to = np.zeros(1 << bits, np.int32)
        todo = (rows[:, 0] << 32) | rows[:, 1]
        slot, rank, to = self._slot(todo), rows[:, 2], rows[:, 3]
        while len(todo):
            free = self.keys[slot] < 0
            first = np.zeros(len(todo), bool)  # one key a slot and round
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]], self.rank[slot[put]], self.to[slot[put]] = todo[put], rank[put], to[put]
            todo, rank, to, slot = todo[~put], rank[~put], to[~put], slot[~put]
            taken = self.keys[slot] != todo
            slot = np.where(taken, (slot + 1) & self.mask, slot)

    @staticmethod
    def _longest(rows: np.ndarray) -> int:
        """Symbols of the longest token that the merges make."""
        size = np.ones(int(rows[:, [0, 1, 3]].max(initial=0)) + 1, np.int64)
        while len(rows):
            grown = size.copy()
            np.maximum.at(grown, rows[:, 3], size[rows[:, 0]] + size[rows[:, 1]])
            if (grown == size).all() or grown.max() > 1 << 30:
                break
            size = grown
        return int(size.max())

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks (``NEVER`` where no merge exists) and merged ids."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slot = self._slot(key)
        got = self.keys[slot]
        at = np.flatnonzero((got != key) & (got >= 0))
        while len(at):
            slot[at] = (slot[at] + 1) & self.mask
            got = self.keys[slot[at]]
            at = at[(got != key[at]) & (got >= 0)]
        hit = self.keys[slot] == key
        return np.where(hit, self.rank[slot], NEVER), self.to[slot]


def merge_all(symbols: np.ndarray, offs: np.ndarray, table: PairTable,
              skip: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray] | None = None,
              merged: list[tuple[np.ndarray, np.ndarray, np.ndarray]] | None = None,
              ) -> tuple[np.ndarray, np.ndarray]:
    """``(symbols, offsets)`` after all merges; negative symbols never merge.

    ``skip(left, right, place)`` masks candidates that are not to be merged; ``place`` is the index
    in the given ``symbols`` of the first symbol that the left one has grown from. ``merged`` gets
    the merges that were made, as ``(left, right, place)``.
    """
    full = symbols.astype(np.int32)
    dead = np.zeros(len(full), bool)
    keep = np.diff(offs) > 1
    for word in np.flatnonzero(np.diff(offs) > LONG):
        keep[word] = False
        _merge_long(full, dead, int(offs[word]), int(offs[word + 1]), table, skip, merged)
    size = np.diff(offs)[keep]
    if not len(size):
        left = np.concatenate([[0], np.cumsum(~dead)])
        return full[~dead].astype(np.int64), left[offs]
    place = (np.repeat(offs[:-1][keep] - (np.cumsum(size) - size), size) + np.arange(size.sum())).astype(np.int32)
    sym = full[place]

    def look(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _candidates(sym, place, at, table, skip)

    rank, to = np.full(len(sym), NEVER, np.int32), np.zeros(len(sym), np.int32)
    last = np.cumsum(size) - 1
    inner = np.ones(len(sym), bool)
    inner[last] = False
    at = np.flatnonzero(inner)
    rank[at], to[at] = look(at)
    while True:
        best = np.minimum.reduceat(rank, last - size + 1)
        on = best < NEVER
        if not on.all():  # words without a merge left leave
            full[place] = sym
            if not on.any():
                break
            stay = np.repeat(on, size)
            sym, rank, to, place, size, best = sym[stay], rank[stay], to[stay], place[stay], size[on], best[on]
        is_best = np.flatnonzero(rank == np.repeat(best, size))
        word = np.searchsorted(np.cumsum(size), is_best, side="right")
        i = is_best[np.diff(word, prepend=-1) > 0]  # the leftmost of each word
        if merged is not None:
            merged.append((sym[i], sym[i + 1], place[i]))
        sym[i] = to[i]
        dead[place[i + 1]] = True
        rank[i] = rank[i + 1]  # NEVER where the right symbol was the word's last; looked up anew below
        stay = np.ones(len(sym), bool)
        stay[i + 1] = False
        new = np.cumsum(stay) - 1
        sym, rank, to, place = sym[stay], rank[stay], to[stay], place[stay]
        size = size - 1
        last = np.cumsum(size) - 1
        i = new[i]
        first = last - size + 1
        right = i[i < last]
        left = i[i > first] - 1
        rank[i] = NEVER
        at = np.concatenate([right, left])
        if len(at):
            rank[at], to[at] = look(at)
    left = np.cumsum(~dead)
    return full[~dead].astype(np.int64), np.concatenate([[0], left])[offs]


def _candidates(sym: np.ndarray, place: np.ndarray, at: np.ndarray, table: PairTable, skip) -> tuple[np.ndarray, np.ndarray]:
    """Ranks and merged ids of the pairs that start at ``at``; ``NEVER`` where none merges or it is skipped."""
    left, right = sym[at], sym[at + 1]
    rank, to = table.find(left, right)
    rank = np.where((left < 0) | (right < 0), NEVER, rank)
    if skip is not None:
        some = np.flatnonzero(rank < NEVER)
        rank[some[skip(left[some], right[some], place[at[some]])]] = NEVER
    return rank, to


def _window_min(a: np.ndarray, reach: int) -> np.ndarray:
    """The least value within ``reach`` places on either side of each place."""
    edge = np.full(reach, _NONE)
    b, have, size = np.concatenate([edge, a, edge]), 1, 2 * reach + 1
    while 2 * have <= size:
        b, have = np.minimum(b[:-have], b[have:]), 2 * have
    return np.minimum(b[:len(a)], b[size - have:size - have + len(a)])


def _merge_long(full: np.ndarray, dead: np.ndarray, start: int, end: int, table: PairTable, skip, merged) -> None:
    """All merges of the one word ``full[start:end]``, in place; ``dead`` marks the symbols that others took in."""
    sym, place = full[start:end].copy(), np.arange(start, end, dtype=np.int32)
    rank, to = _candidates(sym, place, np.arange(len(sym) - 1), table, skip)
    while len(sym) > 1:
        reach = min(2 * table.longest, len(sym))
        key = np.where(rank < NEVER, (rank.astype(np.int64) << 32) | np.arange(len(rank)), _NONE)
        i = np.flatnonzero((key < _NONE) & (key == _window_min(key, reach)))
        if not len(i):
            break
        if merged is not None:
            merged.append((sym[i], sym[i + 1], place[i]))
        sym[i] = to[i]
        dead[place[i + 1]] = True
        stay = np.ones(len(sym), bool)
        stay[i + 1] = False
        # pair k is (k, k + 1): the pairs of a symbol that is gone go, those beside it are looked up anew
        pairs = stay[:-1].copy()
        if not stay[-1]:  # the last symbol was taken in: the pair before it has no right symbol any more
            pairs[i[-1]] = False
        new = np.cumsum(stay) - 1
        sym, place = sym[stay], place[stay]
        rank, to = rank[pairs], to[pairs]
        at = np.unique(np.concatenate([new[i], new[i] - 1]))
        at = at[(at >= 0) & (at < len(sym) - 1)]
        rank[at], to[at] = _candidates(sym, place, at, table, skip)
    full[place] = sym
