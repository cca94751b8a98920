"""Suffix arrays by two-stage sorting, for many short pieces of bytes at once."""

from __future__ import annotations

import numpy as np


def windows8(flat: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as a big-endian number; beyond the end, zeros."""
    w = np.concatenate([flat, np.zeros(8, np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        w = (w[:-step] << np.uint64(8 * step)) | w[step:]
    return w[: len(flat)]


def smaller_than_successor(chars: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that starts a position later; the last isn't."""
    diff = np.sign(np.diff(chars.astype(np.int32), append=np.int32(-1)))
    at = np.arange(len(chars))
    nxt = np.minimum.accumulate(np.where(diff != 0, at, len(chars) - 1)[::-1])[::-1]
    return diff[nxt] > 0


def sorted_windows(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the suffixes that have at least `width` bytes of their piece, by those bytes.

    flat holds the pieces, each [start, end) with at least one zero byte between them that belongs to none. Returns the
    suffixes' places in order, and the common prefix of each with the one before it, at most `width` (the first: 0).

    Stage one sorts the suffixes that are smaller than their successors directly. Stage two scans the buckets of first
    bytes upward and appends to its bucket each suffix that is larger than its successor, when the scan comes to that
    successor. Only wanted suffixes, and those that lead from them to a directly sorted one, take part.
    """
    n = len(flat)
    chars = flat.astype(np.int16) + 1
    inside = np.zeros(n + 1, np.int32)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    chars[np.cumsum(inside[:n]) == 0] = 0
    small = smaller_than_successor(chars)
    wanted = np.zeros(n + 1, np.int32)
    np.add.at(wanted, starts, 1)
    np.add.at(wanted, ends - width + 1, -1)
    wanted = np.cumsum(wanted[:n]) > 0
    part = wanted.copy()
    for last in (ends - width,):  # onward from each piece's last wanted suffix to the next directly sorted one
        at = last[~small[last]] + 1
        while len(at):
            at = at[chars[at] > 0]
            part[at] = True
            at = at[~small[at]] + 1
    words = windows8(flat)
    words = np.concatenate([words, np.zeros(width + 8, np.uint64)])
    offsets = [*range(0, width - 7, 8)] + ([width - 8] if width % 8 else [])
    direct = np.flatnonzero(part & small)
    direct = direct[np.lexsort([words[direct + o] for o in reversed(offsets)])]
    direct_at = np.searchsorted(chars[direct], np.arange(258)) if len(direct) else np.zeros(258, np.int64)
    induced = part & ~small
    waiting: list[list[np.ndarray]] = [[] for _ in range(257)]
    # a piece's last suffix follows its end: the smallest of all successors
    _deal(np.flatnonzero(induced & (np.append(chars[1:], 0) == 0)), chars, waiting)
    out = []
    for c in range(1, 257):
        while waiting[c]:
            now = np.concatenate(waiting[c])
            waiting[c] = []
            out.append(now)
            _deal(_before(now, induced), chars, waiting)
        now = direct[direct_at[c] : direct_at[c + 1]]
        if len(now):
            out.append(now)
            _deal(_before(now, induced), chars, waiting)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    order = order[wanted[order]]
    return order, _common(words, order, offsets, width)


def _before(places: np.ndarray, induced: np.ndarray) -> np.ndarray:
    before = places[places > 0] - 1
    return before[induced[before]]


def _deal(places: np.ndarray, chars: np.ndarray, waiting: list[list[np.ndarray]]) -> None:
    """Appends places to the buckets of their first bytes, keeping their order."""
    if not len(places):
        return
    c = chars[places]
    by = np.argsort(c, kind="stable")
    cuts = np.flatnonzero(np.diff(c[by])) + 1
    for own in np.split(places[by], cuts):
        waiting[chars[own[0]]].append(own)


def _common(words: np.ndarray, order: np.ndarray, offsets: list[int], width: int) -> np.ndarray:
    out = np.full(len(order), width, np.int64)
    out[:1] = 0
    alike = np.arange(max(0, len(order) - 1))
    for o in offsets:
        x = words[order[alike + 1] + o] ^ words[order[alike] + o]
        apart = x != 0
        first = x[apart]
        lead = sum((first < np.uint64(1 << 8 * b)).astype(np.int64) for b in range(1, 8))  # leading bytes that agree
        out[alike[apart] + 1] = np.minimum(width, o + lead)
        alike = alike[~apart]
    return out
