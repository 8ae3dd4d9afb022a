"""Suffix arrays of one shard of bytes, in numpy."""

from __future__ import annotations

import numpy as np


END = np.arange(1, 9, dtype=np.uint8)


def words8(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from every place on as one big-endian number; zeros past the end."""
    k = np.zeros(len(text) + 8, np.uint64)
    k[:len(text)] = text
    for shift in (1, 2, 4):
        k[:-shift] = (k[:-shift] << np.uint64(8 * shift)) | k[shift:]
    return k[:len(text)]


def suffix_array(first: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their suffixes' first ``depth`` bytes, or more, from
    ``words8``; and those places, in the order of the text, that the last round still had
    to sort: any two that share ``depth`` bytes are among them. Larsson and Sadakane's refinement: the order by h bytes gives each place
    the rank of its group; groups of more than one place are sorted by the rank h
    places on, which orders them by 2 h bytes. Sorted groups are never touched again.
    The text must end with ``END``, so that no two of the last places tie."""
    n = len(first)
    order = np.argsort(first)
    start = np.ones(n, bool)
    np.not_equal(first[order[1:]], first[order[:-1]], out=start[1:])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    h, last = 8, np.zeros(0, np.int64)
    while h < depth and n:
        alone = start & np.append(start[1:], True)
        slots = np.flatnonzero(~alone)
        places = order[slots]
        last = places
        if not len(slots):
            break
        after = places + h
        key = (rank[places] << 32) | np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(key)
        places, key = places[by], key[by]
        order[slots] = places
        new = np.ones(len(slots), bool)
        np.not_equal(key[1:], key[:-1], out=new[1:])
        start[slots] = new
        rank[places] = np.maximum.accumulate(np.where(new, slots, 0))
        h *= 2
    return order, np.sort(last)


def shares_prefix(first: np.ndarray, order: np.ndarray, places: np.ndarray, depth: int,
                  lanes: int = 2048) -> np.ndarray:
    """For every place: are its suffix and the one before it in ``order`` equal in their
    first ``depth`` bytes? Only ``places`` (in the order of the text) are asked about, the
    answer for others is no. Kasai's scan: going on one place loses one byte of the common
    prefix at most. The places are scanned by many lanes at a time, each on a stretch of
    its own, whose common prefixes are only followed up to ``depth`` bytes."""
    n = len(first)
    out = np.zeros(n, bool)
    if n < 2 or not len(places):
        return out
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.append(first, np.zeros(depth + 8, np.uint64))
    stretch = -(-len(places) // lanes)
    begin = np.arange(0, len(places), stretch)
    common, at = np.zeros(len(begin), np.int64), np.full(len(begin), -2)
    for step in range(stretch):
        if begin[-1] + step >= len(places):
            begin, common, at = begin[:-1], common[:-1], at[:-1]
            if not len(at):
                break
        came, at = at, places[begin + step]
        common[at != came + 1] = 0
        other = before[at]
        # the order of suffixes equal in all that was sorted by is open, so after a
        # prefix of full depth the scan begins anew
        common = np.where(common >= depth, 0, np.maximum(common - 1, 0))
        common[other < 0] = 0
        todo = np.flatnonzero((other >= 0) & (common < depth))
        while len(todo):
            skip = np.minimum(common[todo], depth - 8)
            differ = padded[at[todo] + skip] ^ padded[other[todo] + skip]
            same = differ == 0
            # bytes agreed on in a word that differs (at most one too few, by rounding)
            bits = np.frexp(differ[~same].astype(np.float64))[1]
            common[todo[~same]] = np.maximum(common[todo[~same]], skip[~same] + np.maximum(64 - bits, 0) // 8)
            common[todo[same]] = skip[same] + 8
            todo = todo[same]
            todo = todo[common[todo] < depth]
        out[at] = (common >= depth) & (at + depth <= n) & (other + depth <= n)
    return out


def repeats(text: np.ndarray, valid: np.ndarray, depth: int) -> np.ndarray:
    """For every place: does an earlier valid place begin the same ``depth`` bytes?
    Only valid places count (those whose ``depth`` bytes lie in one document)."""
    n = len(text)
    text, valid = np.append(text, END), np.append(valid, np.zeros(len(END), bool))
    first = words8(text)
    order, places = suffix_array(first, depth)
    run = np.cumsum(~shares_prefix(first, order, places, depth)[order]) - 1
    place = np.where(valid[order], order, len(text))
    out = np.zeros(len(text), bool)
    earliest = np.minimum.reduceat(place, np.flatnonzero(np.append(True, run[1:] != run[:-1])))
    out[order] = valid[order] & (order > earliest[run - run[0]])
    return out[:n]
