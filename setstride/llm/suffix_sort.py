"""Two-stage suffix sorting of one byte string, vectorised.

Stage one sorts only the suffixes that are smaller than their successors, by eight bytes at a time and only where they
still tie. Stage two induces all other suffixes by one scan over the buckets of first bytes: a suffix's predecessor, where it is larger than the
suffix, comes next in the bucket of its own first byte.
"""

from __future__ import annotations

import numpy as np


def _packed(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one big-endian number; zeros follow the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text) + 1, np.uint64)
    for j in range(8):
        out[: len(text)] |= padded[j : j + len(text)].astype(np.uint64) << np.uint64(56 - 8 * j)
    return out


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last is not, as the end comes before everything."""
    n = len(text)
    if n < 2:
        return np.zeros(n, bool)
    differs = np.append(text[:-1] != text[1:], True)
    following = np.flatnonzero(differs)[np.searchsorted(np.flatnonzero(differs), np.arange(n))]
    return np.append(text[:-1] < text[1:], False)[following]


def _sorted_directly(text: np.ndarray, places: np.ndarray, keys: np.ndarray, depth: int) -> np.ndarray:
    """`places` in the order of their suffixes, as far as the first `depth` bytes tell."""
    n = len(text)
    order = places[np.argsort(keys[places], kind="stable")]
    first = keys[order]
    same = np.flatnonzero(first[1:] == first[:-1])  # entry i ties with entry i + 1
    for at in range(8, depth, 8):
        if not len(same):
            break
        value = lambda p: keys[np.minimum(order[p] + at, n)]  # noqa: B023, E731
        differ = value(same) != value(same + 1)
        if differ.any():
            # runs of ties; those with a difference inside are sorted anew
            begins = np.concatenate(([True], same[1:] != same[:-1] + 1))
            run = np.cumsum(begins) - 1
            touched = np.zeros(run[-1] + 1, bool)
            touched[run[differ]] = True
            starts = same[begins]
            ends = np.append(same[np.flatnonzero(begins)[1:] - 1], same[-1]) + 2
            starts, ends = starts[touched], ends[touched]
            size = ends - starts
            spot = np.repeat(starts - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            of = np.repeat(np.arange(len(size)), size)
            members = order[spot]
            order[spot] = members[np.lexsort((keys[np.minimum(members + at, n)], of))]
            same = same[value(same) == value(same + 1)]
        same = same[order[same] + at < n]
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes of `text`, in order by at least their first `depth` bytes."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    small = smaller_than_next(text)
    direct = _sorted_directly(text, np.flatnonzero(small), _packed(text), depth)
    heads = text[direct]
    bounds = np.searchsorted(heads, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[n - 1]].append(np.array([n - 1]))  # induced by the end of the string
    out = []

    def induce(entries: np.ndarray, own: int) -> np.ndarray:
        """Hand the larger predecessors of `entries` to their buckets; those of bucket `own` are returned."""
        before = entries[entries > 0] - 1
        before = before[~small[before]]
        if not len(before):
            return before
        byte = text[before]
        same = before[byte == own]
        before, byte = before[byte > own], byte[byte > own]
        turn = np.argsort(byte, kind="stable")
        before, byte = before[turn], byte[turn]
        cuts = np.flatnonzero(np.diff(byte)) + 1
        for part in np.split(before, cuts):
            if len(part):
                waiting[text[part[0]]].append(part)
        return same

    for c in range(256):
        wave = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(wave):
            out.append(wave)
            wave = induce(wave, c)
        waiting[c] = []
        part = direct[bounds[c] : bounds[c + 1]]
        if len(part):
            out.append(part)
            induce(part, c)
    return np.concatenate(out)


def common_prefix_reaches(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each adjacent pair of `order`: whether the suffixes share their first `length` bytes."""
    keys = _packed(text)
    n = len(text)
    still = np.flatnonzero(np.maximum(order[1:], order[:-1]) + length <= n)
    for at in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        a, b = order[still], order[still + 1]
        still = still[keys[a + at] == keys[b + at]]
    out = np.zeros(max(len(order) - 1, 0), bool)
    out[still] = True
    return out
