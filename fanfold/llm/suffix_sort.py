"""Two-stage suffix sorting of a block of byte strings, with numpy.

A suffix is small if it sorts before the suffix one place on (its successor).  Only the
small suffixes are compared with each other.  The others follow by one scan of the
buckets of first bytes, from the least: when the scan meets suffix ``i`` and the byte
before it isn't smaller than its own first byte, suffix ``i - 1`` takes the next place
in the large part of its bucket.  A bucket is scanned as one array; within it only runs
of its own byte lead back into it.
"""

from __future__ import annotations

import numpy as np

_FILL = 16


def joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One array of the strings, each followed by a zero, and where each starts.  Bytes
    are raised by one (valid UTF-8 has no byte 255), so zero only ends strings."""
    sizes = np.fromiter((len(p) + 1 for p in parts), dtype=np.int64, count=len(parts))
    raw = np.frombuffer(b"\xff".join([*parts, b""]), dtype=np.uint8)
    return raw + np.uint8(1), np.cumsum(sizes) - sizes


def packed(text: np.ndarray) -> np.ndarray:
    """For each place the eight bytes from there on as one number that sorts like them."""
    padded = np.concatenate([text, np.zeros(_FILL, dtype=np.uint8)])
    out = np.empty(len(text), dtype=np.uint64)
    for k in range(8):
        n = len(range(k, len(text), 8))
        out[k::8] = padded[k : k + 8 * n].view(">u8")
    return out


def word_at(words: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    at = at + k
    return np.where(at < len(words), words[np.minimum(at, len(words) - 1)], np.uint64(0))


def small_suffixes(text: np.ndarray) -> np.ndarray:
    """Which suffixes sort before their successors; the last counts as one that does."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    rising = text[change] < text[change + 1]
    out = np.ones(n, dtype=bool)
    if len(change):
        lengths = np.diff(change, prepend=-1)
        out[: change[-1] + 1] = np.repeat(rising, lengths)
    return out


def sort_directly(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Places sorted by the ``depth`` bytes from there on; only what is still tied goes
    to the next eight bytes."""
    order = at[np.argsort(words[at], kind="stable")]
    if not len(order):
        return order
    tied = np.concatenate(([False], words[order[1:]] == words[order[:-1]]))
    for k in range(8, depth, 8):
        # runs of ties: sort them by (run, next bytes)
        inside = tied | np.concatenate((tied[1:], [False]))
        where = np.flatnonzero(inside)
        if not len(where):
            break
        run = np.cumsum(~tied[where])
        some = order[where]
        key = word_at(words, some, k)
        new = np.lexsort((key, run))
        order[where] = some[new]
        key = key[new]
        again = np.zeros(len(order), dtype=bool)
        again[where[1:]] = tied[where[1:]] & (key[1:] == key[:-1])
        tied = again
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """All places of ``text``, sorted by at least ``depth`` bytes from there on."""
    small = small_suffixes(text)
    words = packed(text)
    direct = sort_directly(np.flatnonzero(small), words, depth)
    first = text[direct]
    ends = np.searchsorted(first, np.arange(258))
    large: list[list[np.ndarray]] = [[] for _ in range(257)]
    out = []
    for c in range(256):
        parts = large[c]
        front = np.concatenate(parts) if parts else direct[:0]
        parts = [front]
        while len(front):
            before = front[front > 0] - 1
            front = before[text[before] == c]
            parts.append(front)
        bucket = np.concatenate([*parts, direct[ends[c] : ends[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        heads = text[before]
        up = heads > c
        before, heads = before[up], heads[up]
        order = np.argsort(heads, kind="stable")
        before, heads = before[order], heads[order]
        cuts = np.flatnonzero(np.diff(heads, prepend=np.uint8(c)))
        for a, b in zip(cuts, np.append(cuts[1:], len(heads))[: len(cuts)], strict=True):
            large[heads[a]].append(before[a:b])
    return np.concatenate(out)


def common_prefixes(order: np.ndarray, text: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix, ``depth`` at most, of each place and the one before
    it in ``order``; 0 for the first."""
    words = packed(text)
    out = np.zeros(len(order), dtype=np.int64)
    live = np.arange(1, len(order))
    for k in range(0, depth, 8):
        differ = word_at(words, order[live], k) ^ word_at(words, order[live - 1], k)
        same = np.full(len(live), 8, dtype=np.int64)
        for byte in range(8):
            same[differ >> np.uint64(56 - 8 * byte) != 0] = np.minimum(same, byte)[differ >> np.uint64(56 - 8 * byte) != 0]
        out[live] += same
        live = live[same == 8]
    return np.minimum(out, depth)
