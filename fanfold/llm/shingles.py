"""Sets of hashed word shingles, made with numpy inside Spark tasks."""

from __future__ import annotations

import numpy as np

WORDS = 5
#: Texts are hashed together in buffers of about this many bytes.
BUFFER_BYTES = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOW = np.arange(256, dtype=np.uint64)
_LOW[65:91] += 32
_LOW += np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEPS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
_powers = np.ones(1, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(2 * n, _BASE))))
    return _powers


def word_hashes(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of a byte buffer, and where they start."""
    space = _SPACE[buffer]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts
    sizes = ends - starts
    inside = ~space
    place = np.arange(inside.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    values = _LOW[buffer[inside]] * _power_table(int(sizes.max()))[place]
    return mixed(np.add.reduceat(values, np.cumsum(sizes) - sizes)), starts


def sets(texts: list[str | None]) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its five-word shingles; of all its
    words together where it has fewer; none for null or a text without words."""
    out: list[np.ndarray] = []
    part: list[bytes] = []
    size = 0
    for t in texts:
        raw = (t or "").encode("utf-8", "surrogatepass")
        if size and size + len(raw) > BUFFER_BYTES:
            out += _buffer_sets(part)
            part, size = [], 0
        part.append(raw)
        size += len(raw) + 1
    return out + _buffer_sets(part)


def _buffer_sets(parts: list[bytes]) -> list[np.ndarray]:
    if not parts:
        return []
    w, starts = word_hashes(np.frombuffer(b" ".join(parts) + b" ", dtype=np.uint8))
    bounds = np.searchsorted(starts, np.cumsum([0, *(len(p) + 1 for p in parts)]))
    n = len(w) - WORDS + 1
    joined = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(WORDS if n > 0 else 0):
        joined += w[k : k + n] * _STEPS[k]
    joined = mixed(joined)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= WORDS:
            out.append(np.unique(joined[a : b - WORDS + 1]))
        elif b > a:
            out.append(mixed((w[a:b] * _STEPS[: b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
