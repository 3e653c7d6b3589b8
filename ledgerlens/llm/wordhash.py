"""64-bit hashes of words and of runs of words, for many texts at once with numpy.

Words are runs of bytes other than space and the control characters 9 to 13.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Text handled together, in bytes; each byte needs about 50 bytes of memory.
GROUP_BYTES, GROUP_ROWS = 1 << 20, 1000

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE[_SPACE] = 0
_P, _Q = (np.uint64(int(x) | 1) for x in _rng.integers(1 << 60, 1 << 63, 2, dtype=np.uint64))
_powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(255, _P)]), dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def groups(texts: list[bytes]):
    """Slices of consecutive texts of about GROUP_BYTES."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > GROUP_BYTES:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def text_groups(column: pa.Array):
    """(row of the first, UTF-8 of consecutive texts of about GROUP_BYTES); null is empty."""
    for start in range(0, len(column), GROUP_ROWS):
        texts = [(t or "").encode() for t in column.slice(start, GROUP_ROWS).to_pylist()]
        for a, b in groups(texts):
            yield start + a, texts[a:b]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first byte (in the texts joined by one blank) of every word; word bounds of the texts (one more than texts)."""
    global _powers
    joined = b" ".join(texts) + b" "
    raw = np.frombuffer(joined, np.uint8)
    word = ~_SPACE[raw]
    starts = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)]).astype(np.int64)
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, bounds
    sizes = np.diff(np.append(starts, len(raw)))
    if sizes.max() > len(_powers):
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(sizes.max()) - 1, _P)]), dtype=np.uint64)
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, sizes)
    return mix(np.add.reduceat(_BYTE[raw[starts[0]:]] * _powers[place], starts - starts[0])), starts, bounds


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive words (len(words) - k + 1 of them)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * _Q + words[i:i + n]
    return mix(out + np.uint64(k))
