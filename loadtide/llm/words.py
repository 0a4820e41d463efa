"""Hashes of words and word shingles for whole Arrow batches of texts.

Words are runs of bytes other than the six ASCII white-space bytes, with A-Z lower-cased.
A batch is handled in pieces of a quarter of a megabyte, so memory follows the longest text and
not the batch. Texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE = 1 << 18
SHINGLE = 5

_BASE = 0x9E3779B97F4A7C15  # odd, so that powers can be undone modulo 2**64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all input bits over all output bits (a bijection on 64 bits)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_PLACE = mix(np.arange(1001, 1001 + SHINGLE, dtype=np.uint64)) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, PIECE + 1024), base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= 4 * PIECE:  # arrays for a huge text aren't kept
            _powers[name] = have
    return have[:n]


def pieces(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Index ranges of about PIECE bytes each; a longer text stands alone."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > PIECE:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """One 64-bit hash per word of all texts, and for each text the index after its last word."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts = edge[~space[edge]]
    stops = edge[space[edge]]
    if not space[0]:
        starts = np.concatenate(([0], starts))
    if not space[-1]:
        stops = np.concatenate((stops, [len(data)]))
    value = _BYTE[_LOWER[data] if lower else data]
    value *= _power("up", _BASE, len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(value, out=sums[1:])
    raw = (sums[stops] - sums[starts]) * _power("down", pow(_BASE, -1, 1 << 64), len(data))[starts]
    ends = np.cumsum([len(t) + 1 for t in texts])
    return mix(raw), np.searchsorted(starts, ends - 1, side="left")


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """For each text its sorted distinct hashes of SHINGLE consecutive words.

    Fewer words make one shingle of the whole sequence; no words make an empty set.
    """
    for lo, hi in pieces(texts):
        words, last = word_hashes(texts[lo:hi])
        n = len(words) - SHINGLE + 1
        with np.errstate(over="ignore"):
            rolled = mix(sum(words[j : j + n] * _PLACE[j] for j in range(SHINGLE))) if n > 0 else words[:0]
        first = 0
        for end in last:
            if end - first >= SHINGLE:
                yield np.unique(rolled[first : end - SHINGLE + 1])
            elif end > first:
                own = words[first:end] * _PLACE[: end - first]
                yield mix(own.sum(keepdims=True, dtype=np.uint64) + np.uint64(end - first))
            else:
                yield words[:0]
            first = end


def as_bytes(column) -> list[bytes]:
    """UTF-8 of an Arrow string column; null counts as empty."""
    import pyarrow as pa

    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]
