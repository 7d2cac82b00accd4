"""Hashed sets of word shingles, computed for a batch of texts with numpy.

Words are runs of anything but ASCII white space, with A-Z lower-cased. A text's set has
a 64-bit hash for each distinct run of five words; a text of one to four words has one
for the whole sequence, and a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WIDTH = 5
_SLICE = 1 << 20
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_STEP = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(_STEP))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLACE = mix(np.arange(11, 11 + WIDTH, dtype=_U) * _U(_STEP)) | _U(1)
_BASE = 0xD1342543DE82EF95


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=_U)
    out[0] = 1
    return np.cumprod(out)


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of the bytes."""
    inside = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, _U), start
    length = end - start
    first = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(first, length)
    value = _BYTE[raw[inside]] * _powers(int(length.max()))[place]
    return mix(np.add.reduceat(value, first) + length.astype(_U) * _U(_STEP)), start


def _all_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As `_words`, a slice at a time, so that temporary arrays stay small."""
    hashes, starts, at = [], [], 0
    while at < len(raw):
        end = min(len(raw), at + _SLICE)
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        h, s = _words(raw[at:end])
        hashes.append(h)
        starts.append(s + at)
        at = end
    if not hashes:
        return np.empty(0, _U), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """For each text its sorted set of shingle hashes (uint64)."""
    raw = [("" if t is None else t).encode("utf-8", "surrogatepass").lower() for t in texts]
    begin = np.cumsum([0] + [len(r) + 1 for r in raw])
    words, start = _all_words(np.frombuffer(b"\n".join(raw), dtype=np.uint8))
    bound = np.searchsorted(start, begin)
    if len(words) >= WIDTH:
        runs = sum((words[i : len(words) - WIDTH + 1 + i] * _PLACE[i] for i in range(WIDTH)), _U(0))
        runs = mix(runs)
    else:
        runs = np.empty(0, _U)
    out = []
    for low, high in zip(bound[:-1], bound[1:], strict=True):
        n = high - low
        if n >= WIDTH:
            out.append(np.unique(runs[low : high - WIDTH + 1]))
        elif n:
            total = (words[low:high] * _PLACE[:n]).sum(keepdims=True) + np.array([n], dtype=_U) * _U(_STEP)
            out.append(mix(mix(total)))
        else:
            out.append(np.empty(0, _U))
    return out


def batches(texts, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about `limit` characters, one row at least."""
    low, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) if t is not None else 0
        if size >= limit:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


def signature(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, as two signed longs."""
    a = mix(hashes ^ _U(_STEP)).sum(dtype=_U)
    b = mix(hashes + _U(_BASE)).sum(dtype=_U)
    return int(np.int64(a.astype(np.int64))), int(b.astype(np.int64))
