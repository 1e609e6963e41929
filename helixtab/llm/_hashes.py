"""Prefix polynomial hashes over token arrays (numpy), and the windows that share a key.

Hashes are taken modulo 2**64 with an odd base, which has an inverse, so that equal
stretches have equal hashes wherever they lie. Tokens are random 64-bit values.
"""

from __future__ import annotations

import numpy as np
import xxhash

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def prefix(values: np.ndarray) -> np.ndarray:
    """P with P[0] = 0; see stretch()."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(BASE, len(values)), out=out[1:])
    return out


def stretch(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of values[start:end], for arrays of bounds."""
    return (p[end] - p[start]) * _power(INVERSE, len(p))[start]


def every(p: np.ndarray, k: int) -> np.ndarray:
    """The hash of each k values in a row."""
    n = max(len(p) - k, 0)
    return (p[k:] - p[:n]) * _power(INVERSE, len(p))[:n]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w values in a row, in a few passes whatever w is."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    full = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, x.dtype)
    full[: len(x)] = x
    blocks = full.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in bytes, of the words of UTF-8 data."""
    edge = np.diff(np.concatenate(([True], IS_SPACE[data], [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_values(data: np.ndarray) -> np.ndarray:
    """A 64-bit value for each word; long words, of which unlike ones can be made whose polynomial hashes agree, have XXH64."""
    start, end = word_bounds(data)
    out = mix(stretch(prefix(BYTE_VALUE[data]), start, end))
    for i in np.flatnonzero(end - start > 255).tolist():
        out[i] = xxhash.xxh64_intdigest(data[start[i] : end[i]].tobytes())
    return out


def byte_values(data: np.ndarray) -> np.ndarray:
    return BYTE_VALUE[data]


def pieces(text: bytes, size: int, overlap: int, by_words: bool):
    """(first token, values) of the text in pieces of at most size bytes or so.

    Pieces overlap by overlap tokens, so each window of overlap + 1 tokens is in one whole.
    """
    data = np.frombuffer(text, np.uint8)
    if not by_words:
        for at in range(0, max(len(data) - overlap, 0), size):
            yield at, byte_values(data[at : at + size + overlap])
        return
    if len(data) <= 2 * size:
        yield 0, word_values(data)
        return
    start, end = word_bounds(data)
    step = max(1, size // 8)
    for at in range(0, max(len(start) - overlap, 0), step):
        last = min(at + step + overlap, len(start)) - 1
        yield at, word_values(data[start[at] : end[last]])


def regions(values: np.ndarray, ends: np.ndarray, window: int, k: int, longest: int):
    """Runs of windows that share a key, for documents laid end to end.

    A window's key is the least hash of its k-grams: it depends on the window's content
    alone, so equal windows meet under one key. Returns arrays: first window (an index of
    values), number of windows, key, hash of the whole run, and whether windows of the run may
    equal each other: only if a k-gram that is some window's key is followed by itself there.
    ends: where each document ends.
    """
    empty = np.zeros(0, np.int64)
    if len(values) < window:
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty.astype(bool)
    p = prefix(values)
    w = window - k + 1
    gram = mix(every(p, k))
    key = sliding_min(gram, w)
    # a k-gram is the key of a window that holds it if the largest key of those windows is its own hash
    edge = np.zeros(w - 1, np.uint64)
    highest = ~sliding_min(~np.concatenate((edge, key, edge)), w)
    keys = np.flatnonzero(highest == gram)
    twice = np.zeros(len(gram) + 1, np.int64)
    twice[1:][keys[:-1][gram[keys[:-1]] == gram[keys[1:]]]] = 1
    twice = np.cumsum(twice)
    n = len(key)
    whole = np.ones(n, bool)  # windows within one document
    for e in ends[ends < len(values)]:
        whole[max(0, e - window + 1) : e] = False
    change = np.flatnonzero((key[1:] != key[:-1]) | (whole[1:] != whole[:-1])) + 1
    first = np.concatenate(([0], change))
    size = np.diff(np.concatenate((first, [n])))
    good = whole[first]
    first, size = first[good], size[good]
    if len(size) and size.max() > longest:  # the same k-gram over and over
        times = -(-size // longest)
        at = np.repeat(first, times)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
        left = np.repeat(size, times) - nth * longest
        first, size = at + nth * longest, np.minimum(left, longest)
    inner = twice[first + size + w - 1] > twice[first]
    return first, size, key[first], mix(stretch(p, first, first + size + window - 1)), inner
