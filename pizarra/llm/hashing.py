"""Vectorised word splitting and 64-bit hashing over UTF-8 bytes.

The separators and the case folding touch ASCII bytes only, so they work on
UTF-8 bytes directly.  The hash of a byte run is a polynomial over random byte
values modulo 2**64, taken from prefix sums, then mixed; no Python object is
made per word.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 3)
_INV = _U(pow(int(_BASE), -1, 1 << 64))
BLOCK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


_BYTE_VALUE = stream(11, 256)
_POW: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` for i below ``n`` at least."""
    if len(_POW[0]) < n:
        for k, b in enumerate((_BASE, _INV)):
            x = np.full(n, b, _U)
            x[0] = 1
            with np.errstate(over="ignore"):
                _POW[k] = np.multiply.accumulate(x)
    return _POW[0], _POW[1]


def byte_set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(chars, np.uint8)] = True
    return out


#: the word separators of the contracts: space and \t to \r
SPACE = byte_set(b" \t\n\x0b\x0c\r")
#: for features: everything in ASCII that is neither a letter nor a digit
NOT_ALNUM = byte_set(bytes(b for b in range(128) if not chr(b).isalnum()))


def _folded(lower: bool) -> np.ndarray:
    v = _BYTE_VALUE.copy()
    if lower:
        v[65:91] = v[97:123]
    return v


_VALUES = {False: _folded(False), True: _folded(True)}


def word_spans(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray = SPACE):
    """Starts and ends of the words, and per row the index of its first word
    (``n + 1`` entries)."""
    n = len(data)
    if n == 0:
        z = np.empty(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    word = ~sep[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    cut = offsets[(offsets > 0) & (offsets < n)]
    start[cut] = word[cut]
    end = word
    follows = np.ones(n, bool)
    follows[:-1] = ~word[1:] | start[1:]
    starts = np.flatnonzero(start)
    ends = np.flatnonzero(end & follows) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each byte run; runs are in order and don't overlap."""
    values, out = _VALUES[lower], np.empty(len(starts), _U)
    i, n = 0, len(starts)
    with np.errstate(over="ignore"):
        while i < n:
            a = starts[i]
            j = max(i + 1, int(np.searchsorted(ends, a + BLOCK, side="right")))
            span = data[a:ends[j - 1]]
            up, down = powers(max(len(span) + 1, BLOCK + 1))
            sums = np.zeros(len(span) + 1, _U)
            np.cumsum(values[span] * up[:len(span)], out=sums[1:])
            s, e = starts[i:j] - a, ends[i:j] - a
            out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(_U)
            i = j
    return mix(out)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` word hashes (those that cross rows too)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, _U)
    with np.errstate(over="ignore"):
        if n <= 8:
            c = stream(23, n) | _U(1)
            out = words[:m] * c[0]
            for k in range(1, n):
                out += words[k:k + m] * c[k]
            return mix(out)
        up, down = powers(len(words) + 1)
        sums = np.zeros(len(words) + 1, _U)
        np.cumsum(words * up[:len(words)], out=sums[1:])
        return mix((sums[n:] - sums[:-n]) * down[:m])


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each word, from ``word_spans``' third result."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def gram_starts(first: np.ndarray, n: int) -> np.ndarray:
    """Word indices at which a run of ``n`` words of one row starts."""
    total = int(first[-1])
    ok = np.zeros(total + 1, np.int64)
    long = np.diff(first) >= n
    np.add.at(ok, first[:-1][long], 1)
    np.add.at(ok, first[1:][long] - n + 1, -1)
    return np.flatnonzero(np.cumsum(ok[:-1]))


def keyed(ids: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(ids.astype(np.int64).view(_U) * _U(0xD6E8FEB86659FD93) + stream(seed, 1)[0])
