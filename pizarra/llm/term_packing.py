"""Terms as machine words: length-bucketed packing, radix sort and run counts.

A term of up to 8 bytes is one big-endian uint64, one of up to 16 bytes two; both are
put in order by a radix sort over 16-bit digits.  Longer terms stand in separate
buckets by length, a power of two each, as fixed-width byte strings in byte order.
Terms hold no zero byte, so zero padding is no loss.
"""

from __future__ import annotations

import numpy as np
import xxhash

from pizarra.llm.hashing import mix

ONE, TWO = 0, 1          # kinds below 2: words; kind k from 2 on: byte strings of 2 ** (k + 3) bytes
_PAD = 16
_U = np.uint64
_MASK = np.array([0] + [(1 << 64) - (1 << (64 - 8 * i)) for i in range(1, 9)], _U)


def n_words(kind: int) -> int:
    return kind + 1 if kind < 2 else 0


def width(kind: int) -> int:
    """Bytes of a key of this kind."""
    return 8 * (kind + 1) if kind < 2 else 1 << (kind + 3)


def pack_terms(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """``(kind, rows, key)`` of each kind that occurs: which terms, and their keys (a
    list of uint64 arrays, or one byte-string array)."""
    size = ends - starts
    buf = np.concatenate([data, np.zeros(_PAD, np.uint8)])
    at = np.ndarray((len(buf) - 7,), ">u8", buf, strides=(1,))
    rows = np.flatnonzero(size <= 8)
    if len(rows):
        yield ONE, rows, [at[starts[rows]].astype(_U) & _MASK[size[rows]]]
    rows = np.flatnonzero((size > 8) & (size <= 16))
    if len(rows):
        yield TWO, rows, [at[starts[rows]].astype(_U), at[starts[rows] + 8].astype(_U) & _MASK[size[rows] - 8]]
    rows = np.flatnonzero(size > 16)
    if len(rows):
        kinds = np.maximum(np.ceil(np.log2(size[rows])).astype(np.int64) - 3, 2)
        for kind in np.unique(kinds).tolist():
            mine = rows[kinds == kind]
            key = np.zeros(len(mine), f"S{width(kind)}")
            flat = key.view(np.uint8).reshape(len(mine), -1)
            for i, (a, b) in enumerate(zip(starts[mine].tolist(), ends[mine].tolist())):
                flat[i, :b - a] = data[a:b]
            yield kind, mine, key


def radix_order(words: list[np.ndarray], order: np.ndarray | None = None) -> np.ndarray:
    """Stable order by unsigned integers, the least significant first.  Digits that are
    equal everywhere are passed over."""
    for w in words:
        for shift in range(0, w.dtype.itemsize * 8, 16):
            digit = (w >> w.dtype.type(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                if order is None:
                    order = np.argsort(digit, kind="stable")
                else:
                    order = order[np.argsort(digit[order], kind="stable")]
    return np.arange(len(words[0])) if order is None else order


def term_order(kind: int, key, minor: np.ndarray) -> np.ndarray:
    """Order by term, then by ``minor`` (unsigned)."""
    if kind < 2:
        return radix_order([minor, *key[::-1]])
    order = radix_order([minor])
    return order[np.argsort(key[order], kind="stable")]


def take(kind: int, key, rows):
    return [k[rows] for k in key] if kind < 2 else key[rows]


def joined(kind: int, keys: list):
    return [np.concatenate(x) for x in zip(*keys)] if kind < 2 else np.concatenate(keys)


def changes(kind: int, key) -> np.ndarray:
    """Whether each term of a sorted key differs from the one before it (the first does)."""
    cols = key if kind < 2 else [key]
    new = np.ones(len(cols[0]), bool)
    new[1:] = False
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    return new


def key_bytes(kind: int, key) -> bytes:
    return b"".join(k.tobytes() for k in key) if kind < 2 else key.tobytes()


def key_from(kind: int, data: bytes, n: int):
    if kind < 2:
        return [np.frombuffer(data, _U, n, 8 * n * i) for i in range(kind + 1)]
    return np.frombuffer(data, f"S{width(kind)}", n)


def key_hash(kind: int, key) -> np.ndarray:
    if kind < 2:
        h = mix(key[0])
        return h if kind == ONE else mix(h ^ key[1])
    return mix(np.array([xxhash.xxh64_intdigest(t) for t in key.tolist()], _U))


def texts(kind: int, key) -> list[bytes]:
    if kind < 2:
        return np.stack(key, axis=1).astype(">u8").view(f"S{width(kind)}").ravel().tolist() if len(key[0]) else []
    return key.tolist()
